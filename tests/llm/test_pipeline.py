"""The pipeline's stages on planted rows, and the registered names."""

import re

import pytest

import __spark_entry__
import corpus_pipeline
from statweave.sources.tables import table


def test_names():
    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in __spark_entry__.queries()


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    docs = table(spark, sf, "documents")
    item = table(spark, sf, "benchmark").first().text
    lead = docs.orderBy("doc_id").first().text
    key = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    rows = [
        (900_001, f"{lead} {item}"),
        (900_002, "first plain sentence " + " ".join(f"plant{i}" for i in range(200))),
        (900_003, "first plain sentence " + " ".join(f"plant{i}" for i in range(200)) + " end"),
        (900_004, " ".join(f"clean{i}" for i in range(80)) + f' token = "{key}"'),
        (900_005, None),
    ]
    extra = spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in rows], docs.schema)
    df, seen = docs.unionByName(extra), []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path_factory.mktemp("stage"))
        stage(spark, df, sf).write.mode("overwrite").parquet(out)
        seen.append((name, df, spark.read.parquet(out)))
        df = seen[-1][2]
    return seen


def test_columns_and_rows(stages):
    for name, before, after in stages[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0 < after.count() <= before.count()


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_planted_rows(stages):
    _, near, clean, masked, packed = [after for _, _, after in stages]
    assert {900_002, 900_004, 900_005} <= ids(near) and 900_003 not in ids(near)
    assert 900_001 not in ids(clean) and {900_002, 900_004, 900_005} <= ids(clean)
    text = masked.where("doc_id = 900004").first()
    assert '"[secret]"' in text.text and text.n_chars == len(text.text)
    assert ids(packed) == ids(masked)


def test_run_equals_its_stages_on_the_table(spark, sf):
    docs = table(spark, sf, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    got = sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()))
    assert got == sorted(map(tuple, docs.collect()))
