"""The streaming test against its batch form."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from statweave.operators.hypothesis import welch_test
from statweave.sources import text
from statweave.streaming import ab_test


def feed(spark, folder, batches):
    for i, rows in enumerate(batches):
        path = folder / f"batch{i}.txt"
        path.write_text("".join(f"{flag},{value}\n" for flag, value in rows))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return text.shape_ab_samples(text.stream_lines(spark, str(folder), 1))


QUIET = [[("true", 1.0 + i), ("false", 1.1 + i), ("true", 2.0), ("false", 2.1)] for i in range(4)]
LOUD = [("true", 90.0 + i) for i in range(20)] + [("false", 1.0 + i / 10) for i in range(20)]


def test_cumulative_results_per_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    samples = feed(spark, tmp_path / "in", QUIET)
    tests = ab_test.streaming_welch(samples, F.col("is_treatment"), "value")
    query = ab_test.write_results(tests, str(tmp_path / "out"), str(tmp_path / "state"), None)
    query.awaitTermination()
    got = ab_test.read_results(tests, str(tmp_path / "out")).orderBy("batch_id").collect()
    assert [(r.batch_id, r.n_control) for r in got] == [(0, 2), (1, 4), (2, 6), (3, 8)]
    batch = spark.createDataFrame([(f == "true", v) for rows in QUIET for f, v in rows], "t boolean, v double")
    known = welch_test(batch, F.col("t"), "v").first()
    assert (got[-1].statistic, got[-1].dof, got[-1].p_value) == pytest.approx((known.statistic, known.dof, known.p_value))


def test_stops_when_significant(spark, tmp_path):
    (tmp_path / "in").mkdir()
    samples = feed(spark, tmp_path / "in", [QUIET[0], LOUD, QUIET[1], QUIET[2]])
    tests = ab_test.streaming_welch(samples, F.col("is_treatment"), "value")
    seen = ab_test.run_until_significant(
        tests, str(tmp_path / "out"), str(tmp_path / "state"), processing_time="0 seconds", idle_seconds=60
    )
    assert seen == {"batches": 2, "significant": True}
    assert ab_test.read_results(tests, str(tmp_path / "out")).count() == 2
    assert not spark.streams.active


def test_stops_after_the_batch_limit(spark, tmp_path):
    (tmp_path / "in").mkdir()
    samples = feed(spark, tmp_path / "in", QUIET)
    tests = ab_test.streaming_welch(samples, F.col("is_treatment"), "value")
    seen = ab_test.run_until_significant(
        tests, str(tmp_path / "out"), str(tmp_path / "state"), max_batches=3, processing_time="0 seconds", idle_seconds=60
    )
    assert seen["batches"] == 3 and not seen["significant"]


def test_windows_and_peace_period_in_batch(spark):
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(seconds=5 * i), i % 2 == 0, float(i * i % 11)) for i in range(60)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, t boolean, v double")
    later = ab_test.after_peace_period(df, "ts", start, 20, 2)
    assert later.count() == 52 and later.agg(F.min("ts")).first()[0] == start + timedelta(seconds=40)
    windows = ab_test.streaming_welch(df, F.col("t"), "v", 3, 20, "ts").collect()
    by_start = {r.start: r.n_control + r.n_treatment for r in windows}
    assert by_start[start] == 12 and by_start[start - timedelta(seconds=40)] == 4
    assert sum(by_start.values()) == 3 * 60
    with pytest.raises(ValueError):
        ab_test.streaming_welch(df, F.col("t"), "v", 3)
