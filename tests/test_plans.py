"""Prefix sums, splits, strata and joins against brute force, with hot keys."""

import math
import random

import pytest
from pyspark.sql import functions as F

from statweave.operators import relational, sampling
from statweave.plans.prefix_sum import global_prefix_sum, row_index
from statweave.plans.staging import ensure_checkpoint_dir, is_small, persisted
from statweave.queries.catalog import QUERIES


def hot_rows(n=3000, seed=1):
    """A third of the rows share one key."""
    rng = random.Random(seed)
    return [(7.0 if i % 3 == 0 else round(rng.gauss(0, 50), 2), rng.randint(0, 4)) for i in range(n)]


@pytest.mark.parametrize("buckets", [None, 1, 2, 8, 64])
@pytest.mark.parametrize("descending", [False, True])
def test_prefix_sum(spark, buckets, descending):
    data = hot_rows()
    df = spark.createDataFrame(data, "k double, w bigint").repartition(5)
    got = global_prefix_sum(df, "k", {"w": F.col("w")}, descending, buckets, rank=True).collect()
    sums = {}
    for k, w in data:
        sums[k] = sums.get(k, 0) + w
    running, position = 0, 0
    expected = {}
    for k in sorted(sums, reverse=descending):
        running, position = running + sums[k], position + 1
        expected[k] = (sums[k], running, running and sum(sums.values()), position)
    assert {r.k: (r.w, r.cum_w, r.cum_w and r.total_w, r.cum_keys) for r in got} == expected


def test_prefix_sum_ignores_null_and_orders_integers(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (2,)], "k bigint")
    got = global_prefix_sum(df, "k", {"n": F.lit(1)}, buckets=3).orderBy("k").collect()
    assert [(r.k, r.cum_n, r.total_n) for r in got] == [(1, 1, 3), (2, 2, 3), (3, 3, 3)]


def test_row_index(spark):
    keys = random.Random(2).sample(range(10**9), 500)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(4)
    assert {r.k: r.row_index for r in row_index(df, "k").collect()} == {k: i for i, k in enumerate(sorted(keys))}


def test_stratified_exact_sizes(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "d"), (2, "e"), (3, "f")], "k int, v string")
    got = sampling.stratified_exact(df, "k", {1: 0.1, 2: 0.6, 3: 0.3}, ["v"]).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in got} == {1: 1, 2: 2, 3: 1}


def test_stratified_exact_hot_stratum(spark):
    rng = random.Random(4)
    rows = [("hot" if i % 3 == 0 else f"s{rng.randint(0, 9)}", i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, id bigint").repartition(6)
    fractions = {"hot": 0.257, "s1": 0.0, "s2": 1.0, "s3": 0.3}
    got = sampling.stratified_exact(df, "k", fractions, ["id"])
    first, again = {tuple(r) for r in got.collect()}, {tuple(r) for r in got.repartition(3).collect()}
    assert first == again and first <= set(rows)
    sizes = {k: sum(r[0] == k for r in rows) for k in fractions}
    for k, f in fractions.items():
        assert sum(r[0] == k for r in first) == math.ceil(round(f * sizes[k], 9))


def test_stratified_exact_repeated_ids(spark):
    df = spark.createDataFrame([("a", 1)] * 10, "k string, id bigint")
    assert sampling.stratified_exact(df, "k", {"a": 0.25}, ["id"]).count() == 3


def test_hash_split_parts(spark):
    df = spark.range(5000)
    parts = sampling.hash_split(df, [0.6, 0.3, 0.1], ["id"])
    ids = [{r.id for r in p.collect()} for p in parts]
    assert sum(map(len, ids)) == 5000 and set.union(*ids) == set(range(5000))
    assert len(ids[0]) == pytest.approx(3000, abs=150)


def test_set_difference_keeps_duplicates_and_nulls(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x"), (3, "y")], "a int, b string")
    right = spark.createDataFrame([(2, "x")], "a int, b string")
    got = sorted(map(tuple, relational.set_difference(left, right).collect()), key=repr)
    assert got == [(1, None), (1, None), (3, "y")]
    assert relational.set_difference(left, left.limit(1)).count() == 3


def test_group_collect_splits_hot_keys(spark):
    rows = [("hot" if i % 3 == 0 else f"u{i % 50}", i) for i in range(6000)] + [("none", -1), (None, 5), (None, 6)]
    df = spark.createDataFrame(rows, "u string, v bigint")
    got = relational.group_collect(df, "u", "v", F.col("v") >= 0, max_rows=300).collect()
    lists = {}
    for r in got:
        lists.setdefault(r.u, []).extend(r["items"])
    assert sum(r.u == "hot" for r in got) == 7
    assert max(len(r["items"]) for r in got) < 450
    expected = {}
    for u, v in rows:
        expected.setdefault(u, []).extend([v] if v >= 0 else [])
    assert {u: sorted(v) for u, v in lists.items()} == {u: sorted(v) for u, v in expected.items()}


@pytest.mark.parametrize("k", [1, 3, 1500])
def test_top_k(spark, k):
    rows = [("hot" if i % 3 == 0 else f"g{i % 7}", (i * 37) % 1009, i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, s bigint, id bigint")
    got = relational.top_k_per_group(df, ["g"], [F.desc("s"), F.col("id")], k)
    expected = {}
    for g, s, i in rows:
        expected.setdefault(g, []).append((-s, i))
    want = {(g, i, n + 1) for g, v in expected.items() for n, (_, i) in enumerate(sorted(v)[:k])}
    assert {(r.g, r.id, r["rank"]) for r in got.collect()} == want


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    top = relational.top_k_per_group(df, ["g"], [F.col("id")], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_sampling_and_split(spark):
    df = spark.range(2000).withColumn("k", F.col("id") % 2)
    assert sampling.bernoulli_sample(df, 0.6).count() == pytest.approx(1200, abs=120)
    a, b = sampling.random_split(df, [0.75, 0.25], 11)
    assert a.count() + b.count() == 2000 and a.join(b, "id").count() == 0
    by_key = {r.k: r["count"] for r in sampling.stratified_sample(df, "k", {0: 0.5}).groupBy("k").count().collect()}
    assert set(by_key) == {0} and by_key[0] == pytest.approx(500, abs=90)


def test_staging_helpers(spark):
    assert ensure_checkpoint_dir(spark)
    assert is_small(spark.range(5), 5) and not is_small(spark.range(6), 5)
    df = spark.range(3)
    with persisted(df) as kept:
        assert kept.is_cached
    assert not df.is_cached


def test_swap_and_first(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert relational.swap(df, "x", "y").columns == ["y", "x"]
    assert relational.first_row(spark.range(10)).count() == 1


def test_row_index_of_events_at_the_same_time(spark, tmp_path):
    rows = [(9, 5), (1, 5), (4, 3), (4, 3), (2, 8)]
    events = spark.createDataFrame(rows, "event_id bigint, s int").select("event_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = sorted(tuple(r) for r in QUERIES["row_index"](spark, str(tmp_path)).collect())
    assert got == [(1, 2), (2, 4), (4, 0), (4, 1), (9, 3)]
