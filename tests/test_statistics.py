"""Summaries, correlation, density and tests on small literals with known answers."""

import math
import random

import pytest
from pyspark.ml.stat import ChiSquareTest, KolmogorovSmirnovTest
from pyspark.sql import functions as F

from statweave.functions.arrays import with_vector
from statweave.functions.distributions import chi2_p_value, erfc, kolmogorov_p_value, normal_cdf, student_t_p_value
from statweave.operators import descriptive, hypothesis

# The literals below are well-known example inputs, and the results that must match them.


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_column_summary(spark):
    df = spark.createDataFrame([(1.0, 10.0, 100.0), (2.0, 20.0, 200.0), (3.0, 30.0, 300.0)], "a double, b double, c double")
    got = {r.column: (r.n, r.mean, r.variance, r.num_nonzeros) for r in descriptive.column_summary(df, ["a", "b", "c"]).collect()}
    assert got == {"a": (3, 2.0, 1.0, 3), "b": (3, 20.0, 100.0, 3), "c": (3, 200.0, 10000.0, 3)}
    vectors = df.select(F.array("a", "b", "c").alias("features"))
    assert [tuple(r)[1:] for r in descriptive.vector_summary(vectors).orderBy("feature").collect()] == [
        (2.0, 1.0, 3), (20.0, 100.0, 3), (200.0, 10000.0, 3),
    ]


def test_two_series(spark):
    df = spark.createDataFrame([(1.0, 11.0), (2.0, 22.0), (3.0, 33.0), (3.0, 33.0), (5.0, 555.0)], "x double, y double")
    assert one(descriptive.pearson(df, "x", "y")).r == pytest.approx(0.8500286768773004, abs=1e-12)
    assert one(descriptive.spearman(df, "x", "y")).r == pytest.approx(1.0, abs=1e-12)


@pytest.mark.parametrize("vector", [False, True])
def test_correlation_matrix(spark, vector):
    df = spark.createDataFrame([(1.0, 10.0, 100.0), (2.0, 20.0, 200.0), (5.0, 33.0, 366.0)], "a double, b double, c double")
    if vector:
        rows = descriptive.vector_correlation(df.select(F.array("a", "b", "c").alias("features"))).collect()
        got = {("abc"[r.i], "abc"[r.j]): r.r for r in rows}
    else:
        got = {(r.i, r.j): r.r for r in descriptive.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9
    for pair, r in {("a", "b"): 0.97888347, ("a", "c"): 0.99038957, ("b", "c"): 0.99774832}.items():
        assert got[pair] == pytest.approx(r, abs=1e-8) and got[pair[::-1]] == got[pair]
    assert got["a", "a"] == pytest.approx(1.0)


def test_spearman_matches_vector_form_with_ties(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(float(rng.randint(0, 5)), float(rng.randint(0, 9)), rng.random()) for _ in range(300)], "a double, b double, c double")
    own = {(r.i, r.j): r.r for r in descriptive.correlation_matrix(df, ["a", "b", "c"], "spearman").collect()}
    built_in = descriptive.vector_correlation(df.select(F.array("a", "b", "c").alias("features")), method="spearman")
    for r in built_in.collect():
        assert own["abc"[r.i], "abc"[r.j]] == pytest.approx(r.r, abs=1e-10)


def test_kernel_density(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 2, 3, 4, 5, 5, 6, 7, 8, 9, 9]], "v double")
    got = {r.point: r.density for r in descriptive.kernel_density(df, "v", [-1.0, 2.0, 5.0], 3.0).collect()}
    assert got == pytest.approx({-1.0: 0.04145944, 2.0: 0.07902017, 5.0: 0.0896292}, abs=1e-7)


def test_chi2_goodness_of_fit(spark):
    counts = spark.createDataFrame([(i, v) for i, v in enumerate([0.1, 0.15, 0.2, 0.3, 0.25])], "category int, o double")
    r = one(hypothesis.chi2_goodness_of_fit(counts, "category", "o"))
    assert (r.statistic, r.dof, r.p_value) == pytest.approx((0.125, 4, 0.998126379239318), abs=1e-9)
    assert list(r.asDict()) == hypothesis.RESULT
    flat = spark.createDataFrame([(i, 7.0) for i in range(5)], "category int, expected double")
    assert one(hypothesis.chi2_goodness_of_fit(counts, "category", "o", flat)).statistic == pytest.approx(0.125)


def test_chi2_expected_categories_on_one_side(spark):
    counts = spark.createDataFrame([("a", 6.0), ("b", 4.0)], "category string, o double")
    wanted = spark.createDataFrame([("a", 1.0), ("c", 1.0), ("b", 2.0)], "category string, expected double")
    # expected after rescaling: a 2.5, b 5, c 2.5
    assert one(hypothesis.chi2_goodness_of_fit(counts, "category", "o", wanted)).statistic == pytest.approx(4.9 + 0.2 + 2.5)


def test_chi2_independence(spark):
    cells = spark.createDataFrame([(i, j, v) for i, row in enumerate([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]]) for j, v in enumerate(row)], "a int, b int, w double")
    r = one(hypothesis.chi2_independence(cells, "a", "b", "w"))
    assert (r.statistic, r.dof, r.p_value) == pytest.approx((0.14141414, 2, 0.931734784568187), abs=1e-8)


def test_chi2_by_feature(spark):
    df = spark.createDataFrame([(1.0, [1.0, 0.0, 3.0]), (1.0, [1.0, 2.0, 0.0]), (-1.0, [-1.0, 0.0, -0.5])], "label double, features array<double>")
    got = [(r.statistic, r.dof, r.p_value) for r in hypothesis.chi2_by_feature(df).orderBy("feature").collect()]
    for mine, known in zip(got, [(3, 1, 0.083264517), (0.75, 1, 0.386476231), (3, 2, 0.223130160)]):
        assert mine == pytest.approx(known, abs=1e-8)
    built_in = ChiSquareTest.test(with_vector(df, "features"), "features", "label", flatten=True).orderBy("featureIndex").collect()
    assert [r.pValue for r in built_in] == pytest.approx([p for _, _, p in got], abs=1e-10)


def test_ks(spark):
    df = spark.createDataFrame([(v,) for v in [0.1, 0.15, 0.2, 0.3, 0.25]], "v double")
    r = one(hypothesis.ks_normal(df, "v"))
    assert (r.statistic, r.p_value) == pytest.approx((0.539827837277029, 0.06821463111921133), abs=1e-10)


def test_ks_matches_built_in(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.gauss(0.05, 1.1),) for _ in range(800)], "v double")
    mine, built_in = one(hypothesis.ks_normal(df, "v")), one(KolmogorovSmirnovTest.test(df, "v", "norm", 0.0, 1.0))
    assert mine.statistic == pytest.approx(built_in.statistic, abs=1e-10)
    assert mine.p_value == pytest.approx(built_in.pValue, abs=2e-4)


def test_welch(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 9.0]
    df = spark.createDataFrame([(False, v) for v in a] + [(True, v) for v in b], "t boolean, v double")
    r = one(hypothesis.welch_test(df, F.col("t"), "v"))
    va, vb = 5 / 3 / 4, 13 / 3
    assert r.statistic == pytest.approx((2.5 - 5.0) / math.sqrt(va + vb))
    assert r.dof == pytest.approx((va + vb) ** 2 / (va**2 / 3 + vb**2 / 2))
    assert 0.3 < r.p_value < 0.4


def test_normal_and_erfc(spark):
    xs = [-9.0, -4.2, -1.0, -0.4688, -0.3, 0.0, 0.2, 0.46875, 0.7, 2.0, 3.999, 4.0, 5.5, 12.0]
    for r in spark.createDataFrame([(x,) for x in xs], "x double").select("x", erfc(F.col("x")).alias("e"), normal_cdf(F.col("x"), 1.0, 2.0).alias("c")).collect():
        assert r.e == pytest.approx(math.erfc(r.x), rel=1e-13)
        assert r.c == pytest.approx(0.5 * math.erfc(-(r.x - 1) / 2 / math.sqrt(2)), rel=1e-12)


def test_p_values(spark):
    rows = spark.createDataFrame([(12.0, 5.0), (300.0, 250.0), (0.0, 3.0), (2.0, 2.0)], "s double, d double")
    got = [r.p for r in rows.select(chi2_p_value("s", "d").alias("p")).collect()]
    assert got == pytest.approx([0.034787782, 0.0165, 1.0, math.exp(-1.0)], abs=2e-4)
    # t with 1 and 2 degrees of freedom has closed forms
    t = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (-2.0, 2.0), (0.0, 7.0)], "s double, d double")
    got = [r.p for r in t.select(student_t_p_value("s", "d").alias("p")).collect()]
    assert got == pytest.approx([0.5, 1 - 2 / math.sqrt(6), 1 - 2 / math.sqrt(6), 1.0], abs=1e-10)
    k = spark.createDataFrame([(0.05, 140.0), (0.05, 141.0), (0.0, 10.0), (1.0, 10.0)], "s double, d double")
    small, large, zero, full = [r.p for r in k.select(kolmogorov_p_value("s", "d").alias("p")).collect()]
    assert small == pytest.approx(large, abs=5e-3) and (zero, full) == (1.0, 0.0)
