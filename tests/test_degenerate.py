"""Malformed lines, degenerate inputs and users without relevant items."""

import math
import os
import subprocess
import sys
import textwrap

import numpy as np
import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.mllib.evaluation import RankingMetrics
from pyspark.sql import functions as F

from statweave.functions.distributions import _gamma_upper, _kolmogorov_upper
from statweave.operators import descriptive, supervised
from statweave.operators.binary_metrics import BinaryCurves, error_rate
from statweave.operators.clustering import assign_clusters
from statweave.operators.features import matrix_product
from statweave.operators.ranking_metrics import ranking_summary, ranking_summary_long
from statweave.operators.regression_metrics import regression_metrics
from statweave.operators.sampling import stratified_exact
from statweave.plans.prefix_sum import global_prefix_sum, row_index
from statweave.sources import text

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_short_lines_become_nulls(spark):
    good, bad = text.split_bad_rows(text.shape_ratings(lines(spark, "1,2,3", "1,2", "5", "")), ["user", "item", "rating"])
    assert [tuple(r) for r in good.collect()] == [(1, 2, 3.0)] and len(bad.collect()) == 3
    assert [tuple(r) for r in text.shape_ratings(lines(spark, "1.2.3"), ".").collect()] == [(1, 2, 3.0)]
    assert [tuple(r) for r in text.shape_ab_samples(lines(spark, "true,1.5", "true", "")).collect()] == [(True, 1.5), (True, None), (False, None)]
    assert text.shape_labeled_vectors(lines(spark, "1,2 3", "7")).collect()[1].features is None
    assert text.shape_labeled_pairs(lines(spark, "1 1:5 1:6 3:2", "2"), 3).collect()[0].features == [5.0, 0.0, 2.0]


def test_one_class_constant_column_and_constant_label(spark):
    one = spark.createDataFrame([(0.2, 1.0, 1.0), (0.7, 1.0, None)], "score double, label double, prediction double")
    assert BinaryCurves(one).area_under_roc().first()[0] is None
    assert BinaryCurves(one, prediction="prediction").summary().first().area_under_roc is None
    rate = error_rate(one).first()
    assert (rate.n, rate.missing, rate.errors, rate.error_rate) == (1, 1, 0, 0.0)
    flat = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "x double, y double")
    assert descriptive.pearson(flat, "x", "y").first()[0] is None and descriptive.spearman(flat, "x", "y").first()[0] is None
    assert regression_metrics(flat, "x", "y").first().r2 is None


def test_ranking_counts_users_without_relevant_items(spark):
    rows = [(1, ["a", "b", "c"], ["a", "c"]), (2, ["a", "d", "e"], []), (3, ["x", "y", "z"], ["q"])]
    lists = spark.createDataFrame(rows, "user int, prediction array<string>, label array<string>")
    predictions = lists.select("user", F.posexplode("prediction").alias("rank", "item")).withColumn("rank", F.col("rank") + 1)
    truth = lists.select("user", F.explode("label").alias("item"))
    want = RankingMetrics(spark.sparkContext.parallelize([(p, l) for _, p, l in rows]))
    for got in (ranking_summary(lists).first(), ranking_summary_long(predictions, truth).first()):
        assert got.mean_average_precision == pytest.approx(want.meanAveragePrecision)
        for k in (1, 3):
            assert got[f"precision_at_{k}"] == pytest.approx(want.precisionAt(k))
            assert got[f"ndcg_at_{k}"] == pytest.approx(want.ndcgAt(k))
    more = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "user int")
    wider = ranking_summary_long(predictions, truth, users=more).first()
    assert wider.precision_at_1 == pytest.approx(want.precisionAt(1) * 3 / 4)


def test_prefix_sums_over_text_and_nan(spark):
    rows = spark.createDataFrame([(w,) for w in "delta alpha charlie bravo alpha".split()], "k string")
    got = {r.k: r.cum_n for r in global_prefix_sum(rows, "k", {"n": F.lit(1)}, buckets=3).collect()}
    assert got == {"alpha": 2, "bravo": 3, "charlie": 4, "delta": 5}
    for buckets in (1, 4):
        with pytest.raises(Exception, match="NaN"):
            global_prefix_sum(spark.createDataFrame([(1.0,), (math.nan,)], "k double"), "k", {"n": F.lit(1)}, buckets=buckets).collect()
    with pytest.raises(Exception, match="not unique"):
        row_index(rows, "k").collect()


def test_null_vectors_on_both_sides_of_the_expression_size(spark):
    for width in (3, 40):
        rows = spark.createDataFrame([(1, [1.0] * width), (2, None)], "id int, features array<double>")
        near = {r.id: (r.cluster, r.distance) for r in assign_clusters(rows, [[0.0] * width, [1.0] * width] * 4).collect()}
        assert near == {1: (1, 0.0), 2: (None, None)}
        product = {r.id: r["product"] for r in matrix_product(rows, np.ones((width, 10))).collect()}
        assert product == {1: [float(width)] * 10, 2: None}


def test_long_naive_bayes_equals_the_estimator(spark):
    docs = [(1, 0.0, "a a b"), (2, 0.0, "a c"), (3, 1.0, "b b d"), (4, 1.0, "d e"), (5, 1.0, "")]
    df = spark.createDataFrame(docs, "doc int, label double, text string").withColumn("w", F.filter(F.split("text", " "), lambda x: x != ""))
    counts = df.select("doc", "label", F.explode("w").alias("term")).groupBy("doc", "label", "term").agg(F.count("*").alias("n"))
    prior, likelihood = supervised.naive_bayes_parameters(counts)
    got = {r.doc: (r.prediction, r.score) for r in supervised.score_naive_bayes(prior, likelihood, counts, df.select("doc", "label")).collect()}
    vectors = CountVectorizer(inputCol="w", outputCol="features").fit(df).transform(df)
    model = supervised.fit_naive_bayes(vectors.where("doc < 5"))
    want = {r.doc: (r.prediction, r.score) for r in supervised.score(model, vectors).collect()}
    assert set(got) == set(want)
    for doc in want:
        assert got[doc][0] == want[doc][0] and got[doc][1] == pytest.approx(want[doc][1])


def test_exact_strata_of_tiny_fractions(spark):
    rows = spark.range(100).select(F.lit("a").alias("k"), "id")
    assert stratified_exact(rows, "k", {"a": 1e-11}, ["id"]).count() == 1


@pytest.mark.parametrize("n", [150, 500, 3000])
def test_kolmogorov_tail_equals_spark(spark, n):
    sample = spark.range(n).select((F.randn(3) * 1.03 + 0.04).alias("v"))
    want = KolmogorovSmirnovTest.test(sample, "v", "norm", 0.0, 1.0).first()
    assert _kolmogorov_upper(want.statistic, n) == pytest.approx(want.pValue, abs=1e-6)
    assert _gamma_upper(2.0, math.inf) == 0.0


def test_p_values_from_another_folder(tmp_path):
    """Workers do not need the package on their path."""
    code = f"""
        import sys
        sys.path.insert(0, {REPO!r})
        import __spark_entry__ as e
        from statweave.session import build_session
        spark = build_session("local[1]", 1, "1g")
        print("P", e.queries()["chi2_gof_expected"](spark, "/root/testdata/sf0.001").collect()[0].p_value is not None)
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "P True" in done.stdout, done.stderr[-1500:]
