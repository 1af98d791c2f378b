"""Evaluation metrics on literals and against Spark's own evaluators."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RankingEvaluator
from pyspark.sql import functions as F

from statweave.operators import class_metrics, ranking_metrics
from statweave.operators.binary_metrics import BinaryCurves, error_rate
from statweave.operators.regression_metrics import regression_metrics


def one(df):
    (row,) = df.collect()
    return row


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(1.0, 1.0)] * 2 + [(1.0, 0.0), (0.0, 1.0)] + [(0.0, 0.0)] * 3
    return spark.createDataFrame(rows, "score double, label double")


def test_hard_label_areas(hard):
    curves = BinaryCurves(hard)
    assert one(curves.area_under_roc())[0] == pytest.approx(0.7083333, abs=1e-6)
    assert one(curves.area_under_pr())[0] == pytest.approx(0.6269841, abs=1e-6)


def test_hard_label_curves(hard):
    curves = BinaryCurves(hard)
    assert sorted(r.threshold for r in curves.thresholds().collect()) == [0.0, 1.0]
    assert {r.threshold: round(r.precision, 6) for r in curves.precision().collect()} == {1.0: 0.666667, 0.0: 0.428571}
    assert {r.threshold: round(r.recall, 6) for r in curves.recall().collect()} == {1.0: 0.666667, 0.0: 1.0}
    assert {r.threshold: round(r.f_measure, 6) for r in curves.f_measure().collect()} == {1.0: 0.666667, 0.0: 0.6}
    assert {r.threshold: round(r.f_measure, 6) for r in curves.f_measure(2.0).collect()} == {1.0: 0.666667, 0.0: 0.789474}
    assert sorted((round(r.fpr, 4), round(r.tpr, 4)) for r in curves.roc().collect()) == [(0, 0), (0.25, 0.6667), (1, 1), (1, 1)]
    assert sorted((round(r.recall, 4), round(r.precision, 4)) for r in curves.pr().collect()) == [(0, 0.6667), (0.6667, 0.6667), (1, 0.4286)]


def test_areas_match_the_exact_evaluator(spark):
    rng = random.Random(8)
    rows = [(round(rng.random(), 3) if i % 3 else 0.5, float(rng.random() < 0.3)) for i in range(4000)]
    df = spark.createDataFrame(rows, "score double, label double").withColumn("prediction", (F.col("score") > 0.5).cast("double"))
    summary = one(BinaryCurves(df, prediction="prediction").summary())
    for metric, mine in (("areaUnderROC", summary.area_under_roc), ("areaUnderPR", summary.area_under_pr)):
        exact = BinaryClassificationEvaluator(rawPredictionCol="score", metricName=metric, numBins=0).evaluate(df)
        assert mine == pytest.approx(exact, abs=1e-12)
    errors = one(error_rate(df))
    assert (errors.n, errors.errors) == (summary.n, summary.errors) and errors.accuracy == pytest.approx(summary.accuracy)


def test_bins(spark):
    df = spark.createDataFrame([(i / 1000, float(i % 3 == 0)) for i in range(1000)], "score double, label double")
    full, binned = BinaryCurves(df), BinaryCurves(df, bins=10)
    assert binned.table.count() == 10
    points = {r.threshold: (r.tp, r.fp) for r in full.table.collect()}
    assert all(points[r.threshold] == (r.tp, r.fp) for r in binned.table.collect())
    assert one(binned.area_under_roc())[0] == pytest.approx(one(full.area_under_roc())[0], abs=0.01)


def test_multiclass(spark):
    rng = random.Random(9)
    rows = [(float(rng.randint(0, 3)), float(rng.randint(0, 2))) for _ in range(500)]
    df = spark.createDataFrame(rows, "prediction double, label double")
    counts = class_metrics.confusion_counts(df)
    matrix = {(r.label, r.prediction): r.n for r in class_metrics.confusion_matrix(counts).collect()}
    assert len(matrix) == 16 and sum(matrix.values()) == 500 and matrix[3.0, 0.0] == 0
    weighted = one(class_metrics.weighted(counts))
    for name, mine in {
        "accuracy": one(class_metrics.accuracy(counts)).accuracy,
        "weightedPrecision": weighted.weighted_precision,
        "weightedRecall": weighted.weighted_recall,
        "weightedFMeasure": weighted.weighted_f_measure,
        "weightedFalsePositiveRate": weighted.weighted_false_positive_rate,
    }.items():
        assert mine == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(df), abs=1e-12), name
    rows = {r.label: r for r in class_metrics.per_class(counts).collect()}
    for label in (0.0, 1.0, 2.0):
        for name, mine in (("precisionByLabel", rows[label].precision), ("recallByLabel", rows[label].recall), ("fMeasureByLabel", rows[label].f_measure)):
            assert mine == pytest.approx(MulticlassClassificationEvaluator(metricName=name, metricLabel=label).evaluate(df), abs=1e-12)
    assert (rows[3.0].precision, rows[3.0].recall) == (0.0, 0.0)


def test_confusion_matrix_of_many_classes(spark):
    wide = spark.range(600).select(F.col("id").alias("label"), F.col("id").alias("prediction"), F.lit(1).alias("n"))
    full = class_metrics.confusion_matrix(wide)
    assert full.count() == 600 * 600 and full.where("n = 1").count() == 600


# fixed values: the multilabel example with known metrics
MULTILABEL = [
    ([0.0, 1.0], [0.0, 2.0]), ([0.0, 2.0], [0.0, 1.0]), ([], [0.0]), ([2.0], [2.0]),
    ([2.0, 0.0], [2.0, 0.0]), ([0.0, 1.0, 2.0], [0.0, 1.0]), ([1.0], [1.0, 2.0]),
]


def test_multilabel(spark):
    df = spark.createDataFrame(MULTILABEL, "prediction array<double>, label array<double>")
    r = one(class_metrics.multilabel_summary(df))
    known = {
        "recall": 0.642857, "precision": 0.666667, "f1": 0.638095, "accuracy": 0.547619, "micro_recall": 0.666667,
        "micro_precision": 0.727273, "micro_f1": 0.695652, "hamming_loss": 0.333333, "subset_accuracy": 0.285714,
    }
    assert r.asDict() == pytest.approx(known, abs=1e-6)
    classes = {r.label: (r.precision, r.recall, r.f1) for r in class_metrics.multilabel_per_class(df).collect()}
    assert classes[0.0] == pytest.approx((1.0, 0.8, 0.888889), abs=1e-6)
    assert classes[1.0] == pytest.approx((0.666667,) * 3, abs=1e-6)
    assert classes[2.0] == pytest.approx((0.5,) * 3, abs=1e-6)


RANKED = [([1, 6, 2, 7, 8, 3, 9, 10, 4, 5], [1, 2, 3, 4, 5]), ([4, 1, 5, 6, 2, 7, 3, 8, 9, 10], [1, 2, 3]), ([1, 2, 3, 4, 5], [])]


def test_ranking(spark):
    df = spark.createDataFrame(RANKED, "prediction array<int>, label array<int>")
    r = one(ranking_metrics.ranking_summary(df))
    assert (r.precision_at_1, r.precision_at_5, r.ndcg_at_3, r.mean_average_precision) == pytest.approx((0.333333, 0.266667, 0.333333, 0.355026), abs=1e-6)
    short = spark.createDataFrame([([1, 2], [1, 2, 3, 4, 5, 6, 7])], "prediction array<int>, label array<int>")
    r = one(ranking_metrics.ranking_summary(short))
    assert (r.precision_at_5, r.ndcg_at_5, r.mean_average_precision) == pytest.approx((0.4, 0.553147, 0.285714), abs=1e-6)


def test_ranking_forms_agree_with_the_evaluator(spark):
    rng = random.Random(10)
    rows = [(u, rng.sample(range(30), rng.randint(1, 10)), rng.sample(range(30), rng.randint(1, 12))) for u in range(60)]
    df = spark.createDataFrame(rows, "user int, prediction array<int>, label array<int>")
    lists = one(ranking_metrics.ranking_summary(df)).asDict()
    predictions = df.select("user", F.posexplode("prediction").alias("p", "item")).withColumn("rank", F.col("p") + 1)
    truth = df.select("user", F.explode("label").alias("item"))
    assert one(ranking_metrics.ranking_summary_long(predictions, truth)).asDict() == pytest.approx(lists, abs=1e-12)
    doubles = df.select(F.col("prediction").cast("array<double>").alias("prediction"), F.col("label").cast("array<double>").alias("label"))
    for metric, k, name in (("precisionAtK", 3, "precision_at_3"), ("ndcgAtK", 5, "ndcg_at_5"), ("meanAveragePrecision", 10, "mean_average_precision")):
        assert lists[name] == pytest.approx(RankingEvaluator(metricName=metric, k=k).evaluate(doubles), abs=1e-12)


def test_regression(spark):
    df = spark.createDataFrame([(2.5, 3.0), (0.0, -0.5), (2.0, 2.0), (8.0, 7.0)], "prediction double, label double")
    r = one(regression_metrics(df))
    assert (r.explained_variance, r.mae, r.r2, r.rmse, r.sse) == pytest.approx((8.859375, 0.5, 0.948608, 0.612372, 1.5), abs=1e-6)
