"""Text shaping, sinks and model storage."""

import pytest
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array

from statweave.operators import clustering, supervised
from statweave.sources import text
from statweave.sources.models import centers_table, coefficients_table, load_model, save_model
from statweave.sources.tables import spread, table


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_ratings(spark):
    rows = text.shape_ratings(lines(spark, "1,2,5.0", "3,x,1.0", "bad"))
    good, bad = text.split_bad_rows(rows, ["user", "item", "rating"])
    assert [tuple(r) for r in good.collect()] == [(1, 2, 5.0)] and bad.count() == 2
    assert [tuple(r) for r in text.shape_ratings(lines(spark, "0::3::4"), "::", -2.5).collect()] == [(0, 3, 1.5)]


def test_vectors(spark):
    got = [r.features for r in text.shape_vectors(lines(spark, "0.1 0.2  0.3", " 9 9.1 9.2 ")).collect()]
    assert got == [[0.1, 0.2, 0.3], [9.0, 9.1, 9.2]]
    rows = text.shape_vectors(lines(spark, "1 two"))
    good, bad = text.split_bad_rows(rows, ["features"])
    assert good.count() == 0 and bad.count() == 1


def test_labeled_lines_keep_every_feature(spark):
    r = text.shape_labeled_vectors(lines(spark, "-0.4,-1.6 -2.0 3")).collect()[0]
    assert (r.label, r.features) == (-0.4, [-1.6, -2.0, 3.0])
    got = [tuple(r) for r in text.shape_labeled_pairs(lines(spark, "1 1:0.5 3:-2", "0", "-1 2:7e-1"), 3).collect()]
    assert got == [(1.0, [0.5, 0.0, -2.0]), (0.0, [0.0, 0.0, 0.0]), (-1.0, [0.0, 0.7, 0.0])]


def test_baskets_and_samples(spark):
    assert [r["items"] for r in text.shape_baskets(lines(spark, "r z h r", "z")).collect()] == [["r", "z", "h"], ["z"]]
    got = [tuple(r) for r in text.shape_ab_samples(lines(spark, "false, -3.92", "true, 99.32", "TRUE,1", "yes,2")).collect()]
    assert got == [(False, -3.92), (True, 99.32), (True, 1.0), (False, 2.0)]


def test_libsvm(spark, tmp_path):
    path = str(tmp_path / "points")
    lines(spark, "1 1:2.0 4:-1.0", "0 2:3.5").coalesce(1).write.text(path)
    got = text.read_libsvm(spark, path, 4).select("label", vector_to_array("features").alias("f"))
    assert sorted(map(tuple, got.collect())) == [(0.0, [0.0, 3.5, 0.0, 0.0]), (1.0, [2.0, 0.0, 0.0, -1.0])]
    assert text.read_lines(spark, path).count() == 2
    assert len(text.read_libsvm(spark, path).first().features) == 4


def test_feature_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, [0.5, -2.0]), (2, [1e-9, 3.0])], "id bigint, features array<double>")
    text.write_features_text(df, str(tmp_path / "t"))
    assert sorted(r.value for r in text.read_lines(spark, str(tmp_path / "t")).collect())[0] == "1,[0.5, -2.0]"
    assert sorted(map(tuple, text.read_features_text(spark, str(tmp_path / "t")).collect())) == sorted(map(tuple, df.collect()))
    text.write_features(df, str(tmp_path / "p"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "p")).collect())) == sorted(map(tuple, df.collect()))


def test_model_round_trip(spark, tmp_path):
    df = spark.createDataFrame([([float(i)],) for i in (0, 1, 9, 10)], "features array<double>")
    model = clustering.fit_kmeans(df)
    loaded = load_model(KMeansModel, save_model(model, str(tmp_path / "kmeans")))
    assert sorted(r.center for r in centers_table(spark, loaded.clusterCenters()).collect()) == [[0.5], [9.5]]


def test_coefficients(spark):
    rows = spark.createDataFrame([(3.0, [1.0, 0.0]), (4.0, [0.0, 2.0]), (5.0, [1.0, 1.0])], "label double, features array<double>")
    got = {r.feature: r.value for r in coefficients_table(spark, supervised.fit_linear_regression(rows)).collect()}
    assert got == pytest.approx({0: 3.0, 1: 2.0, -1: 0.0}, abs=1e-9)


def test_spread(spark, sf):
    events = table(spark, sf, "events")
    wide = spread(events)
    assert wide.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert wide.count() == events.count()
    made = spark.range(10)
    assert spread(made) is made


def test_spread_bounds_the_rows_of_a_task(spark, sf):
    events = table(spark, sf, "events")
    slots = spark.sparkContext.defaultParallelism
    wide = spread(events, rows=events.count() // (3 * slots))
    assert wide.rdd.getNumPartitions() >= 3 * slots and wide.count() == events.count()


def test_spread_bounds_the_rows_of_a_task_of_a_table_in_many_splits(spark):
    slots = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 10_000 * slots, 1, slots)
    wide = spread(rows, rows=2_000)
    sizes = [len(part) for part in wide.rdd.glom().collect()]
    assert wide.count() == 10_000 * slots and max(sizes) <= 4_000
