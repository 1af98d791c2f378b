"""Feature transforms, estimators and mining on literals with known answers and on invariants."""

import numpy as np
import pytest
from pyspark.ml.feature import UnivariateFeatureSelector
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from statweave.functions.arrays import append_bias, binarise, clamp, discretise, elementwise_product, with_vector
from statweave.operators import class_metrics, clustering, features, mining, recommendation, supervised
from statweave.operators.regression_metrics import regression_metrics
from statweave.queries.models import returned_lines

# The literals below are well-known example inputs, and the results that must match them.

ROWS = [(1.12, 2.05, 3.12), (5.56, 6.28, 8.94), (10.2, 8.0, 20.5)]


@pytest.fixture(scope="module")
def matrix(spark):
    return spark.createDataFrame([(i, list(r)) for i, r in enumerate(ROWS)], "id int, features array<double>")


def test_row_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([4.0, 5.0, 6.0],)], "features array<double>")
    assert [r[0] for r in df.select(elementwise_product(F.col("features"), [0, 1, 2])).collect()] == [[0, 2, 6], [0, 5, 12]]
    batch = features.scale_vectors(with_vector(df, "features"), [0.0, 1.0, 2.0]).select(vector_to_array("scaled"))
    assert [r[0] for r in batch.collect()] == [[0, 2, 6], [0, 5, 12]]
    assert df.select(append_bias(F.col("features"))).first()[0] == [1, 2, 3, 1]
    assert df.select(discretise(F.array(F.lit(-1.0), F.lit(16.0), F.lit(255.0)), 16)).first()[0] == [-1, 1, 15]
    x = spark.createDataFrame([(-1.0,), (0.0,), (0.4,), (3.0,)], "x double")
    assert [tuple(r) for r in x.select(clamp(F.col("x"), 0, 1), binarise(F.col("x"))).collect()] == [(0, 0), (0, 0), (0.4, 1), (1, 1)]


def test_pca(matrix):
    model = features.principal_components(matrix, 3)
    got = features.project_components(model, matrix).orderBy("id").select(vector_to_array("pca")).collect()
    known = np.abs([(-3.7278, -0.6668, 0.9221), (-11.8226, -3.1067, 0.9221), (-24.2171, -0.9858, 0.9221)])
    assert np.abs([r[0] for r in got]) == pytest.approx(known, abs=1e-3)


def test_svd(matrix):
    u, s, v = features.truncated_svd(matrix, 3)
    assert s == pytest.approx([27.338366804, 2.437246302, 0.656072359], abs=1e-8)
    left = np.array([r.u for r in u.orderBy("id").collect()])
    assert left @ np.diag(s) @ v.T == pytest.approx(np.array(ROWS), abs=1e-8)
    assert left.T @ left == pytest.approx(np.eye(3), abs=1e-8)


@pytest.mark.parametrize("width", [3, 400])
def test_matrix_product_forms(spark, matrix, width):
    local = np.random.default_rng(1).normal(size=(3, width))
    got = np.array([r.product for r in features.matrix_product(matrix, local).orderBy("id").collect()])
    assert got == pytest.approx(np.array(ROWS) @ local, abs=1e-9)
    cells = matrix.select(F.col("id").alias("row"), F.posexplode("features").alias("j", "value"))
    weights = spark.createDataFrame([(j, k, float(local[j, k])) for j in range(3) for k in range(width)], "j int, k int, weight double")
    long = {(r.row, r.k): r.value for r in features.matrix_product_long(cells, weights).collect()}
    assert np.array([[long[i, k] for k in range(width)] for i in range(3)]) == pytest.approx(got, abs=1e-9)


def test_gramian(matrix):
    got = {(r.i, r.j): r.value for r in features.gramian(matrix).collect()}
    known = np.array(ROWS).T @ np.array(ROWS)
    assert np.array([[got[i, j] for j in range(3)] for i in range(3)]) == pytest.approx(known, abs=1e-9)


def test_chi2_selection_matches_built_in(spark):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(300):
        label = int(rng.integers(0, 3))
        rows.append((float(label), [float((label + rng.integers(0, 1 + i)) % 4) for i in range(8)]))
    df = spark.createDataFrame(rows, "label double, features array<double>")
    mine = features.chi2_top_features(df, 3)
    selector = UnivariateFeatureSelector(featuresCol="features", labelCol="label", outputCol="o", selectionMode="numTopFeatures")
    built_in = selector.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(3).fit(with_vector(df, "features"))
    assert mine == sorted(built_in.selectedFeatures)
    kept = features.keep_features(df, mine).first()
    assert kept.selected == [kept.features[p] for p in mine]


def test_kmeans(spark):
    points = [0.0, 0.1, 0.2, 9.0, 9.1, 9.2]
    df = spark.createDataFrame([([p] * 3,) for p in points], "features array<double>")
    model = clustering.fit_kmeans(df, 2, 20)
    centers = sorted(list(map(float, c)) for c in model.clusterCenters())
    assert np.array(centers) == pytest.approx(np.array([[0.1] * 3, [9.1] * 3]))
    assert clustering.clustering_cost(df, centers).first().cost == pytest.approx(0.12)
    assert model.summary.trainingCost == pytest.approx(0.12)
    assert [r.cluster for r in clustering.assign_clusters(df, centers).collect()] == [0, 0, 0, 1, 1, 1]


def test_nearest_center_forms_agree(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(50)], "id int, features array<double>")
    centers = rng.normal(size=(60, 8))
    many = {r.id: (r.cluster, r.distance) for r in clustering.assign_clusters(df, centers.tolist()).collect()}
    for r in df.collect():
        distances = ((np.array(r.features) - centers) ** 2).sum(axis=1)
        assert many[r.id] == (int(distances.argmin()), pytest.approx(float(distances.min()), abs=1e-9))
    few = clustering.assign_clusters(df, centers[:5].tolist()).collect()
    for r in few:
        assert r.cluster == int(((np.array(r.features) - centers[:5]) ** 2).sum(axis=1).argmin())


def test_bisecting_kmeans(spark):
    df = spark.createDataFrame([([v, v],) for v in (0.1, 0.3, 10.1, 10.3, 20.1, 20.3, 30.1, 30.3)], "features array<double>")
    centers = sorted(list(map(float, c)) for c in clustering.fit_bisecting_kmeans(df).clusterCenters())
    assert np.array(centers) == pytest.approx(np.array([[c, c] for c in (0.2, 10.2, 20.2, 30.2)]))
    assert clustering.clustering_cost(df, centers).first().cost == pytest.approx(0.16)


def test_gaussian_mixture(spark):
    rng = np.random.default_rng(4)
    data = [([float(v)],) for v in np.concatenate([rng.normal(0, 1, 200), rng.normal(20, 1, 100)])]
    df = spark.createDataFrame(data, "features array<double>")
    rows = clustering.mixture_table(clustering.fit_gaussian_mixture(df), df).collect()
    assert sum(r.weight for r in rows) == pytest.approx(1.0)
    assert sorted(r.mean[0] for r in rows) == pytest.approx([0, 20], abs=0.5)


def test_power_iteration(spark):
    edges = spark.createDataFrame([(0, 1, 0.9), (1, 2, 0.9), (2, 3, 0.9), (3, 4, 0.1), (4, 5, 0.9)], "src bigint, dst bigint, weight double")
    rows = clustering.power_iteration_clusters(edges).collect()
    assert {r.id for r in rows} == set(range(6)) and {r.cluster for r in rows} <= {0, 1}
    both = spark.createDataFrame([(1, 2, 1.0), (2, 1, 2.0), (3, 3, 9.0)], "src bigint, dst bigint, weight double")
    assert [tuple(r) for r in clustering.similarity_edges(both).collect()] == [(1, 2, 3.0)]


def test_lda(spark):
    counts = [[1, 2, 6, 0, 2], [1, 3, 0, 1, 3], [1, 4, 1, 0, 0], [2, 1, 0, 3, 0], [3, 1, 1, 9, 3]]
    df = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(counts)], "doc_id int, features array<double>")
    model = clustering.fit_lda(df, 3, 10)
    terms = clustering.topic_terms(model).groupBy("topic").agg(F.sum("weight").alias("w"), F.count("*").alias("n")).collect()
    assert len(terms) == 3 and all(r.n == 5 and r.w == pytest.approx(1.0) for r in terms)
    mixtures = clustering.topic_mixtures(model, df).collect()
    assert all(sum(r.topics) == pytest.approx(1.0) for r in mixtures)


BASKETS = ["r z h k p", "z y x w v u t s", "s x o n r", "x z y m t s q e", "z", "x z y r q t p"]


def test_frequent_itemsets(spark):
    df = spark.createDataFrame([(b.split(),) for b in BASKETS], "items array<string>")
    model = mining.fit_fp_growth(df, 0.2, 0.8, partitions=10)
    itemsets = mining.frequent_itemsets(model)
    sizes = {r.k: r.n for r in itemsets.groupBy(F.size("items").alias("k")).agg(F.count("*").alias("n")).collect()}
    assert sizes == {1: 8, 2: 18, 3: 17, 4: 9, 5: 2}
    rules = {(tuple(r.antecedent), tuple(r.consequent)): r.confidence for r in mining.association_rules(model).collect()}
    assert len(rules) == 85
    own = {(tuple(r.antecedent), tuple(r.consequent)): r.confidence for r in mining.rules_from_itemsets(itemsets, 0.8).collect()}
    assert own == pytest.approx(rules)


def test_rules_from_itemsets(spark):
    df = spark.createDataFrame([(["a"], 15), (["b"], 35), (["b", "a"], 12)], "items array<string>, freq bigint")
    assert [tuple(r) for r in mining.rules_from_itemsets(df, 0.8).collect()] == [(["a"], ["b"], 0.8)]


def test_sequential_patterns(spark):
    rows = [([[1, 2], [3]],), ([[1], [3, 2], [1, 2]],), ([[1, 2], [5]],), ([[6]],)]
    df = spark.createDataFrame(rows, "sequence array<array<int>>")
    got = {str(r.sequence): r.freq for r in mining.sequential_patterns(df).collect()}
    assert got == {"[[1]]": 3, "[[2]]": 3, "[[3]]": 2, "[[1, 2]]": 3, "[[1], [3]]": 2}


def test_als(spark):
    likes = {1: (1, 3), 2: (1, 3), 3: (2, 4), 4: (2, 4)}
    rows = [(u, i, 5.0 if i in likes[u] else 1.0) for u in likes for i in (1, 2, 3, 4)]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    model = recommendation.fit_als(ratings, blocks=2)
    assert regression_metrics(recommendation.predict_ratings(model, ratings), label="rating").first().mse < 1e-3
    best = recommendation.recommend(model, 2, scale=True)
    assert {(r.user, tuple(sorted(r.prediction))) for r in recommendation.recommended_lists(best).collect()} == set(likes.items())
    assert {r.rating for r in best.collect()} == {1.0}
    assert recommendation.user_factors(model).count() == 4 and len(recommendation.item_factors(model).first().features) == 10
    ids = recommendation.integer_ids(spark.createDataFrame([(10**12,), (5,), (5,), (None,)], "k bigint"), "k", "user")
    assert {tuple(r) for r in ids.collect()} == {(5, 0), (10**12, 1)}


def test_isotonic(spark):
    rng = np.random.default_rng(5)
    rows = [(float(y), float(x)) for x, y in zip(rng.integers(0, 30, 400), rng.normal(0, 1, 400))]
    df = spark.createDataFrame([(y + x / 20, x) for y, x in rows], "y double, x double")
    points = supervised.isotonic_input(df, "y", "x")
    assert points.agg(F.sum("weight")).first()[0] == 400
    model = supervised.fit_isotonic(points)
    fitted = [r.prediction for r in supervised.isotonic_points(model, df).orderBy("boundary").collect()]
    assert fitted == sorted(fitted)
    raw = supervised.fit_isotonic(df.select(F.col("y").alias("label"), F.array("x").alias("features")))
    a = supervised.score(model, points).orderBy("features").select("prediction").collect()
    b = supervised.score(raw, points).orderBy("features").select("prediction").collect()
    assert [r[0] for r in a] == pytest.approx([r[0] for r in b], abs=1e-9)


def test_naive_bayes_parameters(spark):
    counts = spark.createDataFrame([("d1", 0.0, "a", 2), ("d1", 0.0, "b", 1), ("d2", 0.0, "a", 1), ("d3", 1.0, "c", 4)], "doc string, label double, term string, n bigint")
    priors, likelihoods = supervised.naive_bayes_parameters(counts)
    got = {r.label: (r.log_prior, r.log_absent) for r in priors.collect()}
    assert got[0.0] == pytest.approx((np.log(3 / 5), -np.log(7))) and got[1.0] == pytest.approx((np.log(2 / 5), -np.log(7)))
    terms = {(r.label, r.term): r.log_likelihood for r in likelihoods.collect()}
    assert terms == pytest.approx({(0.0, "a"): np.log(4 / 7), (0.0, "b"): np.log(2 / 7), (1.0, "c"): np.log(5 / 7)})


@pytest.fixture(scope="module")
def lines(spark, sf):
    return returned_lines(spark, sf).withColumn("label", (F.element_at("features", 1) + F.element_at("features", 3) > 1.0).cast("double"))


@pytest.mark.parametrize(
    "fit", [supervised.fit_tree_classifier, supervised.fit_forest_classifier, supervised.fit_boosted_classifier, supervised.fit_naive_bayes,
            supervised.fit_linear_svm, supervised.fit_logistic],
)
def test_classifiers_learn_a_simple_rule(lines, fit):
    scored = supervised.score(fit(lines), lines)
    assert "score" in scored.columns
    accuracy = class_metrics.accuracy(class_metrics.confusion_counts(scored)).first().accuracy
    floor = 0.9 if fit.__name__.split("_")[1] in ("tree", "boosted") else 0.45
    assert accuracy > floor


@pytest.mark.parametrize("fit", [supervised.fit_tree_regressor, supervised.fit_forest_regressor, supervised.fit_boosted_regressor])
def test_regressors_learn_a_simple_rule(lines, fit):
    rows = lines.withColumn("label", F.element_at("features", 2) * 3)
    assert regression_metrics(supervised.score(fit(rows), rows)).first().r2 > 0.5


def test_loss_history_falls(lines):
    model, history = supervised.fit_l2_logistic(lines)
    losses = [r.loss for r in history.orderBy("iteration").collect()]
    assert len(losses) <= 21 and losses == sorted(losses, reverse=True)


def test_tree_nodes(spark, lines, tmp_path):
    model = supervised.fit_tree_classifier(lines, depth=3)
    nodes = supervised.tree_nodes(model, str(tmp_path / "tree"), lines).collect()
    assert len(nodes) == model.numNodes and {n.tree_id for n in nodes} == {0}
    forest = supervised.fit_forest_classifier(lines, trees=3, depth=2)
    nodes = supervised.tree_nodes(forest, str(tmp_path / "forest"), lines).collect()
    assert {n.tree_id for n in nodes} == {0, 1, 2} and len(nodes) == forest.totalNumNodes


def test_matrix_product_goes_from_buffer_to_buffer(spark):
    rng = np.random.default_rng(2)
    rows, local = rng.normal(size=(50, 40)), rng.normal(size=(40, 9))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)] + [(99, None)], "id int, features array<double>")
    product = features.matrix_product(df, local)
    assert "ArrowEvalPython" in product._jdf.queryExecution().executedPlan().toString()
    got = {r.id: r["product"] for r in product.collect()}
    assert got[99] is None and np.allclose([got[i] for i in range(50)], rows @ local)
