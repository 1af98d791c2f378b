"""Classifiers and regressors with the parameters the jobs use, and their scoring.

Each ``fit_*`` takes a DataFrame with ``label`` and ``features`` (vector or array)
and returns a fitted ``pyspark.ml`` model. Linear models have no intercept unless
asked for. Estimators pass over their input several times, so it is kept while they fit.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    IsotonicRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statweave.functions.arrays import with_vector
from statweave.plans.staging import broadcast_if_small, persisted, stage
from statweave.sources.models import save_model


def _fit(estimator: Estimator, train: DataFrame) -> Model:
    """Fit on the columns that matter, held while the estimator passes over them."""
    columns = ["label", "features"] + (["weight"] if "weight" in train.columns else [])
    rows = with_vector(train.select(*columns), "features")
    with persisted(rows) as kept:
        return estimator.fit(kept)


def fit_logistic(train: DataFrame, intercept: bool = False, max_iter: int = 100, reg: float = 0.0) -> Model:
    """Binary logistic regression; the score is ``probability[1]``."""
    return _fit(LogisticRegression(family="binomial", fitIntercept=intercept, maxIter=max_iter, regParam=reg), train)


def fit_multinomial_logistic(train: DataFrame, intercept: bool = False, max_iter: int = 100, reg: float = 0.0) -> Model:
    """Multinomial logistic regression; the number of classes comes from the labels."""
    return _fit(LogisticRegression(family="multinomial", fitIntercept=intercept, maxIter=max_iter, regParam=reg), train)


def fit_l2_logistic(train: DataFrame, reg: float = 0.1, max_iter: int = 20, tol: float = 1e-4) -> tuple[Model, DataFrame]:
    """L2-regularised logistic regression with its loss after every iteration (``iteration, loss``)."""
    estimator = LogisticRegression(
        family="binomial", fitIntercept=True, standardization=False, regParam=reg, maxIter=max_iter, tol=tol
    )
    model = _fit(estimator, train)
    history = [(i, float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    return model, train.sparkSession.createDataFrame(history, "iteration int, loss double")


def fit_linear_svm(train: DataFrame, max_iter: int = 100, reg: float = 0.01) -> Model:
    """Linear support vector machine; the score is the margin ``rawPrediction[1]``."""
    return _fit(LinearSVC(maxIter=max_iter, regParam=reg, fitIntercept=False), train)


def fit_naive_bayes(train: DataFrame, smoothing: float = 1.0) -> Model:
    return _fit(NaiveBayes(smoothing=smoothing, modelType="multinomial"), train)


def fit_tree_classifier(train: DataFrame, depth: int = 5, bins: int = 32) -> Model:
    return _fit(DecisionTreeClassifier(impurity="gini", maxDepth=depth, maxBins=bins), train)


def fit_tree_regressor(train: DataFrame, depth: int = 5, bins: int = 32) -> Model:
    return _fit(DecisionTreeRegressor(impurity="variance", maxDepth=depth, maxBins=bins), train)


def fit_forest_classifier(
    train: DataFrame, trees: int = 3, depth: int = 5, bins: int = 32, seed: int = 12345, bootstrap: bool = True
) -> Model:
    estimator = RandomForestClassifier(
        numTrees=trees, featureSubsetStrategy="auto", impurity="gini", maxDepth=depth, maxBins=bins, seed=seed, bootstrap=bootstrap
    )
    return _fit(estimator, train)


def fit_forest_regressor(
    train: DataFrame, trees: int = 3, depth: int = 4, bins: int = 32, seed: int = 12345, bootstrap: bool = True
) -> Model:
    estimator = RandomForestRegressor(
        numTrees=trees, featureSubsetStrategy="auto", impurity="variance", maxDepth=depth, maxBins=bins, seed=seed, bootstrap=bootstrap
    )
    return _fit(estimator, train)


def fit_boosted_classifier(train: DataFrame, iterations: int = 3, depth: int = 5, seed: int = 12345) -> Model:
    return _fit(GBTClassifier(maxIter=iterations, maxDepth=depth, lossType="logistic", seed=seed), train)


def fit_boosted_regressor(train: DataFrame, iterations: int = 3, depth: int = 5, seed: int = 12345) -> Model:
    return _fit(GBTRegressor(maxIter=iterations, maxDepth=depth, lossType="squared", seed=seed), train)


def fit_linear_regression(train: DataFrame, intercept: bool = False, reg: float = 0.0) -> Model:
    """Least squares by the normal equations, one pass over the rows."""
    return _fit(LinearRegression(fitIntercept=intercept, regParam=reg, solver="normal"), train)


def fit_isotonic(train: DataFrame, increasing: bool = True, feature_index: int = 0) -> Model:
    """Isotonic regression on one feature, weighted when there is a ``weight`` column."""
    estimator = IsotonicRegression(isotonic=increasing, featureIndex=feature_index)
    if "weight" in train.columns:
        estimator = estimator.setWeightCol("weight")
    return _fit(estimator, train)


def isotonic_points(model: Model, df: DataFrame) -> DataFrame:
    """``boundary, prediction`` of a fitted isotonic model."""
    rows = list(zip(map(float, model.boundaries.toArray()), map(float, model.predictions.toArray())))
    return df.sparkSession.createDataFrame(rows, "boundary double, prediction double")


def isotonic_input(df: DataFrame, label: str, feature: str, weight: str | None = None) -> DataFrame:
    """``label, features, weight`` with one row per distinct feature value.

    The increasing fit depends only on the weighted mean and the weight at each
    feature value, so rows are combined before the sort of the fit.
    """
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    grouped = df.groupBy(F.col(feature).cast("double").alias("_x")).agg(
        F.sum(w * F.col(label)).alias("_sum"), F.sum(w).alias("weight")
    )
    return grouped.select(
        (F.col("_sum") / F.col("weight")).alias("label"), F.array("_x").alias("features"), "weight"
    )


def score(model: Model, df: DataFrame) -> DataFrame:
    """``df`` with ``prediction`` and, for binary classifiers, a real-valued ``score``."""
    scored = model.transform(with_vector(df, "features"))
    if "probability" in scored.columns:
        return scored.withColumn("score", F.element_at(vector_to_array("probability"), 2))
    if "rawPrediction" in scored.columns:
        return scored.withColumn("score", F.element_at(vector_to_array("rawPrediction"), 2))
    return scored


def tree_nodes(model: Model, path: str, df: DataFrame) -> DataFrame:
    """Nodes of a tree or an ensemble: saves the model to ``path`` and reads its node table.

    Columns ``tree_id, node_id, prediction, impurity, gain, left_child, right_child,
    feature, threshold``; leaves have children -1.
    """
    save_model(model, path)
    saved = df.sparkSession.read.parquet(f"{path.rstrip('/')}/data")
    nodes = saved.select("treeID", "nodeData.*") if "nodeData" in saved.columns else saved.withColumn("treeID", F.lit(0))
    return nodes.select(
        F.col("treeID").alias("tree_id"),
        F.col("id").alias("node_id"),
        "prediction",
        "impurity",
        "gain",
        F.col("leftChild").alias("left_child"),
        F.col("rightChild").alias("right_child"),
        F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    )


def naive_bayes_parameters(counts: DataFrame, smoothing: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Multinomial parameters from long counts ``doc, label, term, n``, for any vocabulary size.

    Returns ``(label, log_prior)`` and ``(label, term, log_likelihood)``. The second
    holds the (label, term) pairs that occur; an absent pair has the label's
    ``log_absent``, a third column of the first table.
    """
    sums = stage(counts.groupBy("label", "term").agg(F.sum("n").alias("n")))
    vocabulary = sums.agg(F.count_distinct("term").alias("v")).scalar()
    tokens = sums.groupBy("label").agg(F.sum("n").alias("tokens"))
    labels = counts.groupBy("label").agg(F.count_distinct("doc").alias("docs")).join(tokens, "label")
    all_docs = labels.agg(F.struct(F.sum("docs").alias("d"), F.count(F.lit(1)).alias("k")).alias("t")).scalar()
    smooth = F.lit(float(smoothing))
    size = F.log(F.col("tokens") + smooth * vocabulary)
    enriched = labels.withColumn("_t", all_docs)
    prior = stage(enriched.select(
        "label",
        (F.log(F.col("docs") + smooth) - F.log(F.col("_t.d") + smooth * F.col("_t.k"))).alias("log_prior"),
        (F.log(smooth) - size).alias("log_absent"),
        size.alias("log_size"),
    ))  # one row per label, read by the pairs, the scores and the driver
    pairs = sums.join(broadcast_if_small(prior, 10_000), "label")
    likelihood = pairs.select("label", "term", (F.log(F.col("n") + smooth) - F.col("log_size")).alias("log_likelihood"))
    return prior.drop("log_size"), likelihood


def score_naive_bayes(prior: DataFrame, likelihood: DataFrame, counts: DataFrame, docs: DataFrame) -> DataFrame:
    """``docs`` with ``prediction`` and ``score`` (probability of label 1), from the long parameters.

    ``counts`` has ``doc, term, n`` and ``docs`` the column ``doc``. Terms outside the training
    vocabulary count for no label; a document without terms gets the priors. What the
    driver reads is one row per label.
    """
    labels = prior.orderBy("label").collect()
    by_term = likelihood.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct("label", "log_likelihood"))).alias("_l"))
    terms = counts.select("doc", "term", "n").join(by_term, "term")
    value = lambda r: F.coalesce(F.try_element_at("_l", F.lit(r.label)), F.lit(r.log_absent))
    sums = terms.groupBy("doc").agg(*[F.sum(F.col("n") * value(r)).alias(f"_s{i}") for i, r in enumerate(labels)])
    logs = [F.coalesce(f"_s{i}", F.lit(0.0)) + F.lit(r.log_prior) for i, r in enumerate(labels)]
    joined = docs.join(sums, "doc", "left").withColumn("_logs", F.array(*logs))
    top = F.array_max("_logs")
    odds = F.transform("_logs", lambda x: F.exp(x - top))
    whole = F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    one = next((i for i, r in enumerate(labels) if r.label == 1.0), None)
    named = F.array(*[F.lit(float(r.label)) for r in labels])
    return joined.select(
        *docs.columns,
        F.get(named, (F.array_position("_logs", top) - 1).cast("int")).alias("prediction"),
        (F.get(odds, F.lit(one)) / whole if one is not None else F.lit(0.0)).alias("score"),
    )
