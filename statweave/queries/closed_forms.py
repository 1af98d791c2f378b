"""Fitted models beside what must hold of them: closed forms, conditions of an optimum, bounds of a sample."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from statweave.operators import clustering, recommendation, sampling, supervised
from statweave.operators.penalised_logistic import fit_penalised_logistic
from statweave.plans.staging import stage_table
from statweave.queries.models import part_ratings, stump_rows
from statweave.queries.registry import query, rounded, scratch
from statweave.sources.tables import spread, table

RANK, REG = 10, 0.01


def _factors(model):
    """The factors in the model's single precision: half the bytes where a row travels with its vector."""
    users = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("v"))
    return users, items


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def _added(counts):
    """One row of counts from those of every round."""
    return counts.agg(F.sum("n").alias("n"), F.sum("off").alias("off"))


_PAIRS = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


@query("als_stationary", f"SELECT count(DISTINCT o_custkey) AS n, 0::BIGINT AS off {_PAIRS}")
def als_stationary(spark, sf):
    """The last half step solves every user's normal equations: Σ (u·v − r)·v + reg·n·u is 0 up to single precision."""
    ratings = part_ratings(spark, sf)
    users, items = _factors(recommendation.fit_als(ratings, RANK, 10, REG))

    def judged(part):
        rows = part.join(items, "item").drop("item").join(users, "user").withColumn("e", _dot("u", "v") - F.col("rating"))
        left = [F.sum(F.col("e") * F.get("v", F.lit(j)) + REG * F.get("u", F.lit(j))).alias(f"g{j}") for j in range(RANK)]
        size = [F.sum(F.abs(F.col("rating") * F.get("v", F.lit(j)))).alias(f"s{j}") for j in range(RANK)]
        worst = F.greatest(*[F.abs(F.col(f"g{j}")) / (F.col(f"s{j}") + 1) for j in range(RANK)])
        return rows.groupBy("user").agg(*left, *size).agg(F.count("*").alias("n"), F.count_if(worst > 1e-3).alias("off"))

    return _added(recommendation.in_rounds(ratings, "user", judged))


@query("als_predictions", f"SELECT count(DISTINCT (o_custkey, l_partkey)) AS n, 0::BIGINT AS off {_PAIRS}")
def als_predictions(spark, sf):
    """The prediction of every rated pair is the product of the two factor rows."""
    ratings = part_ratings(spark, sf)
    model = recommendation.fit_als(ratings, RANK, 10, REG)
    users, items = _factors(model)

    def judged(part):
        predicted = recommendation.predict_ratings(model, part)
        both = predicted.join(items, "item").drop("item").join(users, "user")
        gap = F.abs(F.col("prediction") - _dot("u", "v"))
        return both.agg(F.count("*").alias("n"), F.count_if(gap > 1e-4).alias("off"))

    return _added(recommendation.in_rounds(ratings.select("user", "item"), "user", judged))


@query("svm_margin", "SELECT round(1 / avg(l_quantity), 3) AS weight FROM lineitem")
def svm_margin(spark, sf):
    """One feature ±c that tells the classes apart: the least hinge loss is reached at weight 1 / c, for small penalties."""
    lines = table(spark, sf, "lineitem")
    c = lines.agg(F.avg("l_quantity")).first()[0]
    label = (F.col("l_linestatus") == "F").cast("double")
    rows = spread(lines.select("l_linestatus")).select(label.alias("label"), F.array(F.when(label == 1, c).otherwise(-c)).alias("features"))
    model = supervised.fit_linear_svm(rows, 10)
    return rounded(spark.createDataFrame([(float(model.coefficients[0]),)], "weight double"), 3)


_RATES = """SELECT avg((l_returnflag = 'R')::INT) AS f, avg((l_linestatus = 'F')::INT) FILTER (l_returnflag <> 'R') AS p0,
    avg((l_linestatus = 'F')::INT) FILTER (l_returnflag = 'R') AS p1 FROM lineitem"""


def _indicator_rows(spark, sf):
    lines = spread(table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus"))
    return lines.select(
        (F.col("l_linestatus") == "F").cast("double").alias("label"), F.array((F.col("l_returnflag") == "R").cast("double")).alias("features")
    )


@query(
    "penalised_logistic",
    f"""WITH RECURSIVE r AS ({_RATES}),
    s AS (SELECT 0 AS i, 0.0::DOUBLE AS b, 0.0::DOUBLE AS c UNION ALL
      SELECT i + 1, b - (k22 * e1 - k12 * e2) / (k11 * k22 - k12 * k12), c - (k11 * e2 - k12 * e1) / (k11 * k22 - k12 * k12) FROM (
        SELECT i, b, c, (1 - f) * (q0 - p0) + f * (q1 - p1) + 0.1 * b AS e1, f * (q1 - p1) + 0.1 * c AS e2,
          (1 - f) * q0 * (1 - q0) + f * q1 * (1 - q1) + 0.1 AS k11, f * q1 * (1 - q1) AS k12, f * q1 * (1 - q1) + 0.1 AS k22
        FROM (SELECT s.*, r.*, 1 / (1 + exp(-b)) AS q0, 1 / (1 + exp(-b - c)) AS q1 FROM s, r WHERE i < 40))),
    z AS (SELECT b, c, f, p0, p1, 1 / (1 + exp(-b)) AS q0, 1 / (1 + exp(-b - c)) AS q1 FROM s, r WHERE i = 40)
    SELECT round(c, 5) AS weight, round(b, 5) AS bias,
      round(-(1 - f) * (p0 * ln(q0) + (1 - p0) * ln(1 - q0)) - f * (p1 * ln(q1) + (1 - p1) * ln(1 - q1)) + 0.05 * (b * b + c * c), 7) AS loss FROM z""",
)
def penalised_logistic(spark, sf):
    """Weight, bias and loss with the bias under the penalty; in SQL Newton's steps on the two groups' rates."""
    weights, history = fit_penalised_logistic(_indicator_rows(spark, sf), 0.1, 100, 1e-14)
    found = spark.createDataFrame([(float(weights[0]), float(weights[1]), float(history[-1]))], "weight double, bias double, loss double")
    return rounded(found, 5, loss=7)


@query("l2_logistic_stationary", "SELECT 0.0::DOUBLE AS bias_gradient, 0.0::DOUBLE AS weight_gradient")
def l2_logistic_stationary(spark, sf):
    """The library's fit, whose intercept is free: its gradient is 0 in the intercept and, with the penalty, in the weight."""
    rows = _indicator_rows(spark, sf)
    model, _ = supervised.fit_l2_logistic(rows, 0.1, 100, 1e-9)
    w, b = float(model.coefficients[0]), float(model.intercept)
    x = F.col("features")[0]
    miss = 1 / (1 + F.exp(-(x * w + b))) - F.col("label")
    return rounded(rows.agg(F.avg(miss).alias("bias_gradient"), (F.avg(miss * x) + 0.1 * w).alias("weight_gradient")), 5)


_GROUPS = "SELECT l_quantity + 1000 * (l_linestatus = 'F')::INT AS x, l_linestatus AS g FROM lineitem"


def _two_groups(spark, sf):
    value = F.col("l_quantity") + F.when(F.col("l_linestatus") == "F", 1000.0).otherwise(0.0)
    return spread(table(spark, sf, "lineitem").select("l_quantity", "l_linestatus")).select(F.array(value).alias("features"))


@query("bisecting_groups", f"SELECT round(avg(x), 6) AS center, count(*) AS n FROM ({_GROUPS}) GROUP BY g")
def bisecting_groups(spark, sf):
    """Two groups far apart: the first split finds them, and the centres are their means."""
    rows = _two_groups(spark, sf)
    model = clustering.fit_bisecting_kmeans(rows, 2)
    centers = spark.createDataFrame([(i, float(c[0])) for i, c in enumerate(model.clusterCenters())], "prediction int, center double")
    counts = model.transform(supervised.with_vector(rows, "features")).groupBy("prediction").agg(F.count("*").alias("n"))
    return rounded(centers.join(counts, "prediction").select("center", "n"))


@query(
    "mixture_groups",
    f"SELECT round(count(*) / (SELECT count(*) FROM lineitem), 6) AS weight, round(avg(x), 5) AS mean, round(var_pop(x), 3) AS variance FROM ({_GROUPS}) GROUP BY g",
)
def mixture_groups(spark, sf):
    """Two groups far apart: the components' weights, means and variances are the groups' own."""
    rows = _two_groups(spark, sf)
    parts = clustering.mixture_table(clustering.fit_gaussian_mixture(rows, 2), rows)
    return rounded(parts.select("weight", F.col("mean")[0].alias("mean"), F.col("covariance")[0].alias("variance")), 6, mean=5, variance=3)


@query("bernoulli_bounds", "SELECT l_returnflag, count(*) AS n, true AS within FROM lineitem GROUP BY l_returnflag")
def bernoulli_bounds(spark, sf):
    """Sizes of a sample of 0.6 within six deviations, group by group."""
    lines = table(spark, sf, "lineitem").select("l_returnflag")
    kept = sampling.bernoulli_sample(lines, 0.6).groupBy("l_returnflag").agg(F.count("*").alias("k"))
    return _within(lines.groupBy("l_returnflag").agg(F.count("*").alias("n")).join(kept, "l_returnflag"), F.lit(0.6)).select("l_returnflag", "n", "within")


@query(
    "stratified_bounds",
    "SELECT o_orderpriority, count(*) AS n, true AS within FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY o_orderpriority",
)
def stratified_bounds(spark, sf):
    """Sizes of strata sampled at their own rates within six deviations; strata without a rate are absent."""
    rates = {"1-URGENT": 0.8, "5-LOW": 0.3}
    orders = table(spark, sf, "orders").select("o_orderpriority")
    kept = sampling.stratified_sample(orders, "o_orderpriority", rates).groupBy("o_orderpriority").agg(F.count("*").alias("k"))
    rate = F.when(F.col("o_orderpriority") == "1-URGENT", 0.8).otherwise(0.3)
    whole = orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return _within(kept.join(whole, "o_orderpriority"), rate).select("o_orderpriority", "n", "within")


def _within(counts, rate):
    return counts.withColumn("within", F.abs(F.col("k") - F.col("n") * rate) <= 6 * F.sqrt(F.col("n") * rate * (1 - rate)))


TREES = 3
_LEAVES = f"SELECT unnest(range(0, {TREES}))::INTEGER AS tree_id, (SELECT count(*) FROM lineitem) AS n, 0::BIGINT AS off"


def _leaf_rows(spark, model, rows, name):
    """``id, tree_id, leaf, label, p``: where each row ends in each tree, by the saved nodes, and the leaf's prediction."""
    nodes = supervised.tree_nodes(model, scratch(spark, name), rows).where("left_child < 0")
    order = Window.partitionBy("tree_id").orderBy("node_id")
    leaves = nodes.select("tree_id", (F.row_number().over(order) - 1).alias("leaf"), F.col("prediction").alias("p"))
    scored = model.setLeafCol("_leaf").transform(supervised.with_vector(rows, "features"))
    ends = scored.select("id", "label", F.posexplode(vector_to_array("_leaf")).alias("tree_id", "_at"))
    return ends.select("id", "label", "tree_id", F.col("_at").cast("int").alias("leaf")).join(F.broadcast(leaves), ["tree_id", "leaf"])


def _leaf_report(rows, target):
    """Rows and leaves whose prediction is not the mean of ``target``, per tree."""
    leaves = rows.groupBy("tree_id", "leaf").agg(F.count("*").alias("c"), F.avg(target).alias("m"), F.first("p").alias("p"))
    return leaves.groupBy("tree_id").agg(F.sum("c").alias("n"), F.count_if(F.abs(F.col("m") - F.col("p")) > 1e-9).alias("off"))


def _numbered_rows(spark, sf, label):
    return stage_table(stump_rows(spark, sf, label).withColumn("id", F.monotonically_increasing_id()))


@query("forest_leaf_means", _LEAVES)
def forest_leaf_means(spark, sf):
    """Trees without resampling: every leaf of every tree predicts the mean label of the rows that end in it."""
    rows = _numbered_rows(spark, sf, F.col("l_quantity") / 10)
    model = supervised.fit_forest_regressor(rows, TREES, bootstrap=False)
    return _leaf_report(_leaf_rows(spark, model, rows, "leaves"), F.col("label"))


@query("forest_leaf_majorities", _LEAVES)
def forest_leaf_majorities(spark, sf):
    """Every leaf of a classifying forest predicts the label that most of its rows have."""
    rows = _numbered_rows(spark, sf, (F.col("l_linestatus") == "F").cast("double"))
    ends = _leaf_rows(spark, supervised.fit_forest_classifier(rows, TREES, bootstrap=False), rows, "leaves")
    leaves = ends.groupBy("tree_id", "leaf").agg(F.count("*").alias("c"), F.avg("label").alias("m"), F.first("p").alias("p"))
    wrong = ((F.col("p") == 1) & (F.col("m") < 0.5)) | ((F.col("p") == 0) & (F.col("m") > 0.5))
    return leaves.groupBy("tree_id").agg(F.sum("c").alias("n"), F.count_if(wrong).alias("off"))


def _boosted(ends, y, rest):
    """Each tree's rows with the target it was fitted to: the label, then what the trees before it leave."""
    trees = ends.groupBy("id").agg(F.first(y).alias("y"), F.array_sort(F.collect_list(F.struct("tree_id", "leaf", "p"))).alias("t"))
    sums = [F.lit(0.0)]
    for i in range(TREES):
        sums.append(sums[-1] + F.get("t", F.lit(i))["p"] * (1.0 if i == 0 else 0.1))
    targets = [F.col("y")] + [rest(F.col("y"), sums[i]) for i in range(1, TREES)]
    return trees.select(F.inline(F.zip_with("t", F.array(*targets), lambda t, x: F.struct(t["tree_id"].alias("tree_id"), t["leaf"].alias("leaf"), t["p"].alias("p"), x.alias("x")))))


@query("boosted_leaf_means", _LEAVES)
def boosted_leaf_means(spark, sf):
    """Every leaf of every boosted tree predicts the mean of the gradient that the trees before it leave."""
    rows = _numbered_rows(spark, sf, F.col("l_quantity") / 10)
    ends = _leaf_rows(spark, supervised.fit_boosted_regressor(rows, TREES), rows, "leaves")
    return _leaf_report(_boosted(ends, F.col("label"), lambda y, f: 2 * (y - f)), F.col("x"))


@query("boosted_class_leaf_means", _LEAVES)
def boosted_class_leaf_means(spark, sf):
    """The same for the logistic loss over labels −1 and 1."""
    rows = _numbered_rows(spark, sf, (F.col("l_linestatus") == "F").cast("double"))
    ends = _leaf_rows(spark, supervised.fit_boosted_classifier(rows, TREES), rows, "leaves")
    signed = _boosted(ends, 2 * F.col("label") - 1, lambda y, f: 4 * y / (1 + F.exp(2 * y * f)))
    return _leaf_report(signed, F.col("x"))
