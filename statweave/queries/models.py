"""Training, scoring and evaluation jobs, pattern mining and recommendation over the tables."""

from __future__ import annotations

import math

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.functions import vector_to_array

from pyspark.sql import functions as F

from statweave.operators import class_metrics, clustering, mining, recommendation, supervised
from statweave.operators.binary_metrics import BinaryCurves
from statweave.operators.ranking_metrics import ranking_summary_long
from statweave.operators.regression_metrics import regression_metrics
from statweave.operators.sampling import hash_split
from statweave.operators.topic_blocks import term_blocks
from statweave.plans.prefix_sum import row_index
from statweave.plans.staging import stage, stage_table, without_old_shuffles
from statweave.queries.registry import query, rounded, scratch
from statweave.sources import text
from statweave.sources.models import coefficients_table, load_model, save_model
from statweave.sources.tables import spread, table

WORDS = r"[^\p{L}]+"
BLOCK_BYTES = 64_000_000  # of text in a block of term counts


def labeled_documents(spark, sf, label: str = "quality"):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return docs.join(table(spark, sf, "labels").select("doc_id", F.col(label).cast("double").alias("label")), "doc_id")


def words(column: str = "text"):
    return F.filter(F.split(F.lower(column), WORDS), lambda w: w != "")


def counted(df):
    """Term counts of whole documents over every term that occurs; the vocabulary is a table."""
    size = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(size / BLOCK_BYTES))  # few blocks repeat few terms
    return term_blocks(df.coalesce(parts).select(words().alias("words")))


def evaluated(scored):
    """Error rate of the hard predictions beside the areas of the score, from one pass over the scored rows."""
    return BinaryCurves(scored.select("score", "label", "prediction"), prediction="prediction").summary()


@query("naive_bayes_lifecycle")
def naive_bayes_lifecycle(spark, sf):
    """Long term counts from first to last: no vocabulary is gathered, whatever its size."""
    counts = stage_table(term_counts(spark, sf))
    train, test = hash_split(counts, [0.75, 0.25], ["doc"])
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("doc"), F.col("quality").cast("double").alias("label"))
    docs = labels.join(table(spark, sf, "documents").select(F.col("doc_id").alias("doc")), "doc")
    prior, likelihood = supervised.naive_bayes_parameters(train)
    held = hash_split(docs, [0.75, 0.25], ["doc"])[1]
    return evaluated(supervised.score_naive_bayes(prior, likelihood, test, held))


TERM_SQL = r"""WITH c AS (SELECT doc_id, quality::DOUBLE AS label, term, count(*) AS n FROM
    (SELECT doc_id, quality, unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS term FROM documents JOIN labels USING (doc_id))
    WHERE term <> '' GROUP BY ALL),
    l AS (SELECT label, count(DISTINCT doc_id) AS docs, sum(n) AS tokens FROM c GROUP BY label),
    p AS (SELECT label, ln(docs + 1) - ln((SELECT sum(docs) + count(*) FROM l)) AS log_prior,
          ln(tokens + (SELECT count(DISTINCT term) FROM c)) AS size FROM l)"""


def term_counts(spark, sf):
    opened = labeled_documents(spark, sf).select(F.col("doc_id").alias("doc"), "label", F.explode(words()).alias("term"))
    return opened.groupBy("doc", "label", "term").agg(F.count(F.lit(1)).alias("n"))


@query("naive_bayes_priors", f"{TERM_SQL} SELECT label, round(log_prior, 6) AS log_prior, round(-size, 6) AS log_absent FROM p")
def naive_bayes_priors(spark, sf):
    return rounded(supervised.naive_bayes_parameters(term_counts(spark, sf))[0])


@query(
    "naive_bayes_likelihoods",
    f"""{TERM_SQL} SELECT label, term, round(ln(sum(n) + 1) - max(size), 6) AS log_likelihood FROM c JOIN p USING (label) GROUP BY label, term""",
)
def naive_bayes_likelihoods(spark, sf):
    return rounded(supervised.naive_bayes_parameters(term_counts(spark, sf))[1])


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def user_profiles(spark, sf):
    """Event counts per user, labelled by an even or odd user id."""
    counts = [F.count_if(F.col("event_type") == t).cast("double") for t in EVENT_TYPES]
    return table(spark, sf, "events").groupBy("user_id").agg(F.array(*counts).alias("features")).select(
        "user_id", (F.col("user_id") % 2).cast("double").alias("label"), "features"
    )


@query(
    "naive_bayes_model",
    """WITH u AS (SELECT user_id % 2 AS label, event_type, count(*) AS n FROM events GROUP BY ALL),
    t AS (SELECT label, sum(n) AS total FROM u GROUP BY label)
    SELECT label::INTEGER AS class_index, list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) - 1 AS feature,
    round(ln((n + 1.0) / (total + 5.0)), 6) AS log_likelihood FROM u JOIN t USING (label)""",
)
def naive_bayes_model(spark, sf):
    model = supervised.fit_naive_bayes(user_profiles(spark, sf))
    cells = [(c, j, float(v)) for c, line in enumerate(model.theta.toArray()) for j, v in enumerate(line)]
    return rounded(spark.createDataFrame(cells, "class_index int, feature int, log_likelihood double"))


def returned_lines(spark, sf):
    """Was a line returned, from its measures (features of similar size)."""
    return spread(table(spark, sf, "lineitem")).select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.array(F.col("l_quantity") / 50, F.col("l_extendedprice") / 100000, F.col("l_discount") * 10, F.col("l_tax") * 10).alias("features"),
    )


def line_split(spark, sf, weights):
    return hash_split(stage_table(returned_lines(spark, sf)), weights, ["l_orderkey", "l_linenumber"])


def digits(spark, sf):
    """Embeddings with their ten classes."""
    return spread(table(spark, sf, "embeddings")).select(
        "vec_id", F.col("label").cast("double").alias("label"), F.col("embedding").cast("array<double>").alias("features")
    )


def prices(spark, sf):
    """Line price from quantity and list price."""
    lines = spread(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"))
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") / 1000).alias("label"),
        F.array(F.col("l_quantity") / 10, F.col("p_retailprice") / 1000).alias("features"),
    )


@query("logistic_binary")
def logistic_binary(spark, sf):
    train, test = line_split(spark, sf, [0.6, 0.4])
    return evaluated(supervised.score(supervised.fit_logistic(train), test))


@query(
    "logistic_group_rates",
    """SELECT l_linestatus AS status, round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 4) AS probability FROM lineitem GROUP BY 1""",
)
def logistic_group_rates(spark, sf):
    """With one indicator per group the fitted probability of a group is its observed rate."""
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.array(*[(F.col("l_linestatus") == s).cast("double") for s in ("F", "O")]).alias("features"),
    )
    groups = spark.createDataFrame([("F", [1.0, 0.0]), ("O", [0.0, 1.0])], "status string, features array<double>")
    return rounded(supervised.score(supervised.fit_logistic(rows), groups).select("status", F.col("score").alias("probability")), 4)


@query(
    "multinomial_group_rates",
    """WITH t AS (SELECT o_orderstatus AS status, o_orderpriority AS p FROM orders), g AS (SELECT status, count(*)::DOUBLE AS n FROM t GROUP BY 1)
    SELECT status, (substr(p, 1, 1)::INTEGER - 1)::INTEGER AS class_index, round(count(*) / max(n), 3) AS probability FROM t JOIN g USING (status) GROUP BY status, p""",
)
def multinomial_group_rates(spark, sf):
    rows = table(spark, sf, "orders").select(
        (F.substring("o_orderpriority", 1, 1).cast("double") - 1).alias("label"),
        F.array(*[(F.col("o_orderstatus") == s).cast("double") for s in ("F", "O", "P")]).alias("features"),
    )
    groups = [(s, [float(s == t) for t in "FOP"]) for s in "FOP"]
    model = supervised.fit_multinomial_logistic(rows)
    scored = model.transform(supervised.with_vector(spark.createDataFrame(groups, "status string, features array<double>"), "features"))
    return rounded(scored.select("status", F.posexplode(vector_to_array("probability")).alias("class_index", "probability")), 3)


@query("logistic_multinomial")
def logistic_multinomial(spark, sf):
    train, test = hash_split(digits(spark, sf), [0.6, 0.4], ["vec_id"])
    scored = supervised.fit_multinomial_logistic(train).transform(supervised.with_vector(test, "features"))
    return class_metrics.per_class(class_metrics.confusion_counts(scored))


@query("logistic_loss_history")
def logistic_loss_history(spark, sf):
    return supervised.fit_l2_logistic(line_split(spark, sf, [0.6, 0.4])[0])[1]


@query("linear_svm")
def linear_svm(spark, sf):
    train, test = line_split(spark, sf, [0.75, 0.25])
    return evaluated(supervised.score(supervised.fit_linear_svm(train), test))


@query("tree_classifier")
def tree_classifier(spark, sf):
    train, test = line_split(spark, sf, [0.75, 0.25])
    return evaluated(supervised.score(supervised.fit_tree_classifier(train), test))


def _stump_sql(impurity: str, source: str) -> str:
    """Best split of the root over both features, at midpoints of neighbouring values."""
    return f"""WITH t AS ({source}), f AS (SELECT 0 AS feature, a AS x, y FROM t UNION ALL SELECT 1, b, y FROM t),
    v AS (SELECT feature, x, lead(x) OVER (PARTITION BY feature ORDER BY x) AS nx FROM (SELECT DISTINCT feature, x FROM f)),
    s AS (SELECT v.feature, (v.x + nx) / 2 AS threshold, count(*) FILTER (WHERE f.x <= v.x)::DOUBLE AS nl, avg(y) FILTER (WHERE f.x <= v.x) AS ml,
          avg(y * y) FILTER (WHERE f.x <= v.x) AS ql, count(*) FILTER (WHERE f.x > v.x)::DOUBLE AS nr, avg(y) FILTER (WHERE f.x > v.x) AS mr,
          avg(y * y) FILTER (WHERE f.x > v.x) AS qr, avg(y) AS m, avg(y * y) AS q
          FROM v JOIN f USING (feature) WHERE nx IS NOT NULL GROUP BY v.feature, v.x, nx),
    g AS (SELECT *, {impurity.format(m='m', q='q')} AS impurity, {impurity.format(m='m', q='q')} - nl / (nl + nr) * ({impurity.format(m='ml', q='ql')})
          - nr / (nl + nr) * ({impurity.format(m='mr', q='qr')}) AS gain FROM s)
    SELECT feature, round(threshold, 6) AS threshold, round(impurity, 6) AS impurity, round(gain, 8) AS gain,
    round(ml, 6) AS left_mean, round(mr, 6) AS right_mean FROM g ORDER BY gain DESC LIMIT 1"""


def _stump(spark, model, rows, name):
    nodes = supervised.tree_nodes(model, scratch(spark, name), rows)
    return nodes.where("tree_id = 0 AND node_id = 0").select("feature", "threshold", "impurity", "gain")


def stump_rows(spark, sf, label):
    return spread(table(spark, sf, "lineitem")).select(label.alias("label"), F.array(F.col("l_discount") * 100, F.col("l_tax") * 100).alias("features"))


CLASS_STUMP_SQL = "SELECT feature, threshold, impurity, gain FROM (" + _stump_sql(
    "2 * {m} * (1 - {m})", "SELECT l_discount * 100 AS a, l_tax * 100 AS b, CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END AS y FROM lineitem"
) + ")"
SIGN_STUMP_SQL = "SELECT feature, threshold, impurity, gain FROM (" + _stump_sql(
    "({q} - {m} * {m})", "SELECT l_discount * 100 AS a, l_tax * 100 AS b, CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE -1.0 END AS y FROM lineitem"
) + ")"
VALUE_STUMP_SQL = "SELECT feature, threshold, impurity, gain FROM (" + _stump_sql(
    "({q} - {m} * {m})", "SELECT l_discount * 100 AS a, l_tax * 100 AS b, l_quantity / 10 AS y FROM lineitem"
) + ")"


@query("tree_stump_classifier", CLASS_STUMP_SQL)
def tree_stump_classifier(spark, sf):
    """The root of the classification tree: best feature, threshold, Gini impurity and gain."""
    rows = stump_rows(spark, sf, (F.col("l_linestatus") == "F").cast("double"))
    return rounded(_stump(spark, supervised.fit_tree_classifier(rows), rows, "stump"), 6, gain=8)


@query("tree_stump_regressor", VALUE_STUMP_SQL)
def tree_stump_regressor(spark, sf):
    rows = stump_rows(spark, sf, F.col("l_quantity") / 10)
    return rounded(_stump(spark, supervised.fit_tree_regressor(rows), rows, "stump"), 6, gain=8)


@query("forest_stump_classifier", CLASS_STUMP_SQL)
def forest_stump_classifier(spark, sf):
    """One tree without resampling considers every feature and row, so its root is the single tree's."""
    rows = stump_rows(spark, sf, (F.col("l_linestatus") == "F").cast("double"))
    return rounded(_stump(spark, supervised.fit_forest_classifier(rows, trees=1, bootstrap=False), rows, "stump"), 6, gain=8)


@query("forest_stump_regressor", VALUE_STUMP_SQL)
def forest_stump_regressor(spark, sf):
    rows = stump_rows(spark, sf, F.col("l_quantity") / 10)
    return rounded(_stump(spark, supervised.fit_forest_regressor(rows, trees=1, bootstrap=False), rows, "stump"), 6, gain=8)


@query("boosted_stump_classifier", SIGN_STUMP_SQL)
def boosted_stump_classifier(spark, sf):
    """The first boosted tree is a regression on labels −1 and 1."""
    rows = stump_rows(spark, sf, (F.col("l_linestatus") == "F").cast("double"))
    return rounded(_stump(spark, supervised.fit_boosted_classifier(rows), rows, "stump"), 6, gain=8)


@query("boosted_stump_regressor", VALUE_STUMP_SQL)
def boosted_stump_regressor(spark, sf):
    rows = stump_rows(spark, sf, F.col("l_quantity") / 10)
    return rounded(_stump(spark, supervised.fit_boosted_regressor(rows), rows, "stump"), 6, gain=8)


@query("tree_nodes")
def tree_nodes(spark, sf):
    return supervised.tree_nodes(supervised.fit_tree_classifier(returned_lines(spark, sf)), scratch(spark, "tree"), returned_lines(spark, sf))


@query("forest_nodes")
def forest_nodes(spark, sf):
    return supervised.tree_nodes(supervised.fit_forest_classifier(returned_lines(spark, sf)), scratch(spark, "forest"), returned_lines(spark, sf))


@query("model_round_trip", "SELECT count(*) AS n, 0::BIGINT AS different FROM lineitem")
def model_round_trip(spark, sf):
    """Predictions of a tree and of its saved and loaded copy, row by row."""
    rows = returned_lines(spark, sf)
    model = supervised.fit_tree_classifier(rows)
    copy = load_model(DecisionTreeClassificationModel, save_model(model, scratch(spark, "model")))
    copy = copy.setPredictionCol("copied").setProbabilityCol("copied_probability").setRawPredictionCol("copied_raw")
    both = copy.transform(model.transform(supervised.with_vector(rows, "features")))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") != F.col("copied")).alias("different"))


def twice_scored(model, copy, source, column):
    """``column`` of the model and of its copy as ``_one`` and ``_two``: one scan scores a row with both, nothing is joined."""
    vectors = supervised.with_vector(source, "features") if "features" in source.columns else source
    outputs = [p for p in ("prediction", "probability", "rawPrediction") if copy.hasParam(f"{p}Col")]
    renamed = {copy.getParam(f"{p}Col"): f"copied_{p}" for p in outputs}
    both = copy.transform(model.transform(vectors), renamed)
    return both.select(F.col(column).alias("_one"), F.col(f"copied_{column}").alias("_two"))


ROUND_TRIPS = (
    "als bisecting_kmeans boosted_classifier boosted_regressor forest_classifier forest_regressor gaussian_mixture isotonic kmeans "
    "lda linear_regression linear_svm logistic naive_bayes tree_classifier tree_regressor"
)


@query(
    "model_round_trips",
    f"""SELECT model, CASE model WHEN 'lda' THEN 10 ELSE (SELECT count(DISTINCT user_id) FROM events) END AS n, 0::BIGINT AS different
    FROM (SELECT unnest(string_split('{ROUND_TRIPS}', ' ')) AS model)""",
)
def model_round_trips(spark, sf):
    """Every model type saved, loaded and compared with the original, prediction by prediction.

    A topic model's mixtures start from random values, so its topics' term weights are compared.
    """
    rows = stage_table(user_profiles(spark, sf).withColumn("spent", F.get("features", F.lit(2))))
    values = rows.select("user_id", F.col("spent").alias("label"), "features")
    points = values.select("user_id", "label", F.slice("features", 1, 1).alias("features"))
    rated = rows.select(F.col("user_id").cast("int").alias("user"), F.lit(0).alias("item"), F.col("spent").alias("rating"), "user_id")
    fitted = {
        "als": (recommendation.fit_als(rated, iterations=2), rated, "prediction"),
        "bisecting_kmeans": (clustering.fit_bisecting_kmeans(rows, 2), rows, "prediction"),
        "boosted_classifier": (supervised.fit_boosted_classifier(rows), rows, "probability"),
        "boosted_regressor": (supervised.fit_boosted_regressor(values), values, "prediction"),
        "forest_classifier": (supervised.fit_forest_classifier(rows), rows, "probability"),
        "forest_regressor": (supervised.fit_forest_regressor(values), values, "prediction"),
        "gaussian_mixture": (clustering.fit_gaussian_mixture(rows, 2), rows, "probability"),
        "isotonic": (supervised.fit_isotonic(points), points, "prediction"),
        "kmeans": (clustering.fit_kmeans(rows), rows, "prediction"),
        "lda": (clustering.fit_lda(rows, 2, 5), None, "weight"),
        "linear_regression": (supervised.fit_linear_regression(values), values, "prediction"),
        "linear_svm": (supervised.fit_linear_svm(rows), rows, "rawPrediction"),
        "logistic": (supervised.fit_logistic(rows), rows, "probability"),
        "naive_bayes": (supervised.fit_naive_bayes(rows), rows, "probability"),
        "tree_classifier": (supervised.fit_tree_classifier(rows), rows, "probability"),
        "tree_regressor": (supervised.fit_tree_regressor(values), values, "prediction"),
    }
    parts = []
    for name, (model, source, column) in fitted.items():
        copy = load_model(type(model), save_model(model, scratch(spark, name)))
        if source is None:
            keys, two = ["topic", "term_index"], clustering.topic_terms(copy)
            both = clustering.topic_terms(model).select(*keys, F.col(column).alias("_one")).join(two.select(*keys, F.col(column).alias("_two")), keys)
        else:
            both = twice_scored(model, copy, source.where("user_id IS NOT NULL"), column)
        differ = ~F.col("_one").cast("string").eqNullSafe(F.col("_two").cast("string"))
        parts.append(both.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n"), F.count_if(differ).alias("different")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query("tree_regressor")
def tree_regressor(spark, sf):
    train, test = hash_split(stage_table(prices(spark, sf)), [0.7, 0.3], ["l_orderkey", "l_linenumber"])
    return regression_metrics(supervised.score(supervised.fit_tree_regressor(train), test))


@query("forest_classifier")
def forest_classifier(spark, sf):
    train, test = line_split(spark, sf, [0.75, 0.25])
    return evaluated(supervised.score(supervised.fit_forest_classifier(train), test))


@query("forest_regressor")
def forest_regressor(spark, sf):
    train, test = hash_split(stage_table(prices(spark, sf)), [0.7, 0.3], ["l_orderkey", "l_linenumber"])
    return regression_metrics(supervised.score(supervised.fit_forest_regressor(train), test))


@query("boosted_classifier")
def boosted_classifier(spark, sf):
    train, test = line_split(spark, sf, [0.7, 0.3])
    return evaluated(supervised.score(supervised.fit_boosted_classifier(train), test))


@query("boosted_regressor")
def boosted_regressor(spark, sf):
    train, test = hash_split(stage_table(prices(spark, sf)), [0.7, 0.3], ["l_orderkey", "l_linenumber"])
    return regression_metrics(supervised.score(supervised.fit_boosted_regressor(train), test))


NORMAL_SQL = """WITH t AS (SELECT l_extendedprice / 1000 AS y, l_quantity / 10 AS a, p_retailprice / 1000 AS b FROM lineitem JOIN part ON l_partkey = p_partkey),
    s AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ay, sum(b * y) AS yb FROM t),
    c AS (SELECT (ay * bb - yb * ab) / (aa * bb - ab * ab) AS c0, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS c1 FROM s)"""


@query(
    "linear_regression",
    f"""{NORMAL_SQL} SELECT 0 AS class_index, 0 AS feature, round(c0, 5) AS value FROM c UNION ALL SELECT 0, 1, round(c1, 5) FROM c
    UNION ALL SELECT 0, -1, 0.0""",
)
def linear_regression(spark, sf):
    return rounded(coefficients_table(spark, supervised.fit_linear_regression(prices(spark, sf))), 5)


@query(
    "linear_regression_error",
    f"""{NORMAL_SQL} SELECT count(*) AS n, round(avg(pow(y - c0 * a - c1 * b, 2)), 4) AS mse, round(avg(abs(y - c0 * a - c1 * b)), 5) AS mae FROM t, c""",
)
def linear_regression_error(spark, sf):
    rows = prices(spark, sf)
    metrics = regression_metrics(supervised.score(supervised.fit_linear_regression(rows), rows))
    return rounded(metrics.select("n", "mse", "mae"), 5, mse=4)


@query(
    "isotonic",
    """WITH g AS (SELECT l_quantity AS x, sum(l_tax) AS s, count(*)::DOUBLE AS w FROM lineitem GROUP BY 1),
    c AS (SELECT x, sum(s) OVER (ORDER BY x) AS cs, sum(w) OVER (ORDER BY x) AS cw, s, w FROM g),
    m AS (SELECT i.x AS i, j.x AS j, (j.cs - i.cs + i.s) / (j.cw - i.cw + i.w) AS mean FROM c i JOIN c j ON j.x >= i.x),
    e AS (SELECT q.x, m.i, min(m.mean) AS low FROM c q JOIN m ON m.i <= q.x AND m.j >= q.x GROUP BY q.x, m.i)
    SELECT x AS boundary, round(max(low), 8) AS prediction FROM e GROUP BY x""",
)
def isotonic(spark, sf):
    """Fitted value at every quantity; in SQL the max-min formula of isotonic regression."""
    points = supervised.isotonic_input(table(spark, sf, "lineitem"), "l_tax", "l_quantity")
    fitted = supervised.score(supervised.fit_isotonic(points), points)
    return rounded(fitted.select(vector_to_array("features")[0].alias("boundary"), "prediction"), 8)


@query("isotonic_points")
def isotonic_points(spark, sf):
    points = supervised.isotonic_input(table(spark, sf, "lineitem"), "l_tax", "l_quantity")
    return supervised.isotonic_points(supervised.fit_isotonic(points), points)


def part_ratings(spark, sf):
    """How much each customer bought of each part, staged for the passes of training and evaluation."""
    rated = (
        table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        .join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").cast("int").alias("user"), F.col("l_partkey").cast("int").alias("item"))
        .agg((F.sum("l_quantity") / 10 - 2.5).alias("rating"))
    )
    with without_old_shuffles(spark):
        return stage_table(rated)


@query("als_ratings")
def als_ratings(spark, sf):
    """Train, predict the rated pairs and measure the error."""
    ratings = part_ratings(spark, sf)
    return regression_metrics(recommendation.predict_ratings(recommendation.fit_als(ratings), ratings), label="rating")


@query("als_recommend")
def als_recommend(spark, sf):
    return recommendation.recommend(recommendation.fit_als(part_ratings(spark, sf)), 10, scale=True)


@query(
    "als_recommend_ranks",
    """SELECT DISTINCT o_custkey::INTEGER AS "user", k::INTEGER AS rank FROM lineitem JOIN orders ON l_orderkey = o_orderkey, (SELECT unnest(range(1, 11)) AS k)""",
)
def als_recommend_ranks(spark, sf):
    """Every user with a rating gets ranks 1 to 10."""
    return recommendation.recommend(recommendation.fit_als(part_ratings(spark, sf)), 10).select("user", "rank")


@query("als_ranking")
def als_ranking(spark, sf):
    """Ranking metrics of ten recommendations per user against the items rated above 0."""
    ratings = part_ratings(spark, sf)
    recommended = recommendation.recommend(recommendation.fit_als(ratings), 10)
    return ranking_summary_long(recommended, ratings.where("rating > 0").select("user", "item"), users=ratings.select("user"))


@query("als_factors")
def als_factors(spark, sf):
    model = recommendation.fit_als(part_ratings(spark, sf))
    users, items = scratch(spark, "users"), scratch(spark, "items")
    text.write_features_text(recommendation.user_factors(model), users)
    text.write_features_text(recommendation.item_factors(model), items)
    both = text.read_features_text(spark, users).withColumn("side", F.lit("user"))
    both = both.unionByName(text.read_features_text(spark, items).withColumn("side", F.lit("item")))
    return both.select("side", "id", F.posexplode("features").alias("factor", "value"))


def order_brands(spark, sf):
    """The distinct brands of each order."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("items"))


ITEM_SQL = """WITH b AS (SELECT DISTINCT l_orderkey AS o, p_brand AS i FROM lineitem JOIN part ON l_partkey = p_partkey),
    n AS (SELECT count(DISTINCT o)::DOUBLE AS n FROM b),
    s AS (SELECT i AS items, count(*) AS freq, 1 AS k, i AS x, NULL AS y, NULL AS z FROM b GROUP BY i
    UNION ALL SELECT a.i || ',' || c.i, count(*), 2, a.i, c.i, NULL FROM b a JOIN b c ON a.o = c.o AND a.i < c.i GROUP BY a.i, c.i
    UNION ALL SELECT a.i || ',' || c.i || ',' || d.i, count(*), 3, a.i, c.i, d.i FROM b a JOIN b c ON a.o = c.o AND a.i < c.i JOIN b d ON a.o = d.o AND c.i < d.i GROUP BY a.i, c.i, d.i)"""


@query("frequent_itemsets", f"{ITEM_SQL} SELECT items, freq FROM s, n WHERE freq >= ceil(0.01 * n)")
def frequent_itemsets(spark, sf):
    model = mining.fit_fp_growth(order_brands(spark, sf), 0.01, 0.1)
    return mining.frequent_itemsets(model).select(F.concat_ws(",", "items").alias("items"), "freq")


RULE_SQL = f"""{ITEM_SQL}, f AS (SELECT s.* FROM s, n WHERE freq >= ceil(0.01 * n)),
    r AS (SELECT x AS antecedent, y AS consequent, freq FROM f WHERE k = 2 UNION ALL SELECT y, x, freq FROM f WHERE k = 2
    UNION ALL SELECT x || ',' || y, z, freq FROM f WHERE k = 3 UNION ALL SELECT x || ',' || z, y, freq FROM f WHERE k = 3
    UNION ALL SELECT y || ',' || z, x, freq FROM f WHERE k = 3)"""


@query(
    "association_rules",
    f"""{RULE_SQL} SELECT antecedent, consequent, round(r.freq / a.freq::DOUBLE, 6) AS confidence,
    round(r.freq / a.freq::DOUBLE / (c.freq / n), 6) AS lift, round(r.freq / n, 6) AS support
    FROM r JOIN f a ON a.items = antecedent JOIN f c ON c.items = consequent, n WHERE r.freq / a.freq::DOUBLE >= 0.15""",
)
def association_rules(spark, sf):
    model = mining.fit_fp_growth(order_brands(spark, sf), 0.01, 0.15)
    rules = mining.association_rules(model)
    return rounded(
        rules.select(F.concat_ws(",", "antecedent").alias("antecedent"), F.concat_ws(",", "consequent").alias("consequent"), "confidence", "lift", "support")
    )


@query(
    "rules_from_itemsets",
    f"""{RULE_SQL} SELECT antecedent, consequent, round(r.freq / a.freq::DOUBLE, 6) AS confidence
    FROM r JOIN f a ON a.items = antecedent WHERE r.freq / a.freq::DOUBLE >= 0.15""",
)
def rules_from_itemsets(spark, sf):
    itemsets = mining.frequent_itemsets(mining.fit_fp_growth(order_brands(spark, sf), 0.01))
    rules = mining.rules_from_itemsets(itemsets, 0.15)
    return rounded(rules.select(F.concat_ws(",", "antecedent").alias("antecedent"), F.concat_ws(",", "consequent").alias("consequent"), "confidence"))


def daily_sequences(spark, sf):
    """Per user, the set of event types of each active day, in date order.

    A day's set has at most one entry per event type and a sequence one element per
    date, however many events a user has; both are combined before the shuffle.
    """
    days = table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.array_sort(F.collect_set("event_type")).alias("types"))
    ordered = F.array_sort(F.collect_list(F.struct("day", "types")))
    return days.groupBy("user_id").agg(F.transform(ordered, lambda e: e["types"]).alias("sequence"))


def pattern_text(found):
    """``a&b>c`` for the pattern ((a, b), (c))."""
    elements = F.transform("sequence", lambda e: F.concat_ws("&", F.array_sort(e)))
    return found.select(F.concat_ws(">", elements).alias("sequence"), "freq")


@query(
    "prefixspan_pairs",
    """WITH e AS (SELECT DISTINCT user_id AS u, ts::DATE AS d, event_type AS t FROM events),
    n AS (SELECT count(DISTINCT u) AS n FROM e),
    s AS (SELECT t AS sequence, count(DISTINCT u) AS freq FROM e GROUP BY t
    UNION ALL SELECT a.t || '&' || b.t, count(DISTINCT a.u) FROM e a JOIN e b ON a.u = b.u AND a.d = b.d AND a.t < b.t GROUP BY a.t, b.t
    UNION ALL SELECT a.t || '>' || b.t, count(DISTINCT a.u) FROM e a JOIN e b ON a.u = b.u AND a.d < b.d GROUP BY a.t, b.t)
    SELECT sequence, freq FROM s, n WHERE freq >= 0.5 * n""",
)
def prefixspan_pairs(spark, sf):
    return pattern_text(mining.sequential_patterns(daily_sequences(spark, sf), 0.5, 2))


@query("prefixspan")
def prefixspan(spark, sf):
    return pattern_text(mining.sequential_patterns(daily_sequences(spark, sf), 0.8, 5))


def trade_edges(spark, sf):
    """Lines between the customer's and the supplier's nation, one edge per pair of nations."""
    return clustering.similarity_edges(
        table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
        .join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("c_nationkey").cast("bigint").alias("src"), F.col("s_nationkey").cast("bigint").alias("dst"))
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )


@query(
    "similarity_edges",
    """SELECT least(c_nationkey, s_nationkey)::BIGINT AS src, greatest(c_nationkey, s_nationkey)::BIGINT AS dst, count(*)::DOUBLE AS weight
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    WHERE c_nationkey <> s_nationkey GROUP BY 1, 2""",
)
def similarity_edges(spark, sf):
    return trade_edges(spark, sf)


@query("power_iteration")
def power_iteration(spark, sf):
    return clustering.power_iteration_clusters(trade_edges(spark, sf), 2, 10)


@query("lda_topics")
def lda_topics(spark, sf):
    """Three topics of the documents: every term's weight in each."""
    docs = counted(spread(table(spark, sf, "documents").select("doc_id", "text")))
    return clustering.topic_terms(clustering.fit_lda(docs, 3))


@query(
    "document_index",
    "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents",
)
def document_index(spark, sf):
    """Consecutive document numbers, the ids of a topic model's corpus."""
    return row_index(table(spark, sf, "documents").select("doc_id"), "doc_id")
