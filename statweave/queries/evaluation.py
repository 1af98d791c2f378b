"""Threshold curves, class, multilabel, ranking and regression metrics over fixed rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from statweave.operators import class_metrics, ranking_metrics, relational
from statweave.operators.binary_metrics import BinaryCurves, error_rate
from statweave.operators.recommendation import recommended_lists
from statweave.operators.regression_metrics import regression_metrics
from statweave.plans.staging import stage
from statweave.queries.registry import query, rounded
from statweave.sources.tables import table

# fixed linear score of a line, and whether it was returned
SCORED_SQL = """SELECT l_extendedprice * (1 - l_discount) AS score, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS label FROM lineitem"""

CURVE_SQL = f"""WITH h AS (SELECT score AS threshold, sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg FROM ({SCORED_SQL}) GROUP BY score),
    c AS (SELECT threshold, pos, neg, (sum(pos) OVER w)::DOUBLE AS tp, (sum(neg) OVER w)::DOUBLE AS fp,
          (sum(pos) OVER ())::DOUBLE AS p, (sum(neg) OVER ())::DOUBLE AS n FROM h
          WINDOW w AS (ORDER BY threshold DESC)),
    k AS (SELECT *, tp / (tp + fp) AS pr, tp / p AS re FROM c)"""


def scored_lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("score"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
    )


@query("precision_by_threshold", f"{CURVE_SQL} SELECT threshold, round(pr, 6) AS precision FROM k")
def precision_by_threshold(spark, sf):
    return BinaryCurves(scored_lines(spark, sf)).precision().withColumn("precision", F.round("precision", 6))


@query("threshold_list", f"SELECT DISTINCT score AS threshold FROM ({SCORED_SQL})")
def threshold_list(spark, sf):
    return BinaryCurves(scored_lines(spark, sf)).thresholds()


@query("recall_by_threshold", f"{CURVE_SQL} SELECT threshold, round(re, 6) AS recall FROM k")
def recall_by_threshold(spark, sf):
    return BinaryCurves(scored_lines(spark, sf)).recall().withColumn("recall", F.round("recall", 6))


def _f_sql(beta2: float) -> str:
    return f"""{CURVE_SQL} SELECT threshold,
    round(CASE WHEN pr + re > 0 THEN {1 + beta2} * pr * re / ({beta2} * pr + re) ELSE 0 END, 6) AS f_measure FROM k"""


@query("f1_by_threshold", _f_sql(1.0))
def f1_by_threshold(spark, sf):
    return BinaryCurves(scored_lines(spark, sf)).f_measure().withColumn("f_measure", F.round("f_measure", 6))


@query("f2_by_threshold", _f_sql(4.0))
def f2_by_threshold(spark, sf):
    return BinaryCurves(scored_lines(spark, sf)).f_measure(2.0).withColumn("f_measure", F.round("f_measure", 6))


@query(
    "pr_curve",
    f"""{CURVE_SQL} SELECT threshold, round(re, 6) AS recall, round(pr, 6) AS precision FROM k
    UNION ALL SELECT NULL, 0.0, round(arg_max(pr, threshold), 6) FROM k""",
)
def pr_curve(spark, sf):
    return BinaryCurves(scored_lines(spark, sf)).pr().select("threshold", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision"))


@query(
    "roc_curve",
    f"""{CURVE_SQL} SELECT threshold, round(fp / n, 6) AS fpr, round(re, 6) AS tpr FROM k
    UNION ALL SELECT NULL, 0.0, 0.0 UNION ALL SELECT NULL, 1.0, 1.0""",
)
def roc_curve(spark, sf):
    return BinaryCurves(scored_lines(spark, sf)).roc().select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query(
    "roc_curve_binned",
    f"""{CURVE_SQL}, b AS (SELECT *, (row_number() OVER (ORDER BY threshold DESC) - 1) // greatest(count(*) OVER () // 100, 1) AS chunk FROM k)
    SELECT min(threshold) AS threshold, round(max(fp / n), 6) AS fpr, round(max(re), 6) AS tpr FROM b GROUP BY chunk
    UNION ALL SELECT NULL, 0.0, 0.0 UNION ALL SELECT NULL, 1.0, 1.0""",
)
def roc_curve_binned(spark, sf):
    curve = BinaryCurves(scored_lines(spark, sf), bins=100).roc()
    return curve.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query(
    "area_under_pr",
    f"""{CURVE_SQL}, l AS (SELECT *, lag(re, 1, 0.0) OVER (ORDER BY threshold DESC) AS re0,
    coalesce(lag(pr) OVER (ORDER BY threshold DESC), pr) AS pr0 FROM k)
    SELECT round(sum((re - re0) * (pr + pr0) / 2), 8) AS area_under_pr FROM l""",
)
def area_under_pr(spark, sf):
    return rounded(BinaryCurves(scored_lines(spark, sf)).area_under_pr(), 8)


@query(
    "area_under_roc",
    f"""{CURVE_SQL}, l AS (SELECT *, lag(re, 1, 0.0) OVER (ORDER BY threshold DESC) AS re0,
    lag(fp / n, 1, 0.0) OVER (ORDER BY threshold DESC) AS x0 FROM k)
    SELECT round(sum((fp / n - x0) * (re + re0) / 2), 8) AS area_under_roc FROM l""",
)
def area_under_roc(spark, sf):
    return rounded(BinaryCurves(scored_lines(spark, sf)).area_under_roc(), 8)


@query(
    "area_hard_labels",
    """WITH t AS (SELECT l_quantity > 25 AS pred, l_returnflag = 'R' AS y FROM lineitem)
    SELECT round((1 + count(*) FILTER (WHERE pred AND y) / count(*) FILTER (WHERE y)::DOUBLE
    - count(*) FILTER (WHERE pred AND NOT y) / count(*) FILTER (WHERE NOT y)::DOUBLE) / 2, 8) AS area_under_roc FROM t""",
)
def area_hard_labels(spark, sf):
    """Area under ROC when the score is the predicted class itself."""
    hard = table(spark, sf, "lineitem").select(
        (F.col("l_quantity") > 25).cast("double").alias("score"), (F.col("l_returnflag") == "R").cast("double").alias("label")
    )
    return rounded(BinaryCurves(hard).area_under_roc(), 8)


@query(
    "error_rate",
    """SELECT count(*) AS n, count(*) FILTER (WHERE l_quantity IS NULL OR l_returnflag IS NULL) AS missing,
    count(*) FILTER (WHERE (l_quantity > 25) <> (l_returnflag = 'R')) AS errors,
    round(avg(CASE WHEN (l_quantity > 25) <> (l_returnflag = 'R') THEN 1.0 ELSE 0.0 END), 8) AS error_rate,
    round(1 - avg(CASE WHEN (l_quantity > 25) <> (l_returnflag = 'R') THEN 1.0 ELSE 0.0 END), 8) AS accuracy FROM lineitem""",
)
def error_rate_query(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_quantity") > 25).cast("double").alias("prediction"), (F.col("l_returnflag") == "R").cast("double").alias("label")
    )
    return rounded(error_rate(rows), 8)


# a fixed rule: the priority predicted from the price; 5-LOW is never predicted
PRIORITY_RULE = """CASE WHEN o_totalprice > 400000 THEN '1-URGENT' WHEN o_totalprice > 250000 THEN '2-HIGH'
    WHEN o_totalprice > 100000 THEN '3-MEDIUM' WHEN o_orderstatus = 'F' THEN '4-NOT SPECIFIED' ELSE '2-HIGH' END"""

CLASS_SQL = f"""WITH t AS (SELECT o_orderpriority AS label, {PRIORITY_RULE} AS prediction FROM orders),
    u AS (SELECT label AS c FROM t UNION SELECT prediction FROM t),
    k AS (SELECT c AS label, (SELECT count(*) FROM t WHERE label = c)::DOUBLE AS a, (SELECT count(*) FROM t WHERE prediction = c)::DOUBLE AS q,
          (SELECT count(*) FROM t WHERE label = c AND prediction = c)::DOUBLE AS h, (SELECT count(*) FROM t)::DOUBLE AS n FROM u),
    m AS (SELECT *, CASE WHEN q > 0 THEN h / q ELSE 0 END AS p, CASE WHEN a > 0 THEN h / a ELSE 0 END AS r FROM k),
    f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM m)"""


def predicted_priorities(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("label"), F.expr(PRIORITY_RULE).alias("prediction"))
    return class_metrics.confusion_counts(orders)


@query(
    "confusion_matrix",
    f"""{CLASS_SQL} SELECT x.c AS label, y.c AS prediction, (SELECT count(*) FROM t WHERE t.label = x.c AND t.prediction = y.c) AS n FROM u x, u y""",
)
def confusion_matrix(spark, sf):
    return class_metrics.confusion_matrix(predicted_priorities(spark, sf))


@query("multiclass_accuracy", f"{CLASS_SQL} SELECT round(sum(h) / max(n), 8) AS accuracy FROM f")
def multiclass_accuracy(spark, sf):
    return rounded(class_metrics.accuracy(predicted_priorities(spark, sf)), 8)


@query("per_class_metrics", f"{CLASS_SQL} SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f_measure FROM f")
def per_class_metrics(spark, sf):
    return rounded(class_metrics.per_class(predicted_priorities(spark, sf)))


@query(
    "weighted_metrics",
    f"""{CLASS_SQL} SELECT round(sum(a * p / n), 6) AS weighted_precision, round(sum(a * r / n), 6) AS weighted_recall,
    round(sum(a * f1 / n), 6) AS weighted_f_measure, round(sum(a / n * (q - h) / (n - a)), 6) AS weighted_false_positive_rate FROM f""",
)
def weighted_metrics(spark, sf):
    return rounded(class_metrics.weighted(predicted_priorities(spark, sf)))


# per user and day: event types with a value above 60, against those above 30 before noon; a set has at most one entry per type
SETS_SQL = """WITH d AS (SELECT user_id, date_trunc('day', ts) AS day, coalesce(list(DISTINCT event_type) FILTER (WHERE value > 60), []) AS prediction,
    coalesce(list(DISTINCT event_type) FILTER (WHERE value > 30 AND hour(ts) < 12), []) AS label FROM events GROUP BY ALL),
    s AS (SELECT *, len(prediction)::DOUBLE AS np, len(label)::DOUBLE AS nt, len(list_intersect(prediction, label))::DOUBLE AS b FROM d)"""


def daily_label_sets(spark, sf):
    p = F.collect_set(F.when(F.col("value") > 60, F.col("event_type")))
    t = F.collect_set(F.when((F.col("value") > 30) & (F.hour("ts") < 12), F.col("event_type")))
    return table(spark, sf, "events").groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(p.alias("prediction"), t.alias("label"))


@query(
    "multilabel_summary",
    f"""{SETS_SQL}, k AS (SELECT count(DISTINCT l) AS k FROM (SELECT unnest(label) AS l FROM d))
    SELECT round(avg(CASE WHEN np > 0 THEN b / np ELSE 0 END), 6) AS precision, round(avg(CASE WHEN nt > 0 THEN b / nt ELSE 0 END), 6) AS recall,
    round(avg(CASE WHEN np + nt > 0 THEN 2 * b / (np + nt) ELSE 0 END), 6) AS f1,
    round(avg(CASE WHEN np + nt > 0 THEN b / (np + nt - b) ELSE 0 END), 6) AS accuracy,
    round(sum(b) / sum(np), 6) AS micro_precision, round(sum(b) / sum(nt), 6) AS micro_recall, round(2 * sum(b) / (sum(np) + sum(nt)), 6) AS micro_f1,
    round(sum(np + nt - 2 * b) / (count(*) * max(k)), 6) AS hamming_loss,
    round(avg(CASE WHEN b = np AND b = nt THEN 1.0 ELSE 0.0 END), 6) AS subset_accuracy FROM s, k""",
)
def multilabel_summary(spark, sf):
    return rounded(class_metrics.multilabel_summary(daily_label_sets(spark, sf)))


@query(
    "multilabel_per_class",
    f"""{SETS_SQL}, p AS (SELECT user_id, day, unnest(prediction) AS label, true AS in_p FROM d), t AS (SELECT user_id, day, unnest(label) AS label, true AS in_t FROM d),
    c AS (SELECT label, count(in_p)::DOUBLE AS q, count(in_t)::DOUBLE AS a, count(*) FILTER (WHERE in_p AND in_t)::DOUBLE AS h
          FROM p FULL JOIN t USING (user_id, day, label) GROUP BY label)
    SELECT label, round(h / q, 6) AS precision, round(h / a, 6) AS recall, round(2 * h / (q + a), 6) AS f1 FROM c""",
)
def multilabel_per_class(spark, sf):
    return rounded(class_metrics.multilabel_per_class(daily_label_sets(spark, sf)))


# per customer: the ten brands with most revenue, against the brands bought in quantity
RANKING_SQL = """WITH b AS (SELECT o_custkey AS u, p_brand AS i, round(sum(l_extendedprice), 2) AS rev, sum(l_quantity) AS q
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL),
    p AS (SELECT * FROM (SELECT u, i, row_number() OVER (PARTITION BY u ORDER BY rev DESC, i) AS rank FROM b) WHERE rank <= 10),
    t AS (SELECT u, i FROM b WHERE q > 60), s AS (SELECT u, count(*) AS r FROM t GROUP BY u),
    m AS (SELECT p.u, rank, CASE WHEN t.i IS NULL THEN 0 ELSE 1 END AS h FROM p LEFT JOIN t USING (u, i)),
    w AS (SELECT *, sum(h) OVER (PARTITION BY u ORDER BY rank) AS c FROM m),
    g AS (SELECT u, coalesce(sum(h * c / rank::DOUBLE) / max(r), 0) AS ap,
          """ + ", ".join(
    f"""sum(CASE WHEN rank <= {k} THEN h ELSE 0 END) / {k}.0 AS p{k}, coalesce(sum(CASE WHEN rank <= {k} THEN h / ln(rank + 1) ELSE 0 END)
          / list_sum(list_transform(range(0, least(max(r), {k})), lambda x: 1 / ln(x + 2))), 0) AS n{k}"""
    for k in (1, 3, 5)
) + """ FROM w LEFT JOIN s USING (u) GROUP BY u)
    SELECT round(avg(p1), 6) AS precision_at_1, round(avg(n1), 6) AS ndcg_at_1, round(avg(p3), 6) AS precision_at_3, round(avg(n3), 6) AS ndcg_at_3,
    round(avg(p5), 6) AS precision_at_5, round(avg(n5), 6) AS ndcg_at_5, round(avg(ap), 6) AS mean_average_precision FROM g"""


def customer_rankings(spark, sf):
    """(predictions ``user, item, rank``; truth ``user, item``), both from one staged join."""
    bought = stage(
        table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity")
        .join(table(spark, sf, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user"), F.col("p_brand").alias("item"))
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"), F.sum("l_quantity").alias("quantity"))
    )
    top = relational.top_k_per_group(bought, ["user"], [F.desc("revenue"), F.col("item")], 10).select("user", "item", "rank")
    return top, bought.where("quantity > 60").select("user", "item")


@query("ranking_metrics", RANKING_SQL)
def ranking_metrics_query(spark, sf):
    predictions, truth = customer_rankings(spark, sf)
    return rounded(ranking_metrics.ranking_summary_long(predictions, truth))


@query("ranking_metrics_lists", RANKING_SQL)
def ranking_metrics_lists(spark, sf):
    """The same metrics from one row per user; both lists are at most as long as the list of brands."""
    predictions, truth = customer_rankings(spark, sf)
    relevant = truth.groupBy("user").agg(F.collect_list("item").alias("label"))
    lists = recommended_lists(predictions).join(relevant, "user", "left")
    return rounded(ranking_metrics.ranking_summary(lists.withColumn("label", F.coalesce("label", F.array().cast("array<string>")))))


@query(
    "regression_metrics",
    """WITH t AS (SELECT l_quantity * p_retailprice / 1000 AS p, l_extendedprice / 1000 AS y FROM lineitem JOIN part ON l_partkey = p_partkey),
    m AS (SELECT avg(y) AS ym FROM t)
    SELECT count(*) AS n, round(sum((p - y) * (p - y)) / 1e6, 6) AS sse, round(avg((p - y) * (p - y)), 5) AS mse, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse,
    round(avg(abs(p - y)), 6) AS mae, round(1 - sum((p - y) * (p - y)) / sum((y - ym) * (y - ym)), 6) AS r2,
    round(avg((p - ym) * (p - ym)), 5) AS explained_variance FROM t, m""",
)
def regression_metrics_query(spark, sf):
    rows = (
        table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
        .join(table(spark, sf, "part").select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
        .select((F.col("l_quantity") * F.col("p_retailprice") / 1000).alias("prediction"), (F.col("l_extendedprice") / 1000).alias("label"))
    )
    metrics = regression_metrics(rows).withColumn("sse", F.col("sse") / 1e6)
    return rounded(metrics, 6, mse=5, explained_variance=5)
