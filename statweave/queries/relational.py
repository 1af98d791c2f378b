"""Splits, samples, set difference, grouping, joins, top-k and text round trips over the tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from statweave.functions.arrays import binarise, clamp
from statweave.operators import relational, sampling
from statweave.plans.prefix_sum import row_index
from statweave.plans.staging import persisted
from statweave.queries.registry import query, rounded, scratch
from statweave.sources import text
from statweave.sources.tables import spread, table

FRACTIONS = {"1-URGENT": 0.1, "2-HIGH": 0.3, "3-MEDIUM": 0.05, "4-NOT SPECIFIED": 0.6, "5-LOW": 0.001}


def fraction_sql(key: str, seed: int = 11) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', {key}, '{seed}')), 1, 8))::BIGINT / 4294967296.0)"


@query("project_filter", "SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS amount FROM lineitem WHERE l_returnflag <> 'N' AND l_discount < 0.05")
def project_filter(spark, sf):
    lines = table(spark, sf, "lineitem").where("l_returnflag <> 'N' AND l_discount < 0.05")
    return lines.select("l_orderkey", "l_linenumber", (F.col("l_quantity") * F.col("l_extendedprice")).alias("amount"))


@query("swap_columns", "SELECT o_custkey AS k, o_orderkey AS v FROM orders")
def swap_columns(spark, sf):
    swapped = relational.swap(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", "o_custkey")
    return swapped.toDF("k", "v")


@query(
    "clamp_binarise",
    """SELECT event_id, greatest(least((value - 25) / 50, 1.0), 0.0)::DOUBLE AS clamped,
    CASE WHEN value - 50 > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS liked FROM events""",
)
def clamp_binarise(spark, sf):
    value = F.col("value")
    return table(spark, sf, "events").select(
        "event_id", clamp((value - 25) / 50, 0.0, 1.0).alias("clamped"), binarise(value - 50).alias("liked")
    )


@query("count_rows", "SELECT count(*) AS n FROM lineitem")
def count_rows(spark, sf):
    return relational.count_rows(table(spark, sf, "lineitem"))


@query("first_row", "SELECT 1::BIGINT AS n")
def first_row(spark, sf):
    return relational.count_rows(relational.first_row(table(spark, sf, "lineitem")))


@query("row_index", "SELECT event_id, row_number() OVER (ORDER BY epoch_us(ts)) - 1 AS row_index FROM events")
def indexed_events(spark, sf):
    """Numbers in the order of time; events of the same microsecond go by their id."""
    micros = F.unix_micros(F.col("ts").cast("timestamp")).alias("micros")
    timed = table(spark, sf, "events").select("event_id", F.struct(micros, "event_id").alias("place"))
    return row_index(timed, "place", unique=False).select("event_id", "row_index")


@query(
    "group_collect",
    """SELECT o_custkey, 0 AS part, coalesce(string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) FILTER (WHERE o_totalprice > 250000), '') AS items
    FROM orders GROUP BY o_custkey""",
)
def group_collect(spark, sf):
    grouped = relational.group_collect(table(spark, sf, "orders"), "o_custkey", "o_orderkey", F.col("o_totalprice") > 250000)
    return grouped.select("o_custkey", "part", F.concat_ws(",", F.array_sort("items").cast("array<string>")).alias("items"))


@query("inner_join", "SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def inner_join(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return relational.join_on(lines, orders, "l_orderkey")


@query(
    "composite_join",
    """SELECT a.user_id, a.event_type, a.n, b.total FROM
    (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) a JOIN
    (SELECT user_id, event_type, round(sum(value), 4) AS total FROM events GROUP BY ALL) b USING (user_id, event_type)""",
)
def composite_join(spark, sf):
    keys = ["user_id", "event_type"]
    events = table(spark, sf, "events")
    counts = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    totals = events.groupBy(*keys).agg(F.sum("value").alias("total"))
    return rounded(relational.join_on(counts, totals, keys), 4)


@query(
    "set_difference",
    f"""WITH s AS (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem WHERE {fraction_sql('l_orderkey')} < 0.6)
    SELECT l_orderkey, l_returnflag FROM lineitem a WHERE NOT EXISTS
    (SELECT 1 FROM s WHERE s.l_orderkey IS NOT DISTINCT FROM a.l_orderkey AND s.l_returnflag IS NOT DISTINCT FROM a.l_returnflag)""",
)
def set_difference(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")
    sample = rows.where(sampling.hash_fraction(["l_orderkey"]) < 0.6)
    return relational.set_difference(rows, sample)


@query("squared_error_sum", "SELECT round(sum((o_totalprice / 1000 - 200) * (o_totalprice / 1000 - 200)) / 1000, 4) AS sse FROM orders")
def squared_error_sum(spark, sf):
    e = F.col("o_totalprice") / 1000 - 200
    return rounded(table(spark, sf, "orders").agg((F.sum(e * e) / 1000).alias("sse")), 4)


@query("squared_error_mean", "SELECT round(avg(pow(value - 50, 2)), 4) AS mse FROM events")
def squared_error_mean(spark, sf):
    return rounded(table(spark, sf, "events").agg(F.avg(F.pow(F.col("value") - 50, 2)).alias("mse")), 4)


@query(
    "topk_per_user",
    """WITH s AS (SELECT o_custkey AS user, l_partkey AS item, round(sum(l_extendedprice), 2) AS score
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
    SELECT user, item, score, CAST(rank AS INTEGER) AS rank FROM
    (SELECT *, row_number() OVER (PARTITION BY user ORDER BY score DESC, item) AS rank FROM s) WHERE rank <= 10""",
)
def topk_per_user(spark, sf):
    spent = (
        table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
        .join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("score"))
    )
    return relational.top_k_per_group(spent, ["user"], [F.desc("score"), F.col("item")], 10)


@query("bernoulli_sample")
def bernoulli_sample(spark, sf):
    return sampling.bernoulli_sample(table(spark, sf, "lineitem"), 0.6).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("random_split", "SELECT count(*) AS n, 0::BIGINT AS shared FROM orders")
def random_split(spark, sf):
    """Two seeded parts: together all rows, and no row in both."""
    train, test = sampling.random_split(table(spark, sf, "orders").select("o_orderkey"), [0.6, 0.4], 11)
    tagged = train.withColumn("part", F.lit(1)).unionByName(test.withColumn("part", F.lit(2)))
    keys = tagged.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("c"), F.count_distinct("part").alias("parts"))
    return keys.agg(F.sum("c").alias("n"), F.count_if(F.col("parts") > 1).alias("shared"))


@query(
    "hash_split",
    f"""SELECT o_orderkey, CASE WHEN {fraction_sql('o_orderkey')} < 0.75 THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def hash_split(spark, sf):
    train, test = sampling.hash_split(table(spark, sf, "orders").select("o_orderkey"), [0.75, 0.25], ["o_orderkey"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("stratified_sample")
def stratified_sample(spark, sf):
    sample = sampling.stratified_sample(table(spark, sf, "orders"), "o_orderpriority", FRACTIONS)
    return sample.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stratified_exact",
    f"""WITH f(p, f) AS (VALUES {", ".join(f"('{k}', {v}::DECIMAL(20,10))" for k, v in FRACTIONS.items())}),
    r AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey || '|11'), o_orderkey) AS rn,
          count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
    SELECT o_orderkey, o_orderpriority FROM r JOIN f ON p = o_orderpriority WHERE rn <= ceil(f * n)""",
)
def stratified_exact(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.stratified_exact(orders, "o_orderpriority", FRACTIONS, ["o_orderkey"])


@query("cached_reuse", "SELECT count(*) AS n, count(DISTINCT l_orderkey) AS orders FROM lineitem")
def cached_reuse(spark, sf):
    """Two aggregates over one kept input, released when both are done."""
    with persisted(table(spark, sf, "lineitem").select("l_orderkey")) as rows:
        n, orders = rows.count(), rows.distinct().count()
    return spark.createDataFrame([(n, orders)], "n bigint, orders bigint")


@query("repartitioned", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey")
def repartitioned(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_suppkey").repartition("l_suppkey")
    return lines.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("text_scan", "SELECT count(*) AS n, sum(length(o_orderpriority))::BIGINT AS chars FROM orders")
def text_scan(spark, sf):
    path = scratch(spark, "lines")
    table(spark, sf, "orders").select(F.col("o_orderpriority").alias("value")).write.text(path)
    lines = text.read_lines(spark, path)
    return lines.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("chars"))


LIBSVM_SQL = """SELECT CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, round(sum(l_quantity), 4) AS q,
    round(sum(l_discount), 4) AS d, round(sum(l_tax), 4) AS t, count(*) AS n FROM lineitem GROUP BY 1"""


def _libsvm_lines(spark, sf):
    label = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    return spread(table(spark, sf, "lineitem")).select(
        F.concat_ws(
            " ", label, F.concat(F.lit("1:"), "l_quantity"), F.concat(F.lit("2:"), "l_discount"), F.concat(F.lit("3:"), "l_tax")
        ).alias("value")
    )


def _feature_sums(df):
    f = F.col("features")
    return rounded(
        df.groupBy("label").agg(
            F.sum(f[0]).alias("q"), F.sum(f[1]).alias("d"), F.sum(f[2]).alias("t"), F.count(F.lit(1)).alias("n")
        ),
        4,
    )


@query("libsvm_scan", LIBSVM_SQL)
def libsvm_scan(spark, sf):
    path = scratch(spark, "libsvm")
    _libsvm_lines(spark, sf).write.text(path)
    return _feature_sums(text.read_libsvm(spark, path, 3).withColumn("features", vector_to_array("features")))


@query("labeled_pair_lines", LIBSVM_SQL)
def labeled_pair_lines(spark, sf):
    return _feature_sums(text.shape_labeled_pairs(_libsvm_lines(spark, sf), 3))


@query("labeled_vector_lines", LIBSVM_SQL)
def labeled_vector_lines(spark, sf):
    label = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    lines = table(spark, sf, "lineitem").select(
        F.concat(label, F.lit(","), F.concat_ws(" ", "l_quantity", "l_discount", "l_tax")).alias("value")
    )
    return _feature_sums(text.shape_labeled_vectors(lines))


@query(
    "vector_lines",
    "SELECT vec_id, round(list_sum(embedding::DOUBLE[]), 5) + 0.0 AS total, len(embedding)::INTEGER AS width FROM embeddings",
)
def vector_lines(spark, sf):
    lines = table(spark, sf, "embeddings").select(
        "vec_id", F.concat(F.lit(" "), F.concat_ws(" ", F.col("embedding").cast("array<double>").cast("array<string>"))).alias("value")
    )
    shaped = text.shape_vectors(lines, keep=["vec_id"])
    total = F.aggregate("features", F.lit(0.0), lambda s, v: s + v)
    return rounded(shaped.select("vec_id", total.alias("total"), F.size("features").alias("width")), 5)


@query("rating_lines", 'SELECT o_custkey::INTEGER AS "user", o_orderkey::INTEGER AS item, round(o_totalprice - 2.5, 4) AS rating FROM orders')
def rating_lines(spark, sf):
    lines = table(spark, sf, "orders").select(F.concat_ws("::", "o_custkey", "o_orderkey", "o_totalprice").alias("value"))
    return rounded(text.shape_ratings(lines, "::", -2.5), 4)


@query(
    "bad_rating_lines",
    """SELECT o_orderstatus <> 'O' AS bad, CASE WHEN o_orderstatus = 'O' THEN 'yes' ELSE 'no' END AS rated, count(*) AS n FROM orders GROUP BY 1, 2""",
)
def bad_rating_lines(spark, sf):
    """Lines whose rating does not parse, and lines that end before it, are in the error table."""
    price, status = F.col("o_totalprice").cast("string"), F.col("o_orderstatus")
    rating = F.when(status == "F", F.lit("n/a")).when(status == "O", price)  # null leaves the part out
    lines = table(spark, sf, "orders").select(F.concat_ws(",", "o_custkey", "o_orderkey", rating).alias("value"))
    good, bad = text.split_bad_rows(text.shape_ratings(lines), ["user", "item", "rating"])
    both = good.withColumn("bad", F.lit(False)).unionByName(bad.withColumn("bad", F.lit(True)))
    rated = F.when(F.col("rating").isNotNull(), "yes").otherwise("no").alias("rated")
    return both.groupBy("bad", rated).agg(F.count(F.lit(1)).alias("n"))


@query(
    "basket_lines",
    """SELECT item, count(*) AS baskets FROM (SELECT unnest([replace(p_brand, ' ', ''), p_type]) AS item FROM lineitem JOIN part ON l_partkey = p_partkey)
    GROUP BY item""",
)
def basket_lines(spark, sf):
    """One line of brand, type and the brand again per sale, shaped to baskets without repeats."""
    brand = F.replace("p_brand", F.lit(" "), F.lit(""))
    lines = (
        table(spark, sf, "lineitem").select("l_partkey")
        .join(table(spark, sf, "part").select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .select(F.concat_ws(" ", brand, "p_type", brand).alias("value"))
    )
    return text.shape_baskets(lines).select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("baskets"))


@query(
    "ab_sample_lines",
    "SELECT event_type = 'error' AS is_treatment, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1",
)
def ab_sample_lines(spark, sf):
    lines = table(spark, sf, "events").select(F.concat_ws(", ", F.col("event_type") == "error", "value").alias("value"))
    samples = text.shape_ab_samples(lines)
    return rounded(samples.groupBy("is_treatment").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), 4)


@query(
    "features_text_sink",
    """SELECT vec_id AS id, CAST(i - 1 AS INTEGER) AS feature, round(v, 6) + 0.0 AS value
    FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)""",
)
def features_text_sink(spark, sf):
    path = scratch(spark, "features")
    vectors = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features")
    )
    text.write_features_text(vectors, path)
    return rounded(text.read_features_text(spark, path).select("id", F.posexplode("features").alias("feature", "value")))
