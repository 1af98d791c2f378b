"""Descriptive statistics, correlation, density and hypothesis tests over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from statweave.functions.arrays import discretise
from statweave.operators import descriptive, hypothesis
from statweave.queries.registry import query, rounded
from statweave.sources.tables import table

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KDE_POINTS = [0.0, 10.0, 25.0, 50.0, 75.0, 100.0, 150.0, 200.0, 300.0, 400.0]


def chi2_upper_sql(statistic: str, dof: str) -> str:
    """Upper χ² tail by the power series of the lower incomplete gamma function.

    The terms are Poisson probabilities with mean statistic / 2 from dof / 2 on, so twelve
    deviations above the mean (and 400 more) leave nothing out.
    """
    term = f"exp(({dof} / 2.0 + n) * ln({statistic} / 2.0) - {statistic} / 2.0 - lgamma({dof} / 2.0 + n + 1))"
    terms = f"(400 + greatest({statistic} - {dof}, 0) / 2 + 12 * sqrt({statistic} / 2))::INTEGER"
    return f"(1 - list_sum(list_transform(range(0, {terms}), lambda n: {term})))"


def t_two_sided_sql(statistic: str, dof: str) -> str:
    """Two-sided t tail: the density over t = √ν·tan θ by Simpson's rule, to 12 deviations or π/2."""
    start, width = f"atan(abs({statistic}) / sqrt({dof}))", f"least(pi() / 2 - atan(abs({statistic}) / sqrt({dof})), 12 / sqrt({dof}))"
    weight = "(CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
    value = f"exp(({dof} - 1) * ln(greatest(cos({start} + {width} * i / 2000.0), 1e-300)))"
    scale = f"exp(lgamma(({dof} + 1) / 2) - lgamma({dof} / 2)) / sqrt(pi())"
    return f"(2 * {scale} * {width} / 6000 * list_sum(list_transform(range(0, 2001), lambda i: {weight} * {value})))"


def kolmogorov_sql(z: str, n: str) -> str:
    """Upper Kolmogorov tail at z = √n·D: the limit law and its terms to n^(−3/2) (Pelz and Good, 1976)."""
    odd, even = "pow(pi() * (k + 0.5), 2)", "pow(pi() * k, 2)"
    total = lambda value, at: f"list_sum(list_transform(range(-60, 60), lambda k: ({value}) * exp(-{at} / (2 * {z} * {z}))))"
    half = "sqrt(pi() / 2)"
    limit = f"{half} / {z} * {total('1', odd)}"
    first = f"{half} / (6 * pow({z}, 4)) * {total(f'{odd} - {z} * {z}', odd)}"
    two = f"6 * pow({z}, 6) + 2 * pow({z}, 4) + (2 * pow({z}, 4) - 5 * {z} * {z}) * {odd} + (1 - 2 * {z} * {z}) * {odd} * {odd}"
    second = f"{half} / (72 * pow({z}, 7)) * {total(two, odd)} - {half} / (36 * pow({z}, 3)) * {total(even, even)}"
    three = (
        f"-30 * pow({z}, 6) - 90 * pow({z}, 8) + (135 * pow({z}, 4) - 96 * pow({z}, 6)) * {odd}"
        f" + (212 * pow({z}, 4) - 60 * {z} * {z}) * pow({odd}, 2) + (5 - 30 * {z} * {z}) * pow({odd}, 3)"
    )
    third = f"{half} / (6480 * pow({z}, 10)) * {total(three, odd)} + {half} / (216 * pow({z}, 6)) * {total(f'3 * {even} * {z} * {z} - {even} * {even}', even)}"
    return f"(1 - ({limit} + ({first}) / sqrt({n}) + ({second}) / {n} + ({third}) / ({n} * sqrt({n}))))"


def normal_cdf_sql(z: str) -> str:
    """Normal distribution function by the all-positive series of erf."""
    x = f"(abs({z}) / sqrt(2.0))"
    term = f"exp((2 * n + 1) * ln({x} + 1e-300) - {x} * {x} - lgamma(n + 1.5))"
    half = f"0.5 * list_sum(list_transform(range(0, 300), lambda n: {term}))"
    return f"CASE WHEN {z} >= 0 THEN 0.5 + {half} ELSE 0.5 - {half} END"


@query(
    "col_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(var_samp({c}), 2) AS variance,
        count(*) FILTER (WHERE {c} <> 0) AS num_nonzeros FROM lineitem"""
        for c in MEASURES
    ),
)
def col_summary(spark, sf):
    return rounded(descriptive.column_summary(table(spark, sf, "lineitem"), MEASURES), 6, variance=2)


@query(
    "vector_summary",
    """SELECT CAST(i - 1 AS INTEGER) AS feature, round(avg(v), 6) + 0.0 AS mean, round(var_samp(v), 6) AS variance,
    count(*) FILTER (WHERE v <> 0) AS num_nonzeros
    FROM (SELECT unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i""",
)
def vector_summary(spark, sf):
    return rounded(descriptive.vector_summary(table(spark, sf, "embeddings"), "embedding"))


@query("pearson", "SELECT round(corr(l_quantity, l_extendedprice), 8) AS r FROM lineitem")
def pearson(spark, sf):
    return rounded(descriptive.pearson(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"), 8)


def _average_rank_sql(columns: list[str], source: str) -> str:
    ranks = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in columns
    )
    return f"SELECT {ranks} FROM {source}"


def _matrix_sql(columns: list[str], source: str, places: int) -> str:
    return " UNION ALL ".join(
        f"SELECT '{i}' AS i, '{j}' AS j, round(corr({i}, {j}), {places}) + 0.0 AS r FROM ({source})"
        for i in columns
        for j in columns
        if i != j
    ) + "".join(f" UNION ALL SELECT '{i}', '{i}', 1.0::DOUBLE" for i in columns)


@query("spearman", f"SELECT round(corr(l_quantity, l_extendedprice), 8) AS r FROM ({_average_rank_sql(['l_quantity', 'l_extendedprice'], 'lineitem')})")
def spearman(spark, sf):
    return rounded(descriptive.spearman(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"), 8)


@query("corr_matrix", _matrix_sql(MEASURES, "SELECT * FROM lineitem", 8))
def corr_matrix(spark, sf):
    return rounded(descriptive.correlation_matrix(table(spark, sf, "lineitem"), MEASURES), 8)


@query("corr_matrix_spearman", _matrix_sql(MEASURES, _average_rank_sql(MEASURES, "lineitem"), 8))
def corr_matrix_spearman(spark, sf):
    return rounded(descriptive.correlation_matrix(table(spark, sf, "lineitem"), MEASURES, "spearman"), 8)


@query(
    "vector_correlation",
    """WITH long AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
    SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(corr(a.v, b.v), 6) + 0.0 AS r
    FROM long a JOIN long b USING (vec_id) GROUP BY 1, 2""",
)
def vector_correlation(spark, sf):
    return rounded(descriptive.vector_correlation(table(spark, sf, "embeddings"), "embedding"))


@query(
    "kde",
    f"""SELECT point, round(avg(exp(-(value - point) * (value - point) / 18.0)) / (3.0 * sqrt(2 * pi())), 8) AS density
    FROM events, (SELECT unnest({KDE_POINTS})::DOUBLE AS point) GROUP BY point""",
)
def kde(spark, sf):
    return rounded(descriptive.kernel_density(table(spark, sf, "events"), "value", KDE_POINTS, 3.0), 8)


def _tested(df, *keys):
    return rounded(df.select("test", *keys, "statistic", "dof", "p_value"), 6)


@query(
    "chi2_gof",
    f"""WITH c AS (SELECT count(*) AS o FROM orders GROUP BY o_orderpriority),
    s AS (SELECT sum((o - n / k) * (o - n / k) / (n / k)) AS x, (max(k) - 1)::DOUBLE AS d
          FROM c, (SELECT sum(o)::DOUBLE AS n, count(*)::DOUBLE AS k FROM c))
    SELECT 'chi2_goodness_of_fit' AS test, round(x, 6) AS statistic, d AS dof, round({chi2_upper_sql('x', 'd')}, 6) AS p_value FROM s""",
)
def chi2_gof(spark, sf):
    counts = hypothesis.category_counts(table(spark, sf, "orders"), "o_orderpriority")
    return _tested(hypothesis.chi2_goodness_of_fit(counts, "o_orderpriority", "observed"))


@query(
    "chi2_gof_expected",
    f"""WITH c AS (SELECT l_returnflag AS f, count(*) AS o FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1),
    e AS (SELECT l_returnflag AS f, count(*) AS w FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1),
    t AS (SELECT coalesce(o, 0)::DOUBLE AS o, coalesce(w, 0)::DOUBLE AS w FROM c FULL JOIN e USING (f)),
    u AS (SELECT o, w * (SELECT sum(o) / sum(w) FROM t) AS e FROM t),
    s AS (SELECT sum((o - e) * (o - e) / e) AS x, (count(*) - 1)::DOUBLE AS d FROM u)
    SELECT 'chi2_goodness_of_fit' AS test, round(x, 6) AS statistic, d AS dof, round({chi2_upper_sql('x', 'd')}, 6) AS p_value FROM s""",
)
def chi2_gof_expected(spark, sf):
    lines = table(spark, sf, "lineitem")
    observed = hypothesis.category_counts(lines.where("l_linestatus = 'O'"), "l_returnflag")
    expected = hypothesis.category_counts(lines.where("l_linestatus = 'F'"), "l_returnflag", "expected")
    return _tested(
        hypothesis.chi2_goodness_of_fit(
            observed, "l_returnflag", "observed", expected.withColumnRenamed("l_returnflag", "category")
        )
    )


def _independence_sql(cells: str, test: str, by: str = "") -> str:
    """``cells`` yields (feature, a, b); every combination of a and b counts, zero or not."""
    return f"""WITH raw AS ({cells}), o AS (SELECT feature, a, b, count(*) AS o FROM raw GROUP BY ALL),
    r AS (SELECT feature, a, count(*) AS r FROM raw GROUP BY ALL), c AS (SELECT feature, b, count(*) AS c FROM raw GROUP BY ALL),
    n AS (SELECT feature, count(*)::DOUBLE AS n, count(DISTINCT a) AS ka, count(DISTINCT b) AS kb FROM raw GROUP BY ALL),
    t AS (SELECT n.feature, (ka - 1) * (kb - 1) AS d, coalesce(o.o, 0) AS o, r.r * c.c / n.n AS e
          FROM n JOIN r USING (feature) JOIN c USING (feature) LEFT JOIN o ON o.feature = n.feature AND o.a = r.a AND o.b = c.b),
    s AS (SELECT feature, sum((o - e) * (o - e) / e) AS x, max(d)::DOUBLE AS d FROM t GROUP BY feature)
    SELECT '{test}' AS test, {by} round(x, 6) AS statistic, d AS dof, round({chi2_upper_sql('x', 'd')}, 6) + 0.0 AS p_value FROM s"""


@query("chi2_independence", _independence_sql("SELECT 0 AS feature, o_orderstatus AS a, o_orderpriority AS b FROM orders", "chi2_independence"))
def chi2_independence(spark, sf):
    return _tested(hypothesis.chi2_independence(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority"))


@query(
    "chi2_independence_sparse",
    _independence_sql("SELECT 0 AS feature, p_brand AS a, p_retailprice AS b FROM part", "chi2_independence"),
)
def chi2_independence_sparse(spark, sf):
    return _tested(hypothesis.chi2_independence(table(spark, sf, "part"), "p_brand", "p_retailprice"))


@query(
    "chi2_by_feature",
    _independence_sql(
        """SELECT 0 AS feature, floor(l_quantity / 16) AS a, l_returnflag AS b FROM lineitem
        UNION ALL SELECT 1, l_discount, l_returnflag FROM lineitem UNION ALL SELECT 2, l_tax, l_returnflag FROM lineitem
        UNION ALL SELECT 3, l_linenumber, l_returnflag FROM lineitem""",
        "chi2_by_feature",
        "CAST(feature AS VARCHAR) AS feature,",
    ),
)
def chi2_by_feature(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("label"),
        F.array(F.floor(F.col("l_quantity") / 16).cast("double"), "l_discount", "l_tax", F.col("l_linenumber").cast("double")).alias("features"),
    )
    return _tested(hypothesis.chi2_by_feature(lines), "feature")


@query(
    "ks_normal",
    f"""WITH m AS (SELECT avg(value) AS m, stddev_samp(value) AS s, count(*) AS n FROM events),
    h AS (SELECT (value - m) / s AS z, count(*) AS c FROM events, m GROUP BY 1),
    w AS (SELECT z, c, sum(c) OVER (ORDER BY z) AS upto, {normal_cdf_sql('z')} AS f FROM h),
    d AS (SELECT max(greatest(f - (upto - c) / n::DOUBLE, upto / n::DOUBLE - f)) AS d, max(n)::DOUBLE AS n FROM w, m),
    q AS (SELECT d, n, d * sqrt(n) AS y FROM d)
    SELECT 'kolmogorov_smirnov' AS test, round(d, 6) AS statistic, n AS dof, round(greatest({kolmogorov_sql('y', 'n')}, 0), 6) + 0.0 AS p_value FROM q""",
)
def ks_normal(spark, sf):
    events = table(spark, sf, "events")
    moments = events.agg(F.struct(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"))).scalar()
    z = events.withColumn("_m", moments).select(((F.col("value") - F.col("_m.m")) / F.col("_m.s")).alias("z"))
    return rounded(hypothesis.ks_normal(z, "z").select("test", "statistic", "dof", "p_value"))


@query(
    "welch",
    f"""WITH s AS (SELECT event_type = 'error' AS t, count(value) AS n, avg(value) AS m, var_samp(value) AS v FROM events GROUP BY 1),
    p AS (SELECT c.m - t.m AS d, c.v / c.n AS a, t.v / t.n AS b, c.n AS nc, t.n AS nt FROM s c, s t WHERE NOT c.t AND t.t),
    q AS (SELECT d / sqrt(a + b) AS x, (a + b) * (a + b) / (a * a / (nc - 1) + b * b / (nt - 1)) AS k FROM p)
    SELECT 'welch_t' AS test, round(x, 6) + 0.0 AS statistic, round(k, 4) AS dof, round({t_two_sided_sql('x', 'k')}, 6) AS p_value FROM q""",
)
def welch(spark, sf):
    result = hypothesis.welch_test(table(spark, sf, "events"), F.col("event_type") == "error", "value")
    return rounded(result.select("test", "statistic", "dof", "p_value"), 6, dof=4)


@query(
    "discretise",
    """SELECT vec_id, CAST(i - 1 AS INTEGER) AS feature, floor((v * 100) / 16) + 0.0 AS bin
    FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)""",
)
def discretised(spark, sf):
    values = F.transform(F.col("embedding").cast("array<double>"), lambda v: v * 100)
    binned = table(spark, sf, "embeddings").select("vec_id", F.posexplode(discretise(values, 16)).alias("feature", "bin"))
    return binned.withColumn("bin", F.col("bin") + F.lit(0.0))
