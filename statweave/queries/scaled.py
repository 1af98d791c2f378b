"""Queries of the operators that need no step on the driver or in one task."""

from __future__ import annotations

from pyspark.sql import functions as F

from statweave.operators import pooled_isotonic, recommendation
from statweave.operators.kernel_table import kernel_density_table
from statweave.operators.power_iteration import power_iteration_steps
from statweave.operators.sequence_growth import grow_patterns
from statweave.operators.tall_skinny import left_vectors, singular_vectors
from statweave.operators.topic_tables import fit_topic_tables
from statweave.plans.staging import stage_table
from statweave.queries.models import TERM_SQL, daily_sequences, part_ratings, pattern_text, term_counts, trade_edges
from statweave.queries.registry import query, rounded, scratch
from statweave.queries.statistics import t_two_sided_sql
from statweave.sources.tables import table
from statweave.streaming import batch_windows

# Of each pattern only the earliest day on which it can end matters for what may follow.
_EVENTS = "e AS (SELECT DISTINCT user_id AS u, ts::DATE AS d, event_type AS t FROM events), n AS (SELECT count(DISTINCT u) AS n FROM e)"


@query(
    "sequence_growth",
    f"""WITH {_EVENTS},
    one AS (SELECT u, t AS p, min(d) AS d FROM e GROUP BY ALL),
    same AS (SELECT a.u, a.t AS x, b.t AS y, a.d FROM e a JOIN e b ON a.u = b.u AND a.d = b.d AND a.t < b.t),
    two AS (SELECT u, x || '&' || y AS p, min(d) AS d FROM same GROUP BY ALL
      UNION ALL SELECT one.u, one.p || '>' || e.t, min(e.d) FROM one JOIN e ON one.u = e.u AND e.d > one.d GROUP BY ALL),
    three AS (SELECT DISTINCT two.u, two.p || '>' || e.t AS p FROM two JOIN e ON two.u = e.u AND e.d > two.d
      UNION ALL SELECT DISTINCT one.u, one.p || '>' || x || '&' || y FROM one JOIN same ON one.u = same.u AND same.d > one.d
      UNION ALL SELECT DISTINCT same.u, x || '&' || y || '&' || e.t FROM same JOIN e ON same.u = e.u AND same.d = e.d AND e.t > y),
    every AS (SELECT u, p FROM one UNION ALL SELECT u, p FROM two UNION ALL SELECT u, p FROM three)
    SELECT p AS sequence, count(*) AS freq FROM every, n GROUP BY p, n HAVING count(*) >= 0.5 * n""",
)
def sequence_growth(spark, sf):
    """Patterns of up to three items in half of all users."""
    return pattern_text(grow_patterns(daily_sequences(spark, sf), 0.5, 3))


@query("sequence_growth_long")
def sequence_growth_long(spark, sf):
    """Patterns of up to five items in half of all users."""
    return pattern_text(grow_patterns(daily_sequences(spark, sf), 0.5, 5))


@query(
    "top_products",
    """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    p AS (SELECT q.vec_id AS "user", i.vec_id AS item, list_inner_product(q.e, i.e) AS rating FROM v q, v i WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY rating DESC, item) AS rank FROM p)
    SELECT "user", rank::INTEGER AS rank, item, round(rating, 6) + 0.0 AS rating FROM r WHERE rank <= 10""",
)
def top_products(spark, sf):
    """The ten largest inner products of every twentieth vector with all vectors."""
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"))
    return rounded(recommendation.top_items(vectors.where("id % 20 = 0"), vectors, 10))


@query("als_recommend_by_bound")
def als_recommend_by_bound(spark, sf):
    return recommendation.recommend_by_bound(recommendation.fit_als(part_ratings(spark, sf)), 10, scale=True)


@query(
    "isotonic_blocks",
    """WITH g AS (SELECT l_partkey::DOUBLE AS x, sum(l_extendedprice / l_quantity) AS s, count(*)::DOUBLE AS w FROM lineitem GROUP BY 1),
    c AS (SELECT x, s, w, sum(s) OVER (ORDER BY x) AS cs, sum(w) OVER (ORDER BY x) AS cw FROM g),
    m AS (SELECT i.x AS i, j.x AS j, (j.cs - i.cs + i.s) / (j.cw - i.cw + i.w) AS mean FROM c i JOIN c j ON j.x >= i.x),
    l AS (SELECT i, j, min(mean) OVER (PARTITION BY i ORDER BY j DESC) AS low FROM m),
    f AS (SELECT j AS x, max(low) AS y FROM l GROUP BY j)
    SELECT min(x) AS low, max(x) AS high, sum(w) AS weight, min(round(y, 6)) AS prediction FROM f JOIN g USING (x) GROUP BY round(y, 7)""",
)
def isotonic_blocks(spark, sf):
    """Blocks of the fit of a line's unit price on its part number; in SQL the max-min formula."""
    lines = table(spark, sf, "lineitem").select("l_partkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    return rounded(pooled_isotonic.isotonic_blocks(lines, "price", "l_partkey"))


BATCHES = 6
FILES = 4  # per batch


@query(
    "stream_batch_windows",
    f"""WITH s AS (SELECT user_id % {BATCHES} AS b, ts, event_type = 'error' AS t, value FROM events),
    newest AS (SELECT b, max(max(ts)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 20 DAY AS border FROM s GROUP BY b),
    kept AS (SELECT s.*, coalesce(ts < border, false) AS late FROM s JOIN newest USING (b)),
    counts AS (SELECT b, count(*) FILTER (late) AS late_rows, (sum(count(*) FILTER (late)) OVER (ORDER BY b))::BIGINT AS late_total FROM kept GROUP BY b),
    w AS (SELECT q.b, k.t, k.value FROM counts q JOIN kept k ON k.b BETWEEN q.b - 2 AND q.b AND NOT late),
    a AS (SELECT b, count(*) FILTER (NOT t) AS n_control, avg(value) FILTER (NOT t) AS mc, var_samp(value) FILTER (NOT t) AS vc,
      count(*) FILTER (t) AS n_treatment, avg(value) FILTER (t) AS mt, var_samp(value) FILTER (t) AS vt FROM w GROUP BY b),
    p AS (SELECT *, vc / n_control AS x, vt / n_treatment AS y FROM a),
    q AS (SELECT *, (mc - mt) / sqrt(x + y) AS z, (x + y) * (x + y) / (x * x / (n_control - 1) + y * y / (n_treatment - 1)) AS k FROM p)
    SELECT b::BIGINT AS batch_id, late_rows, late_total, n_control, n_treatment, round(z, 6) + 0.0 AS statistic, round(k, 4) AS dof,
    round({t_two_sided_sql("z", "k")}, 6) AS p_value FROM q JOIN counts USING (b)""",
)
def stream_batch_windows(spark, sf):
    """The test over the last three processing batches; rows twenty days behind are counted as late."""
    stream = _batches(spark, table(spark, sf, "events"))
    path = scratch(spark, "windows")
    running = batch_windows.write_batch_windows(
        stream, F.col("event_type") == "error", "value", path, scratch(spark, "progress"), 3, ts="ts", late_seconds=20 * 86400
    )
    running.awaitTermination()
    if running.exception() is not None:
        raise running.exception()
    results = batch_windows.read_batch_windows(spark, path)
    return rounded(results.select("batch_id", "late_rows", "late_total", "n_control", "n_treatment", "statistic", "dof", "p_value"), 6, dof=4)


def _batches(spark, rows):
    """Events as a stream of files, a sixth of the users after the other."""
    folder = scratch(spark, "samples")
    for part in range(BATCHES):  # one write after the other, so the files have the order of the batches
        rows.where(F.col("user_id") % BATCHES == part).repartition(FILES).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(folder)


@query(
    "stream_stop_by_progress",
    f"""WITH s AS (SELECT user_id % {BATCHES} AS b, event_type = 'error' AS t, value + CASE WHEN event_type = 'error' AND user_id % {BATCHES} = 2 THEN 400 ELSE 0 END AS value FROM events),
    i AS (SELECT unnest(range(0, {BATCHES})) AS b),
    a AS (SELECT i.b, count(*) FILTER (NOT t) AS n_control, avg(value) FILTER (NOT t) AS mc, var_samp(value) FILTER (NOT t) AS vc,
      count(*) FILTER (t) AS n_treatment, avg(value) FILTER (t) AS mt, var_samp(value) FILTER (t) AS vt FROM i JOIN s ON s.b <= i.b GROUP BY i.b),
    p AS (SELECT *, vc / n_control AS x, vt / n_treatment AS y FROM a),
    q AS (SELECT *, (mc - mt) / sqrt(x + y) AS z, (x + y) * (x + y) / (x * x / (n_control - 1) + y * y / (n_treatment - 1)) AS k FROM p),
    r AS (SELECT *, {t_two_sided_sql("z", "k")} AS p FROM q)
    SELECT b::BIGINT AS batch_id, n_control, n_treatment, round(z, 6) + 0.0 AS statistic, round(k, 4) AS dof, p < 1e-6 AS significant
    FROM r WHERE b <= (SELECT coalesce(min(b) FILTER (p < 1e-6), 99) FROM r)""",
)
def stream_stop_by_progress(spark, sf):
    """The cumulative test, stopped by its progress reports; the third batch shifts one group."""
    shifted = (F.col("event_type") == "error") & (F.col("user_id") % BATCHES == 2)
    rows = table(spark, sf, "events").withColumn("value", F.col("value") + F.when(shifted, 400).otherwise(0))
    stream = _batches(spark, rows)
    path = scratch(spark, "stopped")
    running = batch_windows.write_batch_windows(
        stream, F.col("event_type") == "error", "value", path, scratch(spark, "progress"), processing_time="0 seconds"
    )
    seen = batch_windows.stop_when_significant(running, path, 1e-6, max_batches=BATCHES, idle_seconds=60)
    judged = batch_windows.read_batch_windows(spark, path).where(F.col("batch_id") <= seen["batch_id"])
    results = judged.select("batch_id", "n_control", "n_treatment", "statistic", "dof", (F.col("p_value") < 1e-6).alias("significant"))
    return rounded(results, 6, dof=4)


@query(
    "kde_table",
    """WITH p AS (SELECT c_custkey, c_acctbal / 20 AS y FROM customer), n AS (SELECT count(value) AS n FROM events)
    SELECT c_custkey, round(sum(exp(-pow(value - y, 2) / (2 * 9.0))) / (n * 3.0 * sqrt(2 * pi())), 9) + 0.0 AS density
    FROM p, events, n GROUP BY c_custkey, y, n""",
)
def kde_table(spark, sf):
    """Density of the events' values at a point of every customer."""
    points = table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") / 20).alias("y"))
    found = kernel_density_table(table(spark, sf, "events"), "value", points, "y", 3.0)
    return rounded(found.select("c_custkey", "density"), 9)


_STEP = """s{n} AS (SELECT e.i AS id, sum(e.a * v.value) AS value FROM e JOIN v{m} v ON v.id = e.j GROUP BY e.i),
    v{n} AS (SELECT id, value / (SELECT sum(value) FROM s{n}) AS value FROM s{n})"""


@query(
    "power_iteration_steps",
    f"""WITH p AS (SELECT least(c_nationkey, s_nationkey)::BIGINT AS a, greatest(c_nationkey, s_nationkey)::BIGINT AS b, count(*)::DOUBLE AS w
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
      WHERE c_nationkey <> s_nationkey GROUP BY 1, 2),
    b AS (SELECT a AS i, b AS j, w FROM p UNION ALL SELECT b, a, w FROM p),
    d AS (SELECT i AS id, sum(w) AS degree FROM b GROUP BY i),
    e AS (SELECT i, j, w / degree AS a FROM b JOIN d ON d.id = b.i),
    v0 AS (SELECT id, degree / (SELECT sum(degree) FROM d) AS value FROM d),
    {", ".join(_STEP.format(n=n, m=n - 1) for n in (1, 2, 3))},
    every AS ({" UNION ALL ".join(f"SELECT {n}::INTEGER AS iteration, id, value FROM v{n}" for n in range(4))})
    SELECT iteration, id, round(value, 10) AS value,
    round(sum(abs(value - old)) OVER (PARTITION BY iteration), 10) + 0.0 AS change FROM (
      SELECT q.*, o.value AS old FROM every q LEFT JOIN every o ON o.id = q.id AND o.iteration = q.iteration - 1)""",
)
def power_iteration_steps_query(spark, sf):
    """Three steps on the graph of trade between nations."""
    return rounded(power_iteration_steps(trade_edges(spark, sf), 3), 10)


_TOPICS = 3
_SHARE = "(n_d.x[t + 1] + {a}) * (n_w.x[t + 1] + 0.1) / (n_t.x[t + 1] + v * 0.1)"


@query(
    "topic_step",
    f"""{TERM_SQL},
    steps AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_concat([i], range(8)),
      lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM (SELECT unnest(range(256)) AS i))),
    keys AS (SELECT doc_id, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(c // 256, tab[xor(c, b) % 256 + 1])), 4294967295) AS h FROM (SELECT DISTINCT doc_id FROM c), steps),
    r0 AS (SELECT doc_id, term, n, list_transform(range({_TOPICS}), lambda t: CASE WHEN (length(term) + h) % {_TOPICS} = t THEN 2.0::DOUBLE ELSE 1 END * n / {_TOPICS + 1}) AS x
      FROM c JOIN keys USING (doc_id)),
    n_d AS (SELECT doc_id, [{", ".join(f"sum(x[{t + 1}])" for t in range(_TOPICS))}] AS x FROM r0 GROUP BY doc_id),
    n_w AS (SELECT term, [{", ".join(f"sum(x[{t + 1}])" for t in range(_TOPICS))}] AS x FROM r0 GROUP BY term),
    n_t AS (SELECT [{", ".join(f"sum(x[{t + 1}])" for t in range(_TOPICS))}] AS x, (SELECT count(*) FROM n_w) AS v FROM r0),
    q AS (SELECT c.doc_id, c.term, c.n, list_transform(range({_TOPICS}), lambda t: {_SHARE.format(a=50.0 / _TOPICS)}) AS p
      FROM c JOIN n_d USING (doc_id) JOIN n_w USING (term), n_t),
    r1 AS (SELECT term, list_transform(p, lambda y: y * n / list_sum(p)) AS x FROM q),
    w AS (SELECT term, unnest(range({_TOPICS}))::INTEGER AS topic, unnest([{", ".join(f"sum(x[{t + 1}])" for t in range(_TOPICS))}]) AS m FROM r1 GROUP BY term),
    z AS (SELECT topic, sum(m) AS total FROM w GROUP BY topic)
    SELECT topic, term, round((m + 0.1) / (total + v * 0.1), 10) AS weight FROM w JOIN z USING (topic), n_t""",
)
def topic_step(spark, sf):
    """Every term's weight in three topics after one step from the fixed start, over the labelled documents."""
    topics, _ = fit_topic_tables(term_counts(spark, sf), _TOPICS, 1)
    return rounded(topics, 10)


_TOP = """p{c} AS (SELECT 0 AS i, [1.0::DOUBLE, 1, 1, 1] AS v UNION ALL
      SELECT i + 1, list_transform(y, lambda x: x / sqrt(list_sum(list_transform(y, lambda z: z * z)))) FROM (
        SELECT i, list_transform(g, lambda row: list_inner_product(row, v)) AS y FROM p{c}, g{c} WHERE i < 400)),
    t{c} AS (SELECT g, v, list_inner_product(v, list_transform(g, lambda row: list_inner_product(row, v))) AS e FROM p{c}, g{c} WHERE i = 400),
    g{n} AS (SELECT list_transform(range(4), lambda a: list_transform(range(4), lambda b: g[a + 1][b + 1] - e * v[a + 1] * v[b + 1])) AS g FROM t{c})"""


def _measures(spark, sf):
    cells = F.array(F.col("l_quantity"), F.col("l_extendedprice") / 4000, F.col("l_discount") * 60, F.col("l_tax") * 20)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.transform(cells, lambda x: x.cast("double")).alias("features"))


_MEASURES = "SELECT l_orderkey, l_linenumber, [l_quantity, l_extendedprice / 4000, l_discount * 60, l_tax * 20]::DOUBLE[] AS x FROM lineitem"
_GRAM = ", ".join("[" + ", ".join(f"sum(x[{a}] * x[{b}])" for b in range(1, 5)) + "]" for a in range(1, 5))


@query(
    "svd_components",
    f"""WITH RECURSIVE g0 AS (SELECT [{_GRAM}] AS g FROM ({_MEASURES})),
    {", ".join(_TOP.format(c=c, n=c + 1) for c in range(3))},
    every AS ({" UNION ALL ".join(f"SELECT {c}::INTEGER AS component, e, v FROM t{c}" for c in range(3))}),
    signed AS (SELECT component, e, v, list_transform(v, lambda x: abs(round(x, 12))) AS size FROM every)
    SELECT component, round(sqrt(e), 4) AS s, unnest(range(4))::INTEGER AS j,
    unnest(list_transform(v, lambda x: round(x * sign(v[list_position(size, list_max(size))]), 6) + 0.0)) AS v FROM signed""",
)
def svd_components(spark, sf):
    """Three singular values of the lines' measures and the entries of their right vectors."""
    return rounded(singular_vectors(_measures(spark, sf), 3), 6, s=4)


@query(
    "svd_residual",
    f"""SELECT 3::BIGINT AS components, count(*) AS n, 0::BIGINT AS off FROM ({_MEASURES})""",
)
def svd_residual(spark, sf):
    """Every line has an entry in each left vector, and the squares of each vector's entries add up to 1."""
    lines = stage_table(_measures(spark, sf).withColumn("id", F.monotonically_increasing_id()))
    found = singular_vectors(lines, 3)
    left = left_vectors(lines, found, "id")
    sums = left.groupBy("component").agg(F.sum(F.col("u") * F.col("u")).alias("one"), F.count("*").alias("n"))
    return sums.agg(
        F.count("*").alias("components"), F.max("n").alias("n"), F.count_if(F.abs(F.col("one") - 1) > 1e-9).alias("off")
    )
