"""The streaming significance test over the event files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from statweave.queries.registry import query, rounded, scratch
from statweave.queries.statistics import t_two_sided_sql
from statweave.sources import text
from statweave.sources.tables import table
from statweave.streaming import ab_test

DAY = 86400


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _welch_sql(groups: str, source: str) -> str:
    by = f"{groups}," if groups else ""
    return f"""WITH s AS (SELECT {by} count(*) FILTER (WHERE NOT t) AS n_control, avg(value) FILTER (WHERE NOT t) AS mc, var_samp(value) FILTER (WHERE NOT t) AS vc,
    count(*) FILTER (WHERE t) AS n_treatment, avg(value) FILTER (WHERE t) AS mt, var_samp(value) FILTER (WHERE t) AS vt
    FROM ({source}) GROUP BY {groups or "()"}),
    p AS (SELECT *, vc / n_control AS a, vt / n_treatment AS b, n_control > 1 AND n_treatment > 1 AS ok FROM s),
    q AS (SELECT *, CASE WHEN ok THEN (mc - mt) / sqrt(a + b) END AS x,
      CASE WHEN ok THEN (a + b) * (a + b) / (a * a / (n_control - 1) + b * b / (n_treatment - 1)) END AS k FROM p)
    SELECT {by} n_control, n_treatment, round(x, 6) + 0.0 AS statistic, round(k, 4) AS dof, round({t_two_sided_sql("x", "k")}, 6) AS p_value FROM q"""


def _run(spark, tests, output_mode: str = "complete"):
    """Run the stream over the files that exist and return its saved results."""
    path, checkpoint = scratch(spark, "results"), scratch(spark, "progress")
    writer = ab_test.write_results(tests, path, checkpoint, None, output_mode)
    writer.awaitTermination()
    if writer.exception() is not None:
        raise writer.exception()
    return ab_test.read_results(tests, path)


@query("stream_welch", _welch_sql("", "SELECT event_type = 'error' AS t, value FROM events"))
def stream_welch(spark, sf):
    """Final state of the cumulative test over the event stream."""
    results = _run(spark, ab_test.streaming_welch(event_stream(spark, sf), F.col("event_type") == "error", "value"))
    last = results.agg(F.max("batch_id").alias("b")).scalar()
    return rounded(results.where(F.col("batch_id") == last).select("n_control", "n_treatment", "statistic", "dof", "p_value"), 6, dof=4)


@query(
    "stream_welch_windows",
    _welch_sql(
        "start",
        """SELECT date_trunc('day', ts) - k * INTERVAL 1 DAY AS start, event_type = 'error' AS t, value
        FROM events, (SELECT unnest([0, 1, 2]) AS k)""",
    ),
)
def stream_welch_windows(spark, sf):
    """Sliding windows of the last three daily batches, in event time."""
    tests = ab_test.streaming_welch(event_stream(spark, sf), F.col("event_type") == "error", "value", 3, DAY, "ts")
    results = _run(spark, tests, "update")
    newest = Window.partitionBy("start").orderBy(F.desc("batch_id"))
    rows = results.withColumn("_n", F.row_number().over(newest)).where("_n = 1").select(
        F.col("start").cast("timestamp_ntz").alias("start"), "n_control", "n_treatment", "statistic", "dof", "p_value"
    )
    return rounded(rows, 6, dof=4)


@query(
    "stream_peace_period",
    _welch_sql("", "SELECT event_type = 'error' AS t, value FROM events WHERE ts >= TIMESTAMP '2024-01-06'"),
)
def stream_peace_period(spark, sf):
    """The cumulative test without the first five daily batches."""
    samples = ab_test.after_peace_period(event_stream(spark, sf), "ts", datetime(2024, 1, 1), DAY, 5)
    results = _run(spark, ab_test.streaming_welch(samples, F.col("event_type") == "error", "value"))
    last = results.agg(F.max("batch_id").alias("b")).scalar()
    return rounded(results.where(F.col("batch_id") == last).select("n_control", "n_treatment", "statistic", "dof", "p_value"), 6, dof=4)


@query("stream_text_welch", _welch_sql("", "SELECT event_type = 'error' AS t, value FROM events"))
def stream_text_welch(spark, sf):
    """The test over text lines ``flag,value``, two files per micro-batch, until all files are read."""
    folder = scratch(spark, "samples")
    lines = table(spark, sf, "events").select(F.concat_ws(",", F.col("event_type") == "error", "value").alias("value"))
    lines.repartition(4).write.text(folder)
    samples = text.shape_ab_samples(text.stream_lines(spark, folder, 2))
    results = _run(spark, ab_test.streaming_welch(samples, F.col("is_treatment"), "value"))
    last = results.agg(F.max("batch_id").alias("b")).scalar()
    return rounded(results.where(F.col("batch_id") == last).select("n_control", "n_treatment", "statistic", "dof", "p_value"), 6, dof=4)


@query("stream_early_stop")
def stream_early_stop(spark, sf):
    """Stops after the first significant batch, or after ten."""
    folder = scratch(spark, "samples")
    lines = table(spark, sf, "events").select(F.concat_ws(",", F.col("value") > 60, "value").alias("value"))
    lines.repartition(4).write.text(folder)
    samples = text.shape_ab_samples(text.stream_lines(spark, folder, 1))
    tests = ab_test.streaming_welch(samples, F.col("is_treatment"), "value")
    path = scratch(spark, "results")
    ab_test.run_until_significant(tests, path, scratch(spark, "progress"), processing_time="0 seconds", idle_seconds=20)
    return ab_test.read_results(tests, path).select("batch_id", "n_control", "n_treatment", "statistic", "dof", "p_value")
