"""The two-sample test over the last N processing batches, with late rows counted.

Every micro-batch leaves one row in a ledger: its own sums, the newest event time so far and
its late rows. The test of a batch combines the ledger rows of the last N batches, so a
window is counted in processing batches, not in event time. The ledger is the only state:
a batch that is replayed after a restart overwrites its row and reads the same earlier
ones, so results do not depend on where a query was stopped. Rows of the ledger that no
window reaches any more are removed.

With an event time, rows older than the newest time of all earlier batches less
``late_seconds`` are left out of the sums and counted (``late_rows`` of the batch,
``late_total`` so far); rows without a time are never late.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statweave.operators.hypothesis import welch_statistics, with_t_p_value

SIDES = ("control", "treatment")
LEDGER = (
    "n_control bigint, mean_control double, m2_control double, n_treatment bigint, mean_treatment double, "
    "m2_treatment double, newest timestamp, late_rows bigint, late_total bigint, batch_id bigint"
)
LEDGER_NAMES = [column.split()[0] for column in LEDGER.split(", ")]
RESULT = (
    "n_control bigint, mean_control double, var_control double, n_treatment bigint, mean_treatment double, var_treatment double, "
    "late_rows bigint, late_total bigint, batches bigint, statistic double, dof double, p_value double, batch_id bigint"
)
RESULT_NAMES = [column.split()[0] for column in RESULT.split(", ")]


def _part(path: str, kind: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{kind}/{batch_id:012d}"


def _own_sums(batch: DataFrame, treatment: Column, value: str, late: Column, newest: Column) -> DataFrame:
    columns = []
    for side, chosen in zip(SIDES, (~treatment, treatment)):
        kept = F.when(chosen & ~late, F.col(value).cast("double"))
        columns += [
            F.count(kept).alias(f"n_{side}"),
            F.coalesce(F.avg(kept), F.lit(0.0)).alias(f"mean_{side}"),
            (F.coalesce(F.var_pop(kept), F.lit(0.0)) * F.count(kept)).alias(f"m2_{side}"),
        ]
    return batch.agg(*columns, F.max(newest).alias("newest"), F.count_if(late).alias("late_rows"))


def combined(ledger: DataFrame) -> DataFrame:
    """One row from a few ledger rows: counts, means and spreads of all of them, late rows of the last."""
    whole = Window.partitionBy(F.lit(0))  # a window's rows, one per batch
    columns, rows = [], ledger
    for side in SIDES:
        n, mean, m2 = f"n_{side}", f"mean_{side}", f"m2_{side}"
        rows = rows.withColumn(f"_{side}", F.try_divide(F.sum(F.col(n) * F.col(mean)).over(whole), F.sum(n).over(whole)))
        spread = F.sum(F.col(m2) + F.col(n) * F.pow(F.col(mean) - F.col(f"_{side}"), 2))
        columns += [F.sum(n).alias(n), F.max(f"_{side}").alias(mean), spread.alias(m2)]
    last = [F.max("newest").alias("newest"), F.max_by("late_rows", "batch_id").alias("late_rows"), F.max("late_total").alias("late_total")]
    return rows.agg(*columns, *last, F.max("batch_id").alias("batch_id"), F.count("*").alias("batches"))


def tested(sums: DataFrame) -> DataFrame:
    """Welch's test of a row of ``combined``."""
    for side in SIDES:
        n = F.col(f"n_{side}")
        sums = sums.withColumn(f"var_{side}", F.when(n > 1, F.col(f"m2_{side}") / (n - 1)))
    return with_t_p_value(welch_statistics(sums))


def write_batch_windows(
    samples: DataFrame,
    treatment: Column,
    value: str,
    path: str,
    checkpoint: str,
    window_batches: int = 0,
    peace_batches: int = 0,
    ts: str | None = None,
    late_seconds: int | None = None,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the test; every batch adds a row to the results of ``read_batch_windows``.

    ``window_batches`` 0 tests all batches so far. The first ``peace_batches`` batches enter
    no test. ``processing_time`` None processes what is available and stops.
    """
    keep = max(window_batches, 1)

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        read = lambda first, last: spark.read.schema(LEDGER).parquet(
            *[_part(path, "ledger", i) for i in range(max(first, 0), last + 1)]
        )
        before = read(batch_id - 1, batch_id - 1).first() if batch_id > 0 else None
        late = F.lit(False)
        if ts is not None and late_seconds is not None and before is not None and before.newest is not None:
            border = F.lit(before.newest) - F.expr(f"make_interval(0, 0, 0, 0, 0, 0, {late_seconds})")
            late = F.coalesce(F.col(ts).cast("timestamp") < border, F.lit(False))
        newest = F.col(ts).cast("timestamp") if ts is not None else F.lit(None).cast("timestamp")
        side = treatment if batch_id >= peace_batches else F.lit(None).cast("boolean")  # of neither side
        own = _own_sums(batch, side, value, late, newest).select(
            *LEDGER_NAMES[:6],
            F.greatest("newest", F.lit(before.newest if before else None).cast("timestamp")).alias("newest"),
            "late_rows",
            (F.col("late_rows") + F.lit(before.late_total if before else 0)).alias("late_total"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
        )
        if window_batches == 0 and before is not None:  # the ledger's row is the sum so far
            own = combined(own.unionByName(read(batch_id - 1, batch_id - 1))).select(*LEDGER_NAMES)
        own.coalesce(1).write.mode("overwrite").parquet(_part(path, "ledger", batch_id))
        result = tested(combined(read(batch_id - keep + 1, batch_id)))
        result.select(*RESULT_NAMES).coalesce(1).write.mode("overwrite").parquet(_part(path, "results", batch_id))
        _remove(spark, _part(path, "ledger", batch_id - keep - 1))

    writer = samples.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if processing_time is None else {"processingTime": processing_time}
    return writer.trigger(**trigger).start()


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_batch_windows(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch: counts, means and variances of its window, the test, and its late rows."""
    return spark.read.schema(RESULT).parquet(f"{path.rstrip('/')}/results/*")


def stop_when_significant(
    query: StreamingQuery, path: str, alpha: float = 0.05, max_batches: int = 10, poll_seconds: float = 0.1, idle_seconds: float | None = None
) -> dict:
    """Stop ``query`` by its progress reports: after the first committed batch with a p-value below ``alpha``, or enough batches.

    Returns the number of batches that were judged, whether one was significant and the last
    judged batch; Spark may have begun another batch by then.
    """
    spark, last, since = SparkSession.getActiveSession(), -1, time.monotonic()
    seen = {"batches": 0, "significant": False, "batch_id": None}
    try:
        while True:
            active = query.isActive
            done = max((p["batchId"] for p in query.recentProgress if p["numInputRows"]), default=-1)
            if done > last:
                rows = read_batch_windows(spark, path).where(F.col("batch_id").between(last + 1, done))
                for row in rows.orderBy("batch_id").limit(max_batches - seen["batches"]).collect():
                    seen["batches"], seen["batch_id"] = seen["batches"] + 1, row.batch_id
                    if row.p_value is not None and row.p_value < alpha:
                        seen["significant"] = True
                        break
                last, since = done, time.monotonic()
            if seen["significant"] or seen["batches"] >= max_batches or not active:
                break
            if idle_seconds is not None and time.monotonic() - since > idle_seconds:
                break
            time.sleep(poll_seconds)
        if query.exception() is not None:
            raise query.exception()
    finally:
        query.stop()
    return seen
