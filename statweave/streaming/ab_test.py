"""Streaming two-sample significance test.

The state of the cumulative test is six numbers. A windowed test uses event time
(a window of N batches of a given length), so late and replayed files give the
same answer.
"""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from statweave.operators.hypothesis import welch_statistics, welch_sums, with_t_p_value


def after_peace_period(samples: DataFrame, ts: str, start: datetime, batch_seconds: int, batches: int) -> DataFrame:
    """Leave out the samples of the first ``batches`` batches after ``start``."""
    if batches <= 0:
        return samples
    begin = F.timestamp_seconds(F.lit(int((start - datetime(1970, 1, 1)).total_seconds()) + batches * batch_seconds))
    return samples.where(F.col(ts) >= begin)


def streaming_welch(
    samples: DataFrame,
    treatment: Column,
    value: str,
    window_batches: int = 0,
    batch_seconds: int = 20,
    ts: str | None = None,
    late: str = "1 hour",
) -> DataFrame:
    """Welch's test over a stream of samples, as a streaming (or batch) DataFrame.

    ``window_batches`` 0 tests all samples so far; N > 0 tests every sliding window of
    N batches, for which ``ts`` names the event time.
    """
    sums = welch_sums(treatment, F.col(value))
    if window_batches > 0:
        if ts is None:
            raise ValueError("a windowed test needs the event-time column")
        span = F.window(F.col(ts).cast("timestamp"), f"{window_batches * batch_seconds} seconds", f"{batch_seconds} seconds")
        timed = samples.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
        grouped = timed.groupBy(span.alias("window")).agg(*sums)
        grouped = grouped.select("window.start", "window.end", *[c for c in grouped.columns if c != "window"])
    else:
        grouped = samples.agg(*sums)
    return with_t_p_value(welch_statistics(grouped))


def write_results(
    tests: DataFrame, path: str, checkpoint: str, processing_time: str | None = "20 seconds", output_mode: str = "complete"
) -> StreamingQuery:
    """Append the results of every micro-batch, with its ``batch_id``, to parquet.

    Each batch owns one folder that is replaced when the batch is replayed.
    ``processing_time`` None processes what is available and stops.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    writer = tests.writeStream.outputMode(output_mode).foreachBatch(save).option("checkpointLocation", checkpoint)
    if processing_time is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=processing_time).start()


def read_results(tests: DataFrame, path: str) -> DataFrame:
    """The results ``write_results`` has saved so far, with ``batch_id``."""
    schema = StructType([*tests.schema.fields, StructField("batch_id", LongType())])
    return tests.sparkSession.read.schema(schema).option("basePath", path).parquet(f"{path.rstrip('/')}/batch_id=*")


def run_until_significant(
    tests: DataFrame,
    path: str,
    checkpoint: str,
    alpha: float = 0.05,
    max_batches: int = 10,
    processing_time: str = "20 seconds",
    output_mode: str = "complete",
    poll_seconds: float = 0.2,
    idle_seconds: float | None = None,
) -> dict:
    """Run the test until a p-value is below ``alpha`` or ``max_batches`` have been processed.

    The batch writer saves the results and notes whether one is significant; this
    loop, outside the batch, stops the query. ``idle_seconds`` also ends it when no
    new file arrived for that long.
    """
    seen = {"batches": 0, "significant": False}

    def save(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path.rstrip('/')}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(folder)
        if seen["significant"] or seen["batches"] >= max_batches:
            return  # the query is being stopped; Spark commits this batch, so its result is kept
        saved = batch.sparkSession.read.schema(tests.schema).parquet(folder)
        significant = not saved.where(F.col("p_value") < alpha).isEmpty()
        seen["batches"] += 1
        seen["significant"] = significant

    query = (
        tests.writeStream.outputMode(output_mode)
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=processing_time)
        .start()
    )
    last, since = 0, time.monotonic()
    try:
        while query.isActive and not seen["significant"] and seen["batches"] < max_batches:
            if seen["batches"] != last:
                last, since = seen["batches"], time.monotonic()
            if idle_seconds is not None and time.monotonic() - since > idle_seconds:
                break
            time.sleep(poll_seconds)
        if query.exception() is not None:
            raise query.exception()
    finally:
        query.stop()
    return dict(seen)
