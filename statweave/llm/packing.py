"""Packing into optimal length buckets and token-budget batches.

A text of more than ``max_tokens`` ids is cut into pieces of that length, so the global
length histogram has at most ``max_tokens`` rows, whatever the input; it is the only thing
that reaches the driver. Dynamic programming over it chooses the ``buckets`` upper bounds
with the least padding in all. Inside a bucket pieces are numbered and cut into batches of
as many padded pieces as the token budget holds.

The numbers are global: pieces are dealt to slots by a hash, about ``SLOT_ROWS`` rows each,
numbered inside their slot, and moved up by the rows of earlier slots, so a bucket with a
third of all rows is still numbered by many tasks and only its last batch may be partial.

Every text has its ids and one end id; null and empty texts are one id long. Repeated rows
are pieces of their own. An empty table gives no rows. With fewer lengths than buckets
every length is a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statweave.llm.base import chunks, text_bytes
from statweave.llm.tokens import process_encoder
from statweave.plans.staging import stage_table

SLOT_ROWS = 50_000


def token_lengths(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``_tokens``: the number of ids of the whole text and its end id."""
    source = docs.select(F.col(key), text_bytes(F.col(text)).alias("_bytes"))
    schema = docs.select(F.col(key), F.lit(0).cast("bigint").alias("_tokens")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = process_encoder(path)
        for batch in batches:
            texts = [v or b"" for v in batch.column(1).to_pylist()]
            count = np.ones(len(texts), np.int64)
            for first, last in chunks(texts):
                count[first:last] += encoder.count(texts[first:last])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count)], names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds, at most ``buckets`` of them, with the least padded total."""
    order = np.argsort(lengths)
    lengths, counts = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    n = len(lengths)
    below = np.concatenate([[0], np.cumsum(counts)])
    best = np.concatenate([[0.0], np.full(n, np.inf)])
    choices = []
    for _ in range(min(buckets, n)):
        fresh, choice = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        fresh[0] = 0.0
        for j in range(1, n + 1):
            cost = best[:j] + float(lengths[j - 1]) * (below[j] - below[:j])
            choice[j] = int(np.argmin(cost))
            fresh[j] = cost[choice[j]]
        best = fresh
        choices.append(choice)
    bounds, j = [], n
    for choice in reversed(choices):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(choice[j])
    return bounds[::-1]


def packed(
    lengths: DataFrame, key: str = "doc_id", tokens: str = "_tokens", max_tokens: int = 2048, buckets: int = 12, budget: int = 65_536
) -> DataFrame:
    """One row per piece: key, piece, start, length, bucket_length, batch (numbered per bucket)."""
    rows = lengths.select(F.col(key).alias("_key"), F.col(tokens).alias("_tokens"))
    pieces = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_tokens") - 1) / max_tokens))
    cut = stage_table(
        rows.select("_key", "_tokens", F.explode(pieces).alias("piece")).select(
            "_key",
            "piece",
            (F.col("piece") * max_tokens).alias("start"),
            F.least(F.lit(max_tokens).cast("bigint"), F.col("_tokens") - F.col("piece") * max_tokens).alias("length"),
        )
    )
    histogram = cut.groupBy("length").count().collect()
    found, counts = np.array([r["length"] for r in histogram], np.int64), np.array([r["count"] for r in histogram], np.int64)
    bounds = optimal_bounds(found, counts, buckets)
    bucket, slots = F.lit(None).cast("bigint"), F.lit(1)
    for low, high in reversed(list(zip([0, *bounds], bounds))):
        rows = int(counts[(found > low) & (found <= high)].sum())
        bucket = F.when(F.col("length") <= high, F.lit(high).cast("bigint")).otherwise(bucket)
        slots = F.when(F.col("length") <= high, F.lit(math.ceil(rows / SLOT_ROWS))).otherwise(slots)
    placed = cut.withColumns(
        {"bucket_length": bucket, "slot": F.pmod(F.xxhash64("_key", "piece"), slots.cast("bigint"))}
    )
    totals = placed.groupBy("bucket_length", "slot").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("bucket_length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("bucket_length", "slot", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket_length", "slot").orderBy("_key", "piece")
    numbered = placed.withColumn("at", F.row_number().over(inside)).join(offsets, ["bucket_length", "slot"])
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_length")))
    return numbered.select(
        F.col("_key").alias(key),
        "piece",
        "start",
        "length",
        "bucket_length",
        F.floor((F.col("before") + F.col("at") - 1) / per_batch).alias("batch"),
    )
