"""Isotonic regression by pooling adjacent violators over ranges, without a pass on the driver.

Pooling may merge adjacent violators in any order and ends in the same blocks. So the
ordered blocks are cut into chunks of at most ``CHUNK``, each chunk is pooled in its own task, and
what is left is cut again with the borders moved by half a chunk, until no border separates
two violators. Every round but the last merges at least one pair at each violated border;
long violations shrink to a block a chunk in one round. Blocks are a table from first
to last; the driver learns only whether a border is violated.

Rows with equal feature are one point (weighted mean). Rows with a null in feature, label or
weight, and without a positive weight, are left out; a NaN feature is an error. No rows give no blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statweave.plans.prefix_sum import row_index
from statweave.plans.staging import stage_table

CHUNK = 100_000
_BLOCKS = "low double, high double, weight double, total double"


def _pooled(table: pa.Table) -> pa.Table:
    """Blocks in rising order with means that rise strictly."""
    rows = np.column_stack([table.column(c).to_numpy() for c in ("low", "high", "weight", "total")])
    stack: list[list[float]] = []
    for low, high, weight, total in rows[np.argsort(rows[:, 0])].tolist():
        while stack and stack[-1][3] * weight >= total * stack[-1][2]:
            low, _, w, t = stack.pop()
            weight, total = weight + w, total + t
        stack.append([low, high, weight, total])
    columns = np.array(stack).reshape(-1, 4).T
    chunk = table.column("chunk").slice(0, 1).to_pylist() * len(stack)
    return pa.table([*map(pa.array, columns), pa.array(chunk, pa.int64())], names=["low", "high", "weight", "total", "chunk"])


def isotonic_blocks(
    df: DataFrame, label: str, feature: str, weight: str | None = None, increasing: bool = True, chunk: int = CHUNK
) -> DataFrame:
    """``low, high, weight, prediction``: the blocks of the fit in rising order of the feature."""
    sign = 1.0 if increasing else -1.0
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    points = df.select(F.col(feature).cast("double").alias("low"), (F.col(label).cast("double") * sign).alias("y"), w.alias("w"))
    summed = points.dropna().where("w > 0").groupBy("low").agg(F.sum("w").alias("weight"), F.sum(F.col("w") * F.col("y")).alias("total"))
    blocks = stage_table(summed.select("low", F.col("low").alias("high"), "weight", "total"))
    turn = 0
    while True:
        shift = (turn % 2) * (chunk // 2)
        numbered = row_index(blocks, "low").withColumn("chunk", F.floor((F.col("row_index") + shift) / chunk).cast("bigint"))
        pooled = stage_table(numbered.drop("row_index").groupBy("chunk").applyInArrow(_pooled, f"{_BLOCKS}, chunk bigint"))
        mean = F.col("total") / F.col("weight")
        ends = pooled.groupBy("chunk").agg(F.min_by(mean, "low").alias("first"), F.max_by(mean, "low").alias("last"))
        previous = F.lag("last").over(Window.partitionBy(F.lit(0)).orderBy("chunk"))  # one row per chunk
        blocks, turn = pooled.drop("chunk"), turn + 1
        if ends.withColumn("_before", previous).where("_before >= first").isEmpty():
            return blocks.select("low", "high", "weight", (F.col("total") / F.col("weight") * sign).alias("prediction"))


def block_boundaries(blocks: DataFrame) -> DataFrame:
    """``boundary, prediction``: the ends of every block, between which a model interpolates."""
    ends = F.array_distinct(F.array("low", "high"))
    return blocks.select(F.explode(ends).alias("boundary"), "prediction")
