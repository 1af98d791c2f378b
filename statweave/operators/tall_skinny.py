"""Singular vectors and principal components by a QR decomposition in a tree.

Every task reduces its rows to a triangle of d rows, block by block; groups of ``FAN``
triangles are stacked and reduced again until one is left, whose singular values and right
vectors are those of the whole table. A task holds ``FAN`` triangles at most; neither a
d × d matrix nor a vector reaches the driver. For components a leading column of ones is
added: its row of the triangle takes up the means, and what is below and right of it is
the triangle of the centred rows. Unlike the product AᵀA this keeps small singular values.

Null vectors are left out. The entry of a right vector with the largest size is positive
(the first of equals). No rows give no components. Vectors of different lengths are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statweave.functions.arrays import as_array
from statweave.plans.staging import stage_table

FAN, ROWS = 16, 4096
_TRIANGLE = "part bigint, i int, r array<double>"
_COMPONENTS = "component int, s double, j int, v double"


def _reduced(blocks: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(blocks), mode="r")


def _rows(part: int, triangle: np.ndarray) -> list:
    return [
        pa.array([part] * len(triangle), pa.int64()),
        pa.array(range(len(triangle)), pa.int32()),
        pa.array(triangle.tolist(), pa.list_(pa.float64())),
    ]


def triangle(df: DataFrame, features: str = "features", centred: bool = False) -> DataFrame:
    """Staged rows ``part, i, r`` of the upper triangle of the whole table (part 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                block = np.array(batch.column(0).slice(first, ROWS).to_pylist(), float)
                if centred:
                    block = np.column_stack([np.ones(len(block)), block])
                held = _reduced([block] if held is None else [held, block])
        if held is not None:
            yield pa.RecordBatch.from_arrays(_rows(TaskContext.get().partitionId(), held), names=["part", "i", "r"])

    def join(table: pa.Table) -> pa.Table:
        ordered = table.sort_by([("part", "ascending"), ("i", "ascending")])
        stacked = np.array(ordered.column("r").to_pylist(), float)
        return pa.table(_rows(ordered.column("group")[0].as_py(), _reduced([stacked])), names=["part", "i", "r"])

    vectors = df.select(as_array(df, features).alias("x")).where("x IS NOT NULL")
    level = stage_table(vectors.mapInArrow(run, _TRIANGLE))
    last = level.agg(F.max("part")).first()[0] or 0
    while last > 0:
        last //= FAN
        level = stage_table(level.withColumn("group", F.floor(F.col("part") / FAN)).groupBy("group").applyInArrow(join, _TRIANGLE))
    return level


def singular_vectors(df: DataFrame, k: int, features: str = "features", r_cond: float = 1e-9, centred: bool = False) -> DataFrame:
    """``component, s, j, v``: the ``k`` largest singular values and the entries of their right vectors.

    Values below ``r_cond`` times the largest are left out. With ``centred`` they are those of the
    rows less their mean: principal components, s² / (n − 1) their variances.
    """

    def decompose(table: pa.Table) -> pa.Table:
        matrix = np.array(table.sort_by("i").column("r").to_pylist(), float)
        if centred:
            matrix = matrix[1:, 1:]
        _, s, right = np.linalg.svd(matrix)
        s = s[:k][s[:k] > r_cond * max(s[0], 1e-300)] if len(s) else s
        right = right[: len(s)]
        largest = np.abs(right).round(12).argmax(axis=1) if len(right) else np.zeros(0, int)
        right = right * np.sign(right[np.arange(len(right)), largest])[:, None]
        width = right.shape[1]
        return pa.table(
            [
                pa.array(np.repeat(np.arange(len(s)), width), pa.int32()),
                pa.array(np.repeat(s, width)),
                pa.array(np.tile(np.arange(width), len(s)), pa.int32()),
                pa.array(right.reshape(-1)),
            ],
            names=["component", "s", "j", "v"],
        )

    return stage_table(triangle(df, features, centred).groupBy("part").applyInArrow(decompose, _COMPONENTS))


def left_vectors(df: DataFrame, components: DataFrame, key: str, features: str = "features") -> DataFrame:
    """``key, component, u``: each row's entry of the left vectors, A·V / s, by an equi-join on the position."""
    cells = df.select(key, F.posexplode(as_array(df, features)).alias("j", "_x"))
    weights = components.select("j", "component", (F.col("v") / F.col("s")).alias("_w"))
    return cells.join(weights, "j").groupBy(key, "component").agg(F.sum(F.col("_x") * F.col("_w")).alias("u"))
