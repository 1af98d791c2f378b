"""Gaussian kernel density at a table of points, by Hermite expansions over grid cells.

Samples are summed into cells of ``CELL`` bandwidths: a cell keeps its count and the moments
of its samples about its centre, so any number of samples is one row per cell after the
map-side combine. With t the point's and s a sample's distance to the centre in bandwidths,
exp(−(t − s)²/2) = exp(−t²/2) · Σ sᵏ/k! · Heₖ(t). A point meets the cells within ``REACH``
bandwidths by an equi-join on the cell number and evaluates the first ``ORDER`` terms.

Error: leaving out farther cells costs at most exp(−REACH²/2) of the kernel's peak; the terms
beyond ``ORDER`` at most 1.09 · Σ (CELL/2)ᵏ/√k! of it (both below 2e-14 at the defaults).
Null samples and points are left out (null points have a null density); repeated points are
evaluated each; without samples every density is null.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statweave.plans.staging import is_small, stage_table

CELL, REACH, ORDER = 0.5, 8.0, 14


def error_bound(cell: float = CELL, reach: float = REACH, order: int = ORDER) -> float:
    """Largest error of a density times bandwidth · √(2π)."""
    rest = sum((cell / 2) ** k / math.sqrt(math.factorial(k)) for k in range(order, order + 60))
    return math.exp(-(reach**2) / 2) + 1.09 * rest




def kernel_density_table(
    samples: DataFrame, value: str, points: DataFrame, point: str, bandwidth: float = 1.0, cell: float = CELL, reach: float = REACH, order: int = ORDER
) -> DataFrame:
    """``points`` with the column ``density``."""
    h = float(bandwidth)
    width = cell * h
    number = lambda x: F.floor(x / width).cast("bigint")
    middle = lambda c: (c + 0.5) * width
    given = samples.select(F.col(value).cast("double").alias("_x")).where("_x IS NOT NULL")
    placed = given.withColumn("_cell", number(F.col("_x"))).withColumn("_s", (F.col("_x") - middle(F.col("_cell"))) / h)
    cells = placed.groupBy("_cell").agg(*[F.sum(F.pow("_s", F.lit(float(k)))).alias(f"_m{k}") for k in range(order)])
    total = given.agg(F.count("*").alias("n")).first()["n"]
    cells = stage_table(cells)
    # points are many rows of few bytes in their file, and 2 · REACH / CELL + 1 times as many here: never the broadcast side
    cells = F.broadcast(cells) if is_small(cells) else cells.hint("merge")
    numbered = points.withColumn("_id", F.monotonically_increasing_id()).withColumn("_y", F.col(point).cast("double"))
    steps = math.ceil(reach / cell)
    near = numbered.select("_id", "_y", F.explode(F.sequence(number(F.col("_y")) - steps, number(F.col("_y")) + steps)).alias("_cell"))
    t = (F.col("_y") - middle(F.col("_cell"))) / h
    # the polynomials are evaluated step by step, so that each is computed once
    met = near.join(cells, "_cell").withColumn("_t", t)
    met = met.withColumn("_p0", F.lit(1.0)).withColumn("_p1", F.col("_t"))
    for k in range(2, order):
        met = met.withColumn(f"_p{k}", F.col("_t") * F.col(f"_p{k - 1}") - (k - 1) * F.col(f"_p{k - 2}"))
    terms = [F.col(f"_m{k}") * F.col(f"_p{k}") / math.factorial(k) for k in range(order)]
    sums = met.groupBy("_id").agg(F.sum(F.exp(-F.col("_t") * F.col("_t") / 2) * sum(terms[1:], terms[0])).alias("_sum"))
    scale = 1.0 / (max(total, 1) * h * math.sqrt(2 * math.pi))
    known = F.col("_y").isNotNull() & F.lit(total > 0)
    density = F.when(known, F.greatest(F.coalesce("_sum", F.lit(0.0)), F.lit(0.0)) * scale)
    return numbered.join(sums, "_id", "left").withColumn("density", density).drop("_id", "_y", "_sum")
