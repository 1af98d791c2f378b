"""Column summaries, correlations and kernel density."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.stat import Correlation, Summarizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statweave.functions.arrays import with_vector
from statweave.plans.prefix_sum import key_totals, running_totals
from statweave.plans.staging import broadcast_if_small, stage_table


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n, mean, variance, num_nonzeros`` of each column, in one pass."""
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.var_samp(c).alias("variance"),
            F.count_if(F.col(c) != 0).alias("num_nonzeros"),
        )
        for c in columns
    ]
    return df.agg(F.array(*entries).alias("s")).select(F.inline("s"))


def vector_summary(df: DataFrame, features: str = "features") -> DataFrame:
    """``feature, mean, variance, num_nonzeros`` per position of a vector column."""
    metrics = Summarizer.metrics("mean", "variance", "numNonZeros").summary(F.col("_v"))
    one = with_vector(df, features, "_v").agg(metrics.alias("m"))
    zipped = F.arrays_zip(
        vector_to_array("m.mean").alias("mean"),
        vector_to_array("m.variance").alias("variance"),
        vector_to_array("m.numNonZeros").alias("num_nonzeros"),
    )
    return one.select(F.posexplode(zipped).alias("feature", "z")).select(
        "feature", "z.mean", "z.variance", F.col("z.num_nonzeros").cast("bigint").alias("num_nonzeros")
    )


def _correlation(x: str, y: str) -> Column:
    """Pearson's r over the rows where both are given; null if one of them is constant."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    spread = F.stddev_pop(F.when(both, F.col(x))) * F.stddev_pop(F.when(both, F.col(y)))
    return F.try_divide(F.covar_pop(x, y), spread)


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(_correlation(x, y).alias("r"))


def _pair_rows(values: dict[tuple[str, str], Column], columns: Sequence[str]) -> Column:
    """Array of ``(i, j, r)`` for the full symmetric matrix."""

    def entry(i: str, j: str) -> Column:
        r = F.lit(1.0) if i == j else values.get((i, j), values.get((j, i)))
        return F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), r.alias("r"))

    return F.array(*[entry(i, j) for i in columns for j in columns])


def correlation_matrix(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """``i, j, r`` for every pair of columns, Pearson or Spearman.

    Both leave out the rows where any of the columns is null; r with a constant column is null.
    """
    df = df.dropna(subset=list(columns))
    if method == "spearman":
        sums = {(i, j): _rank_correlation(i, j) for i, j in combinations(columns, 2)}
        return average_ranks(df, columns).agg(_pair_rows(sums, columns).alias("m")).select(F.inline("m"))
    pairs = {(i, j): _correlation(i, j) for i, j in combinations(columns, 2)}
    return df.agg(_pair_rows(pairs, columns).alias("m")).select(F.inline("m"))


def vector_correlation(df: DataFrame, features: str = "features", method: str = "pearson") -> DataFrame:
    """``i, j, r`` by position of a wide vector column."""
    matrix = Correlation.corr(with_vector(df.select(features), features), features, method)
    cells = matrix.collect()[0][0].toArray()
    rows = [(i, j, float(v)) for i, line in enumerate(cells) for j, v in enumerate(line)]
    return df.sparkSession.createDataFrame(rows, "i int, j int, r double")


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of ``columns`` without nulls, with centred ranks ``_rank_<column>``.

    Ties share their average rank, and the mean rank is subtracted so that later
    sums of squares keep their precision. Each column is ranked over its distinct
    values; a rank table counted to be small is broadcast, so that a column of few values
    moves no row. Else the join shuffles and adaptive execution splits a hot value's partition.
    """
    rows = df.select(*columns).dropna()
    ranked = rows
    for c in columns:
        running = running_totals(key_totals(rows, c, {"n": F.lit(1).cast("bigint")}), c, ["n"])
        middle = F.col("cum_n") - (F.col("n") - 1) / 2.0 - (F.col("total_n") + 1) / 2.0
        ranked = ranked.join(broadcast_if_small(stage_table(running.select(c, middle.alias(f"_rank_{c}")))), c)
    return ranked


def rank_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Like ``average_ranks`` without the values, by one ranking of all columns together.

    The rows become long, (column, value) is counted and ranked over one range partitioning,
    and the ranks meet the long rows in one join, whose rows are put together again by their
    number: as many shuffles for any number of columns. Every column has the same number of
    rows, so its ranks begin after the rows of the columns before it.
    """
    rows = stage_table(df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna().withColumn("_row", F.monotonically_increasing_id()))
    cells = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).alias("v")) for i, c in enumerate(columns)])
    long = rows.select("_row", F.explode(cells).alias("_cell"))
    running = running_totals(key_totals(long, "_cell", {"n": F.lit(1).cast("bigint")}), "_cell", ["n"])
    each = F.col("total_n") / len(columns)
    middle = F.col("cum_n") - (F.col("n") - 1) / 2.0 - (each + 1) / 2.0 - F.col("_cell.c") * each
    ranked = long.join(running.select("_cell", middle.alias("_rank")), "_cell")
    return ranked.groupBy("_row").agg(
        *[F.max(F.when(F.col("_cell.c") == i, F.col("_rank"))).alias(f"_rank_{c}") for i, c in enumerate(columns)]
    )


def _rank_correlation(x: str, y: str) -> Column:
    a, b = F.col(f"_rank_{x}"), F.col(f"_rank_{y}")
    return F.try_divide(F.sum(a * b), F.sqrt(F.sum(a * a) * F.sum(b * b)))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation with average ranks for ties."""
    return average_ranks(df, [x, y]).agg(_rank_correlation(x, y).alias("r"))


def kernel_density(df: DataFrame, value: str, points: Sequence[float], bandwidth: float = 1.0) -> DataFrame:
    """Gaussian kernel density ``point, density`` at the given points.

    The points are an argument, so they become expressions of one aggregation: one
    pass over the sample, combined before the shuffle, and no row is repeated.
    """
    h = float(bandwidth)
    scale = 1.0 / (h * math.sqrt(2.0 * math.pi))
    entries = [
        F.struct(
            F.lit(float(p)).alias("point"),
            (F.avg(F.exp(-F.pow(F.col(value) - F.lit(float(p)), 2) / F.lit(2.0 * h * h))) * F.lit(scale)).alias("density"),
        )
        for p in points
    ]
    return df.agg(F.array(*entries).alias("d")).select(F.inline("d"))
