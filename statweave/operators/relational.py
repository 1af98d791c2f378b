"""Grouping, joining, set difference and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statweave.plans.staging import broadcast_if_small

LIST_ROWS = 1_000_000
SALTS = 64


def _salt(df: DataFrame, salts: int | Column) -> Column:
    """A salt that is a function of the row, so that a retried task assigns it again."""
    count = salts if isinstance(salts, Column) else F.lit(salts)
    return F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), count)


def swap(df: DataFrame, first: str, second: str) -> DataFrame:
    """Exchange the places of two columns."""
    order = {first: second, second: first}
    return df.select(*[order.get(c, c) for c in df.columns])


def group_collect(
    df: DataFrame, key: str, value: str, where: Column | None = None, name: str = "items", max_rows: int = LIST_ROWS
) -> DataFrame:
    """The values of each key as an array, keeping keys whose array is empty.

    Columns ``key, part, name``. A key with at most ``max_rows`` rows gives one row
    with part 0. A heavier key is spread over several parts of about ``max_rows``
    values, so that no task has to hold the whole of it; nothing is left out.
    """
    kept = F.col(value) if where is None else F.when(where, F.col(value))
    rows = df.select(F.col(key), kept.alias("_value"), _salt(df, 2**31 - 1).alias("_hash"))
    heavy = (
        rows.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > max_rows)
        .select(F.col(key).alias("_heavy"), F.ceil(F.col("_n") / F.lit(max_rows)).alias("_parts"))
    )
    spread = rows.join(broadcast_if_small(heavy), rows[key].eqNullSafe(F.col("_heavy")), "left")
    part = F.coalesce(F.pmod("_hash", "_parts"), F.lit(0)).cast("int")
    return (
        spread.select(key, part.alias("part"), "_value")
        .groupBy(key, "part")
        .agg(F.collect_list("_value").alias(name))
    )


def join_on(left: DataFrame, right: DataFrame, keys: str | list[str]) -> DataFrame:
    """Inner equi-join; Spark broadcasts or splits skewed partitions from run-time sizes."""
    return left.join(right, keys, "inner")


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` equal to no row of ``right``; duplicates in ``left`` stay, nulls match nulls."""
    marked = right.select(*[F.col(c).alias(f"_r_{c}") for c in left.columns])
    same = F.lit(True)
    for c in left.columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(marked.distinct(), same, "left_anti")


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group, numbered from 1.

    Up to Spark's group-limit threshold the rank filter runs before the shuffle as
    well, so a hot group sends k rows per task. For a larger ``k`` a salted first
    round does the same.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    source = df
    if k > limit:
        first = Window.partitionBy(*group, "_salt").orderBy(*order)
        source = (
            df.withColumn("_salt", _salt(df, SALTS))
            .withColumn("_first", F.row_number().over(first))
            .where(F.col("_first") <= k)
            .drop("_salt", "_first")
        )
    ranked = source.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col(rank) <= k)


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def first_row(df: DataFrame) -> DataFrame:
    return df.limit(1)
