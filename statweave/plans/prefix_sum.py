"""Running totals over the global order of a column, without a one-task window.

Rows are first summed per distinct key, so one hot key is a single row after the
map-side combine. The distinct keys are range-partitioned, whatever orderable type
they have; every range is one window partition and the totals of the earlier ranges
are added as an offset. Only the totals, one row per range, go through an
unpartitioned window and a broadcast. The path is the same at every size. A NaN key
is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statweave.plans.staging import stage_table


def bucketed(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """Staged ``df`` with ``_bucket``, the number of its range of ``key``, in the order of the keys.

    There are as many ranges as shuffle partitions unless ``buckets`` says otherwise.
    """
    count = max(1, buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    checked = F.col(key)
    if dict(df.dtypes)[key] in ("double", "float"):
        nan = F.raise_error(F.lit(f"{key} is NaN, which has no place in the order")).cast("double")
        checked = F.when(F.isnan(key), nan).otherwise(F.col(key))
    ranged = df.withColumn(key, checked).repartitionByRange(count, key)
    return stage_table(ranged.withColumn("_bucket", F.spark_partition_id()))


def offset_buckets(tagged: DataFrame, names: list[str], descending: bool = False) -> DataFrame:
    """Totals of ``names`` in earlier buckets (``_off_*``) and overall (``_total_*``)."""
    totals = tagged.groupBy("_bucket").agg(*[F.sum(n).alias(n) for n in names])
    order = F.desc("_bucket") if descending else F.asc("_bucket")
    before = Window.partitionBy(F.lit(0)).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    return totals.select(
        "_bucket",
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_off_{n}") for n in names],
        *[F.sum(n).over(whole).alias(f"_total_{n}") for n in names],
    )


def key_totals(df: DataFrame, key: str, sums: dict[str, Column]) -> DataFrame:
    """One row per distinct non-null ``key`` with the given sums."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def running_totals(
    totals: DataFrame, key: str, names: list[str], descending: bool = False, buckets: int | None = None
) -> DataFrame:
    """``cum_*`` and ``total_*`` of the columns ``names`` over the order of the unique ``key``."""
    order = F.desc(key) if descending else F.asc(key)
    tagged = bucketed(totals, key, buckets)
    offsets = offset_buckets(tagged, names, descending)
    upto = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return tagged.join(F.broadcast(offsets), "_bucket").select(
        key,
        *names,
        *[(F.col(f"_off_{n}") + F.sum(n).over(upto)).alias(f"cum_{n}") for n in names],
        *[F.col(f"_total_{n}").alias(f"total_{n}") for n in names],
    )


def global_prefix_sum(
    df: DataFrame,
    key: str,
    sums: dict[str, Column],
    descending: bool = False,
    buckets: int | None = None,
    rank: bool = False,
) -> DataFrame:
    """One row per distinct non-null ``key`` with its sums, running sums and grand totals.

    Columns: ``key``, and for each name in ``sums`` the columns ``name`` (sum at this
    key), ``cum_name`` (sum up to and including this key) and ``total_name``. With
    ``rank`` the number of distinct keys is summed along as ``keys``.
    """
    totals = key_totals(df, key, sums)
    names = list(sums)
    if rank:
        totals = totals.withColumn("keys", F.lit(1).cast("bigint"))
        names.append("keys")
    return running_totals(totals, key, names, descending, buckets)


def row_index(df: DataFrame, key: str, name: str = "row_index", buckets: int | None = None, unique: bool = True) -> DataFrame:
    """Number the rows 0, 1, 2 … in the order of the column ``key``.

    Equal keys are an error; with ``unique=False`` they get consecutive numbers in no given
    order. Rows of one key meet in one window, so a key with many rows should go on to a
    column that tells them apart (a struct of both).
    """
    tagged = bucketed(df, key, buckets)
    offsets = offset_buckets(tagged.withColumn("_one", F.lit(1).cast("bigint")), ["_one"])
    within = Window.partitionBy("_bucket").orderBy(key)
    joined = tagged.join(F.broadcast(offsets), "_bucket")
    place = F.col("_off__one") + F.row_number().over(within) - 1
    twice = F.raise_error(F.lit(f"{key} is not unique")).cast("bigint")
    number = F.when(F.col(key) == F.lag(key).over(within), twice).otherwise(place) if unique else place
    return joined.withColumn(name, number).select(*df.columns, name)
