"""Sampling and splitting.

``bernoulli_sample``, ``random_split`` and ``stratified_sample`` use Spark's
seeded generators, whose draw depends on how the input is partitioned. The
``hash_*`` forms and ``stratified_exact`` depend on row keys alone and give the
same rows on every run and cluster size.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

HASH_DIGITS = 8
STRATUM_DIGITS = 4


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 11) -> DataFrame:
    """Keep each row with probability ``fraction``, without replacement."""
    return df.sample(False, fraction, seed)


def random_split(df: DataFrame, weights: list[float], seed: int | None = None) -> list[DataFrame]:
    return df.randomSplit(weights, seed)


def key_digest(keys: list[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def hash_fraction(keys: list[str], seed: int = 11) -> Column:
    """A number in [0, 1) that depends only on the key columns and the seed."""
    digits = F.substring(key_digest(keys, seed), 1, HASH_DIGITS)
    return F.coalesce(F.conv(digits, 16, 10).cast("bigint"), F.lit(0)) / F.lit(float(16**HASH_DIGITS))


def hash_split(df: DataFrame, weights: list[float], keys: list[str], seed: int = 11) -> list[DataFrame]:
    """Split by ``hash_fraction``; the parts are disjoint and together give ``df``."""
    total = sum(weights)
    edges, upto = [0.0], 0.0
    for w in weights:
        upto += w
        edges.append(upto / total)
    position = hash_fraction(keys, seed)
    return [
        df.where((position >= low) & ((position < high) if i < len(weights) - 1 else F.lit(True)))
        for i, (low, high) in enumerate(zip(edges, edges[1:]))
    ]


def stratified_sample(df: DataFrame, key: str, fractions: dict, seed: int = 11) -> DataFrame:
    """Keep each row with the probability given for its stratum; strata not named are left out."""
    return df.sampleBy(key, fractions, seed)


def stratified_exact(df: DataFrame, key: str, fractions: dict, ids: list[str], seed: int = 11) -> DataFrame:
    """Exactly ⌈f·n⌉ rows of each stratum: those with the smallest digest of their ids.

    Strata are spread over buckets of the digest's leading digits. Counting finds,
    for each stratum, the one bucket in which the quota is reached; buckets before it
    are taken whole and only the rows of that bucket are ranked. No window ever
    covers a whole stratum.
    """
    spark = df.sparkSession
    quotas = spark.createDataFrame(
        [(k, Decimal(str(f))) for k, f in fractions.items()],
        StructType([StructField("_stratum", df.schema[key].dataType), StructField("_fraction", DecimalType(19, 18))]),
    )
    digest = key_digest(ids, seed)
    keyed = df.withColumn("_digest", digest)
    slot = F.conv(F.substring("_digest", 1, STRATUM_DIGITS), 16, 10).cast("int")
    keyed = keyed.withColumn("_slot", F.coalesce(slot, F.lit(0)))
    per_slot = keyed.groupBy(F.col(key).alias("_stratum"), "_slot").agg(F.count(F.lit(1)).alias("_n"))
    in_order = Window.partitionBy("_stratum").orderBy("_slot")
    whole = Window.partitionBy("_stratum")
    running = per_slot.select(
        "_stratum",
        "_slot",
        (F.sum("_n").over(in_order) - F.col("_n")).alias("_before"),
        F.sum("_n").over(in_order).alias("_upto"),
        F.sum("_n").over(whole).alias("_size"),
    ).join(F.broadcast(quotas), "_stratum")
    quota = F.ceil(F.col("_fraction") * F.col("_size").cast("decimal(18,0)")).cast("bigint")
    cuts = (
        running.withColumn("_quota", quota)
        .where((F.col("_before") < F.col("_quota")) & (F.col("_quota") <= F.col("_upto")))
        .select("_stratum", F.col("_slot").alias("_cut"), (F.col("_quota") - F.col("_before")).alias("_left"))
    )
    # one row per entry of `fractions`, so the broadcast is bounded by that argument
    matched = keyed.join(F.broadcast(cuts), F.col(key) == F.col("_stratum"))
    whole_slots = matched.where(F.col("_slot") < F.col("_cut"))
    at_cut = Window.partitionBy(key).orderBy("_digest", *ids)
    partial = (
        matched.where(F.col("_slot") == F.col("_cut"))
        .withColumn("_rank", F.row_number().over(at_cut))
        .where(F.col("_rank") <= F.col("_left"))
    )
    return whole_slots.select(*df.columns).unionByName(partial.select(*df.columns))
