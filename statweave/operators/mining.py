"""Frequent itemsets, association rules and sequential patterns."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statweave.operators.sequence_growth import grow_patterns
from statweave.plans.staging import stage_table


def fit_fp_growth(
    baskets: DataFrame, min_support: float = 0.2, min_confidence: float = 0.8, partitions: int | None = None, items: str = "items"
) -> FPGrowthModel:
    """Frequent itemsets of ``items ARRAY`` (``model.freqItemsets``); duplicates in a basket are dropped."""
    unique = stage_table(baskets.select(F.array_distinct(items).alias(items)))  # passed over by the fit and by each use of the model
    estimator = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=min_confidence)
    if partitions is not None:
        estimator = estimator.setNumPartitions(partitions)
    return estimator.fit(unique)


def frequent_itemsets(model: FPGrowthModel) -> DataFrame:
    """``items`` (sorted) and ``freq``."""
    return model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")


def association_rules(model: FPGrowthModel) -> DataFrame:
    """Rules of a fitted model: ``antecedent, consequent, confidence, lift, support``."""
    return model.associationRules.withColumn("antecedent", F.array_sort("antecedent"))


def rules_from_itemsets(itemsets: DataFrame, min_confidence: float = 0.8) -> DataFrame:
    """Rules with a one-item consequent from a table ``items, freq``, by one equi-join.

    Each itemset is opened once per item, and its remaining items, sorted, are looked
    up as an itemset of their own.
    """
    sets = stage_table(itemsets.select(F.array_sort("items").alias("items"), "freq"))  # a lazy model mines at every use
    opened = sets.where(F.size("items") > 1).select("items", "freq", F.explode("items").alias("item"))
    candidates = opened.select(
        F.filter("items", lambda x: x != F.col("item")).alias("antecedent"), F.array("item").alias("consequent"), "freq"
    )
    bases = sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("base"))
    return (
        candidates.join(bases, "antecedent")
        .withColumn("confidence", F.col("freq") / F.col("base"))
        .where(F.col("confidence") >= min_confidence)
        .select("antecedent", "consequent", "confidence")
    )


def sequential_patterns(
    sequences: DataFrame, min_support: float = 0.5, max_length: int = 5, column: str = "sequence"
) -> DataFrame:
    """Frequent subsequences ``sequence ARRAY<ARRAY>, freq`` of rows of itemset arrays, null rows left out.

    The library's miner projects every sequence once per pattern and round; blocks of
    sequences (``operators/sequence_growth.py``) give the same patterns and counts.
    """
    return grow_patterns(sequences.select(column).where(F.col(column).isNotNull()), min_support, max_length, column)
