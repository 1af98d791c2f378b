"""Ranking evaluation: precision@k, NDCG@k and mean average precision.

``ranking_summary`` works on rows that hold the ranked list and the relevant set;
``ranking_summary_long`` takes both as tables and never gathers a user's relevant
items, so a user with very many of them costs no more than their rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def _ideal_gain(k: int, relevant: Column) -> Column:
    """Sum of 1/ln(i+2) over the first min(k, relevant) positions, looked up in a literal table."""
    steps = [0.0]
    for i in range(k):
        steps.append(steps[-1] + 1.0 / math.log(i + 2))
    table = F.array(*[F.lit(s) for s in steps])
    return F.element_at(table, (F.least(relevant, F.lit(k)) + 1).cast("int"))


def _named(ks: Sequence[int]) -> list[tuple[int, str, str]]:
    return [(k, f"precision_at_{k}", f"ndcg_at_{k}") for k in ks]


def ranking_summary(df: DataFrame, prediction: str = "prediction", label: str = "label", ks: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """One row: ``precision_at_k`` and ``ndcg_at_k`` for each k, and ``mean_average_precision``.

    A list shorter than k keeps the divisor k; an empty relevant set scores 0.
    """
    truth = F.array_distinct(label)
    hits = F.transform(prediction, lambda x: F.array_contains("_truth", x).cast("int"))
    rows = df.select(F.col(prediction), truth.alias("_truth")).select(hits.alias("_h"), F.size("_truth").alias("_r"))
    metrics = []
    for k, precision, ndcg in _named(ks):
        top = F.slice("_h", 1, k)
        metrics.append(F.avg(_sum(F.transform(top, lambda h: h.cast("double"))) / F.lit(float(k))).alias(precision))
        gain = _sum(F.transform(top, lambda h, i: h / F.log(i + F.lit(2.0))))
        metrics.append(F.avg(F.when(F.col("_r") > 0, gain / _ideal_gain(k, F.col("_r"))).otherwise(0.0)).alias(ndcg))
    start = F.struct(F.lit(0.0).alias("hits"), F.lit(0.0).alias("total"))
    indexed = F.transform("_h", lambda h, i: F.struct(h.cast("double").alias("h"), (i + 1).alias("i")))
    walked = F.aggregate(
        indexed,
        start,
        lambda s, x: F.struct(
            (s["hits"] + x["h"]).alias("hits"), (s["total"] + x["h"] * (s["hits"] + x["h"]) / x["i"]).alias("total")
        ),
        lambda s: s["total"],
    )
    metrics.append(F.avg(F.when(F.col("_r") > 0, walked / F.col("_r")).otherwise(0.0)).alias("mean_average_precision"))
    return rows.agg(*metrics)


def ranking_summary_long(
    predictions: DataFrame,
    truth: DataFrame,
    user: str = "user",
    item: str = "item",
    rank: str = "rank",
    ks: Sequence[int] = (1, 3, 5),
    users: DataFrame | None = None,
) -> DataFrame:
    """The same metrics from ``user, rank, item`` (rank from 1) and ``user, item`` tables.

    The average is over every user of ``users`` (column ``user``), or else of either
    table; one without recommended or without relevant items scores 0. The match is on (user, item), so a heavy
    user's items spread over all tasks; only the ranked list of a user, at most as
    long as the list asked for, meets in one window.
    """
    relevant = truth.select(user, item).distinct()
    sizes = relevant.groupBy(user).agg(F.count(F.lit(1)).alias("_r"))
    marked = predictions.select(user, rank, item).join(relevant.withColumn("_hit", F.lit(1)), [user, item], "left")
    upto = Window.partitionBy(user).orderBy(rank).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = F.coalesce("_hit", F.lit(0))
    walked = marked.select(user, rank, hit.alias("_h"), F.sum(hit).over(upto).alias("_c"))
    position = F.col(rank)
    parts = [F.sum(F.col("_h") * F.col("_c") / position).alias("_ap")]
    for k, precision, ndcg in _named(ks):
        within = F.when(position <= k, F.col("_h")).otherwise(0)
        parts.append((F.sum(within) / F.lit(float(k))).alias(precision))
        parts.append(F.sum(within / F.log(position + 1.0)).alias(ndcg))
    scored = walked.groupBy(user).agg(*parts).join(sizes, user, "full")
    if users is not None:
        scored = users.select(user).distinct().join(scored, user, "left")

    def mean(value: Column, name: str) -> Column:
        return F.avg(F.when(F.col("_r") > 0, F.coalesce(value, F.lit(0.0))).otherwise(0.0)).alias(name)

    return scored.agg(
        *[
            m
            for k, precision, ndcg in _named(ks)
            for m in (mean(F.col(precision), precision), mean(F.col(ndcg) / _ideal_gain(k, F.col("_r")), ndcg))
        ],
        mean(F.col("_ap") / F.col("_r"), "mean_average_precision"),
    )
