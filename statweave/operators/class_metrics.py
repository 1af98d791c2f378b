"""Multiclass and multilabel evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statweave.plans.staging import stage_table

def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def confusion_counts(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """``label, prediction, n`` of the pairs that occur."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """``counts`` completed with the zero cells, of any number of classes.

    The result has (classes)² rows by definition; the class list, one side of it, is
    combined per task and opened again, and the counts meet it in a join.
    """
    classes = F.array_sort(F.array_union(F.collect_set("label"), F.collect_set("prediction")))
    rows = counts.agg(classes.alias("classes")).select(F.explode("classes").alias("label"), "classes")
    full = rows.select("label", F.explode("classes").alias("prediction"))
    return full.join(counts, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def class_table(counts: DataFrame) -> DataFrame:
    """``label, actual, predicted, tp`` of every class seen on either side."""
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("c"), F.col("n").alias("a"), zero.alias("q"), hit.alias("h")),
        F.struct(F.col("prediction").alias("c"), zero.alias("a"), F.col("n").alias("q"), zero.alias("h")),
    )
    return (
        counts.select(F.inline(sides))
        .groupBy(F.col("c").alias("label"))
        .agg(F.sum("a").alias("actual"), F.sum("q").alias("predicted"), F.sum("h").alias("tp"))
    )


def _scores(beta: float) -> tuple[Column, Column, Column]:
    p, r = _ratio(F.col("tp"), F.col("predicted")), _ratio(F.col("tp"), F.col("actual"))
    b2 = beta * beta
    return p, r, _ratio((1 + b2) * p * r, b2 * p + r)


def per_class(counts: DataFrame, beta: float = 1.0) -> DataFrame:
    """``label, precision, recall, f_measure``."""
    p, r, f = _scores(beta)
    return class_table(counts).select("label", p.alias("precision"), r.alias("recall"), f.alias("f_measure"))


def accuracy(counts: DataFrame) -> DataFrame:
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    return counts.agg((F.sum(hit) / F.sum("n")).alias("accuracy"))


def weighted(counts: DataFrame, beta: float = 1.0) -> DataFrame:
    """Means over classes weighted by how often each label occurs.

    The class table, one row per class, is staged; the rows behind ``counts`` are read once.
    """
    classes = stage_table(class_table(counts))
    total = classes.agg(F.sum("actual").alias("n")).scalar()
    p, r, f = _scores(beta)
    rows = classes.withColumn("_n", total)
    share = F.col("actual") / F.col("_n")
    fall_out = _ratio(F.col("predicted") - F.col("tp"), F.col("_n") - F.col("actual"))
    return rows.agg(
        F.sum(share * p).alias("weighted_precision"),
        F.sum(share * r).alias("weighted_recall"),
        F.sum(share * f).alias("weighted_f_measure"),
        F.sum(share * fall_out).alias("weighted_false_positive_rate"),
    )


def _label_sets(df: DataFrame, prediction: str, label: str) -> DataFrame:
    p, t = F.array_distinct(prediction), F.array_distinct(label)
    return df.select(
        p.alias("_p"),
        t.alias("_t"),
        F.size(p).cast("bigint").alias("np"),
        F.size(t).cast("bigint").alias("nt"),
        F.size(F.array_intersect(p, t)).cast("bigint").alias("both"),
    )


def multilabel_summary(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Document averages, micro averages, Hamming loss and subset accuracy of two label-set columns.

    One aggregation: labels are opened to count the different ones, and a document's
    own figures count on its first label only.
    """
    both, n_p, n_t = F.col("both"), F.col("np"), F.col("nt")
    opened = _label_sets(df, prediction, label).select("both", "np", "nt", F.posexplode_outer("_t").alias("_at", "_label"))
    once = lambda value: F.when(F.coalesce("_at", F.lit(0)) == 0, value)
    sums = opened.agg(
        F.count(once(F.lit(1))).alias("docs"),
        F.avg(once(_ratio(both, n_p))).alias("precision"),
        F.avg(once(_ratio(both, n_t))).alias("recall"),
        F.avg(once(_ratio(2 * both, n_p + n_t))).alias("f1"),
        F.avg(once(_ratio(both, n_p + n_t - both))).alias("accuracy"),
        F.sum(once(both)).alias("tp"),
        F.sum(once(n_p)).alias("predicted"),
        F.sum(once(n_t)).alias("actual"),
        F.avg(once(F.when((both == n_p) & (both == n_t), 1.0).otherwise(0.0))).alias("subset_accuracy"),
        F.count_distinct("_label").alias("_k"),
    )
    wrong = F.col("predicted") + F.col("actual") - 2 * F.col("tp")
    return sums.select(
        "precision",
        "recall",
        "f1",
        "accuracy",
        _ratio(F.col("tp"), F.col("predicted")).alias("micro_precision"),
        _ratio(F.col("tp"), F.col("actual")).alias("micro_recall"),
        _ratio(2 * F.col("tp"), F.col("predicted") + F.col("actual")).alias("micro_f1"),
        _ratio(wrong, F.col("docs") * F.col("_k")).alias("hamming_loss"),
        "subset_accuracy",
    )


def multilabel_per_class(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """``label, precision, recall, f1`` of every label, counted from one explode of the union of both sets."""
    sets = _label_sets(df, prediction, label)
    opened = sets.select("_p", "_t", F.explode(F.array_union("_p", "_t")).alias("label"))
    counts = opened.select(
        "label", F.array_contains("_p", F.col("label")).alias("in_p"), F.array_contains("_t", F.col("label")).alias("in_t")
    )
    totals = counts.groupBy("label").agg(
        F.count_if("in_p").alias("predicted"),
        F.count_if("in_t").alias("actual"),
        F.count_if(F.col("in_p") & F.col("in_t")).alias("tp"),
    )
    return totals.select(
        "label",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("actual")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("predicted") + F.col("actual")).alias("f1"),
    )
