"""Threshold curves and areas of a scored binary classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statweave.plans.prefix_sum import global_prefix_sum


class BinaryCurves:
    """Curves over the distinct scores of ``df``, highest score first.

    The score histogram is computed once and staged; its running totals are bucketed
    windows, and every method is a narrow projection or one aggregate of them. Labels
    above 0.5 are positive. An area that needs a class without rows is null. ``bins`` joins runs of consecutive scores so that about
    that many points remain; 0 keeps every score. With ``prediction`` the errors of the
    hard predictions are counted in the same pass, for ``summary``.
    """

    def __init__(self, df: DataFrame, score: str = "score", label: str = "label", bins: int = 0, prediction: str | None = None):
        positive = F.col(label) > 0.5
        counts = {
            "pos": F.when(positive, 1).otherwise(0).cast("bigint"),
            "neg": F.when(positive, 0).otherwise(1).cast("bigint"),
        }
        columns = [F.col(score).cast("double").alias("threshold"), F.col(label)]
        if prediction is not None:
            counts["wrong"] = F.when(F.col(prediction) != F.col(label), 1).otherwise(0).cast("bigint")
            columns.append(F.col(prediction))
        scored = df.select(*columns)
        table = global_prefix_sum(scored, "threshold", counts, descending=True, rank=bins > 0)
        if bins > 0:
            run = F.greatest(F.floor(F.col("total_keys") / F.lit(bins)), F.lit(1))
            table = table.groupBy(F.floor((F.col("cum_keys") - 1) / run).alias("_run")).agg(
                F.min("threshold").alias("threshold"),
                *[F.sum(c).alias(c) for c in counts],
                *[F.max(c).alias(c) for c in ("cum_pos", "cum_neg", "total_pos", "total_neg")],
            )
        self.table = table.select(
            "threshold",
            F.col("cum_pos").alias("tp"),
            F.col("cum_neg").alias("fp"),
            "pos",
            "neg",
            F.col("total_pos").alias("p"),
            F.col("total_neg").alias("n"),
            *(["wrong"] if prediction is not None else []),
        )

    @staticmethod
    def _precision() -> Column:
        return F.col("tp") / (F.col("tp") + F.col("fp"))

    @staticmethod
    def _recall() -> Column:
        return F.when(F.col("p") > 0, F.col("tp") / F.col("p")).otherwise(0.0)

    @staticmethod
    def _fall_out() -> Column:
        return F.when(F.col("n") > 0, F.col("fp") / F.col("n")).otherwise(0.0)

    def thresholds(self) -> DataFrame:
        return self.table.select("threshold")

    def precision(self) -> DataFrame:
        return self.table.select("threshold", self._precision().alias("precision"))

    def recall(self) -> DataFrame:
        return self.table.select("threshold", self._recall().alias("recall"))

    def f_measure(self, beta: float = 1.0) -> DataFrame:
        b2 = F.lit(float(beta * beta))
        p, r = self._precision(), self._recall()
        value = F.when(p + r > 0, (1 + b2) * p * r / (b2 * p + r)).otherwise(0.0)
        return self.table.select("threshold", value.alias("f_measure"))

    def _is_first(self) -> Column:
        return F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")

    def _is_last(self) -> Column:
        return F.col("tp") + F.col("fp") == F.col("p") + F.col("n")

    def pr(self) -> DataFrame:
        """``threshold, recall, precision``; the first precision is repeated at recall 0 (no threshold)."""
        here = F.struct("threshold", self._recall().alias("recall"), self._precision().alias("precision"))
        start = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"), self._precision().alias("precision"))
        return self.table.select(F.inline(F.when(self._is_first(), F.array(start, here)).otherwise(F.array(here))))

    def roc(self) -> DataFrame:
        """``threshold, fpr, tpr`` with the end points (0, 0) and (1, 1), which have no threshold."""

        def point(x: float) -> Column:
            return F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(x).alias("fpr"), F.lit(x).alias("tpr"))

        here = F.array(F.struct("threshold", self._fall_out().alias("fpr"), self._recall().alias("tpr")))
        none = F.slice(here, 1, 0)
        start = F.when(self._is_first(), F.array(point(0.0))).otherwise(none)
        end = F.when(self._is_last(), F.array(point(1.0))).otherwise(none)
        return self.table.select(F.inline(F.concat(start, here, end)))

    def _pr_area(self) -> Column:
        """Trapezoids over ``pr``; the previous point of a row is its own totals less its own counts."""
        tp, fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
        before = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(self._precision())
        return F.sum(F.try_divide(F.col("pos"), F.col("p")) * (self._precision() + before) / 2.0)

    @staticmethod
    def _roc_area() -> Column:
        area = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2.0))
        return F.try_divide(F.try_divide(area, F.max("p")), F.max("n"))

    def area_under_pr(self) -> DataFrame:
        return self.table.agg(self._pr_area().alias("area_under_pr"))

    def area_under_roc(self) -> DataFrame:
        return self.table.agg(self._roc_area().alias("area_under_roc"))

    def summary(self) -> DataFrame:
        """Error rate of the hard predictions and both areas of the score, in one aggregation."""
        n = F.sum(F.col("pos") + F.col("neg"))
        return self.table.agg(
            n.alias("n"),
            F.sum("wrong").alias("errors"),
            (F.sum("wrong") / n).alias("error_rate"),
            (1.0 - F.sum("wrong") / n).alias("accuracy"),
            self._roc_area().alias("area_under_roc"),
            self._pr_area().alias("area_under_pr"),
        )


def error_rate(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """``n, missing, errors, error_rate, accuracy`` of hard predictions.

    Rows without a prediction or label are ``missing`` and in no other figure.
    """
    wrong = (F.col(prediction) != F.col(label)).cast("double")
    return df.agg(
        F.count(wrong).alias("n"),
        F.count_if(wrong.isNull()).alias("missing"),
        F.sum(wrong).cast("bigint").alias("errors"),
        F.avg(wrong).alias("error_rate"),
        (1.0 - F.avg(wrong)).alias("accuracy"),
    )
