"""Regression evaluation in one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """``n, sse, mse, rmse, mae, r2, explained_variance``.

    The total and explained sums are written with population variances, which Spark
    aggregates stably, so the mean label needs no second pass. R² of a constant label is null.
    """
    rows = df.select(F.col(prediction).cast("double").alias("p"), F.col(label).cast("double").alias("y"))
    e = F.col("p") - F.col("y")
    sums = rows.where(e.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(e * e).alias("sse"),
        F.avg(F.abs(e)).alias("mae"),
        F.var_pop("y").alias("_vy"),
        F.var_pop("p").alias("_vp"),
        F.avg(e).alias("_bias"),
    )
    mse = F.try_divide(F.col("sse"), F.col("n"))
    return sums.select(
        "n",
        "sse",
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        "mae",
        (1.0 - F.try_divide(mse, F.col("_vy"))).alias("r2"),
        (F.col("_vp") + F.col("_bias") * F.col("_bias")).alias("explained_variance"),
    )
