"""Hypothesis tests. Every test returns the columns of ``RESULT``.

Statistics and degrees of freedom are aggregates of the data; only the p-value of
the finished result uses a pandas UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statweave.functions.arrays import as_array
from statweave.functions.distributions import chi2_p_value, kolmogorov_p_value, normal_cdf, student_t_p_value
from statweave.plans.prefix_sum import global_prefix_sum
from statweave.plans.staging import stage

RESULT = ["test", "feature", "statistic", "dof", "p_value", "method", "null_hypothesis"]


def _result(df: DataFrame, test: str, method: str, null_hypothesis: str, p_value: Column) -> DataFrame:
    feature = F.col("feature") if "feature" in df.columns else F.lit(None)
    return df.select(
        F.lit(test).alias("test"),
        feature.cast("string").alias("feature"),
        F.col("statistic").cast("double").alias("statistic"),
        F.col("dof").cast("double").alias("dof"),
        p_value.alias("p_value"),
        F.lit(method).alias("method"),
        F.lit(null_hypothesis).alias("null_hypothesis"),
    )


def chi2_goodness_of_fit(counts: DataFrame, category: str, observed: str, expected: DataFrame | None = None) -> DataFrame:
    """Pearson's test of category counts against a uniform or a given distribution.

    ``counts`` has one row per category. ``expected`` has the columns ``category``
    and ``expected`` and is rescaled to the observed total; a category found on one
    side only counts as 0 on the other.
    """
    table = counts.select(F.col(category).alias("category"), F.col(observed).cast("double").alias("o"))
    if expected is None:
        sums = table.agg(
            F.sum("o").alias("n"), F.count(F.lit(1)).alias("k"), F.avg("o").alias("e"), F.var_pop("o").alias("v")
        )
        fit = sums.select((F.col("v") * F.col("k") / F.col("e")).alias("statistic"), (F.col("k") - 1).alias("dof"))
    else:
        wanted = expected.select("category", F.col("expected").cast("double").alias("e"))
        both = table.join(wanted, "category", "full").select(
            F.coalesce("o", F.lit(0.0)).alias("o"), F.coalesce("e", F.lit(0.0)).alias("e")
        )
        scale = both.agg((F.sum("o") / F.sum("e")).alias("s")).scalar()
        e = F.col("e") * scale
        term = F.when(F.col("e") > 0, F.pow(F.col("o") - e, 2) / e).when(F.col("o") > 0, F.lit(float("inf"))).otherwise(0.0)
        fit = both.agg(F.sum(term).alias("statistic"), (F.count(F.lit(1)) - 1).alias("dof"))
    p = chi2_p_value(F.col("statistic").cast("double"), F.col("dof").cast("double"))
    return _result(fit, "chi2_goodness_of_fit", "pearson", "observed follows the same distribution as expected", p)


def category_counts(df: DataFrame, category: str, name: str = "observed") -> DataFrame:
    return df.groupBy(category).agg(F.count(F.lit(1)).alias(name))


def _independence(cells: DataFrame, group: list[str]) -> DataFrame:
    """Statistic and degrees of freedom of tables ``group…, a, b, o``.

    Only cells that occur are needed: an absent cell contributes its expected count,
    and those add up to the total less the expected counts of the present cells.
    """
    cells = stage(cells)
    rows = cells.groupBy(*group, "a").agg(F.sum("o").alias("r"))
    cols = cells.groupBy(*group, "b").agg(F.sum("o").alias("c"))
    if group:
        size = rows.groupBy(*group).agg(F.sum("r").alias("n"), F.count(F.lit(1)).alias("n_rows"))
        # the sizes meet the row totals, not the cells, so no group's cells share a task for them
        filled = cells.join(rows.join(size, group), [*group, "a"]).join(cols, [*group, "b"])
    else:
        totals = rows.agg(F.struct(F.sum("r").alias("n"), F.count(F.lit(1)).alias("n_rows"))).scalar()
        filled = cells.join(rows, "a").join(cols, "b").withColumn("_t", totals)
        filled = filled.withColumn("n", F.col("_t.n")).withColumn("n_rows", F.col("_t.n_rows"))
    e = F.col("r") * F.col("c") / F.col("n")
    present = filled.groupBy(*group).agg(
        F.sum(F.pow(F.col("o") - e, 2) / e).alias("present"), F.sum(e).alias("covered"), F.max("n").alias("n"),
        F.max("n_rows").alias("n_rows"), F.count_distinct("b").alias("n_cols"),
        F.count(F.lit(1)).alias("n_cells"),
    )
    absent = F.when(F.col("n_cells") == F.col("n_rows") * F.col("n_cols"), 0.0).otherwise(F.col("n") - F.col("covered"))
    return present.select(
        *group,
        (F.col("present") + absent).alias("statistic"),
        ((F.col("n_rows") - 1) * (F.col("n_cols") - 1)).alias("dof"),
    )


def chi2_independence(df: DataFrame, a: str, b: str, weight: str | None = None) -> DataFrame:
    """Pearson's test of independence of two categorical columns.

    Rows are combined per pair of categories before anything is shuffled; with
    ``weight`` the rows are cells of a contingency table already.
    """
    amount = F.count(F.lit(1)).cast("double") if weight is None else F.sum(F.col(weight).cast("double"))
    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(amount.alias("o")).where(F.col("o") > 0)
    fit = _independence(cells, [])
    p = chi2_p_value(F.col("statistic"), F.col("dof").cast("double"))
    return _result(fit, "chi2_independence", "pearson", "the occurrence of the outcomes is statistically independent", p)


def chi2_by_feature(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """Independence test of every feature against the label; ``feature`` is the 0-based position."""
    long = df.select(F.col(label).alias("b"), F.posexplode(as_array(df, features)).alias("feature", "a"))
    cells = long.groupBy("feature", "a", "b").agg(F.count(F.lit(1)).cast("double").alias("o"))
    fit = _independence(cells, ["feature"])
    p = chi2_p_value(F.col("statistic"), F.col("dof").cast("double"))
    return _result(fit, "chi2_by_feature", "pearson", "the occurrence of the outcomes is statistically independent", p)


def ks_normal(df: DataFrame, value: str, mean: float = 0.0, sd: float = 1.0) -> DataFrame:
    """Two-sided one-sample Kolmogorov–Smirnov test against N(mean, sd²); ``dof`` is the sample size."""
    steps = global_prefix_sum(df, value, {"n": F.lit(1).cast("bigint")})
    below = (F.col("cum_n") - F.col("n")) / F.col("total_n")
    upto = F.col("cum_n") / F.col("total_n")
    expected = normal_cdf(F.col(value), mean, sd)
    fit = steps.agg(
        F.max(F.greatest(expected - below, upto - expected)).alias("statistic"), F.max("total_n").alias("dof")
    )
    p = kolmogorov_p_value(F.col("statistic"), F.col("dof").cast("double"))
    return _result(fit, "kolmogorov_smirnov", "one-sample two-sided", "sample follows the theoretical distribution", p)


def welch_sums(treatment: Column, value: Column) -> list[Column]:
    """The six aggregates of a two-sample test, usable in batch and streaming aggregations."""
    control = F.when(~treatment, value)
    treated = F.when(treatment, value)
    return [
        F.count(control).alias("n_control"),
        F.avg(control).alias("mean_control"),
        F.var_samp(control).alias("var_control"),
        F.count(treated).alias("n_treatment"),
        F.avg(treated).alias("mean_treatment"),
        F.var_samp(treated).alias("var_treatment"),
    ]


def welch_statistics(sums: DataFrame) -> DataFrame:
    """Add ``statistic`` (control minus treatment) and Welch–Satterthwaite ``dof``; null until both sides have 2 rows."""
    a = F.col("var_control") / F.col("n_control")
    b = F.col("var_treatment") / F.col("n_treatment")
    enough = (F.col("n_control") > 1) & (F.col("n_treatment") > 1) & (a + b > 0)
    dof = F.pow(a + b, 2) / (a * a / (F.col("n_control") - 1) + b * b / (F.col("n_treatment") - 1))
    return sums.withColumn(
        "statistic", F.when(enough, (F.col("mean_control") - F.col("mean_treatment")) / F.sqrt(a + b))
    ).withColumn("dof", F.when(enough, dof))


def with_t_p_value(df: DataFrame) -> DataFrame:
    return df.withColumn("p_value", student_t_p_value(F.col("statistic"), F.col("dof")))


def welch_test(df: DataFrame, treatment: Column, value: str) -> DataFrame:
    """Welch's t-test of the rows where ``treatment`` is false against those where it is true."""
    fit = welch_statistics(df.agg(*welch_sums(treatment, F.col(value))))
    p = student_t_p_value(F.col("statistic"), F.col("dof"))
    return _result(fit, "welch_t", "welch", "both groups have the same mean", p)
