"""Text sources, record shaping and text sinks.

Shaping functions take the ``value`` column of ``read_lines`` (or of a streaming
text source) and use only column expressions. Lines that do not parse give nulls;
``split_bad_rows`` separates them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value STRING`` per line."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New text files in a folder as a stream of lines."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """``label DOUBLE, features VECTOR``; giving the width saves the discovery pass."""
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", str(num_features))
    return reader.load(path)


def _numbers(text: Column, separator: str = r"\s+") -> Column:
    return F.transform(F.split(F.trim(text), separator), lambda t: t.try_cast("double"))


def _part(parts: Column) -> Callable[[int], Column]:
    """The trimmed i-th part of a line; null on a line that is too short."""
    return lambda i: F.trim(F.get(parts, F.lit(i)))


def shape_ratings(lines: DataFrame, separator: str = ",", shift: float = 0.0) -> DataFrame:
    """``user,item,rating`` lines (or ``::`` separated); ``shift`` is added to the rating."""
    part = _part(F.split("value", re.escape(separator)))
    return lines.select(
        part(0).try_cast("int").alias("user"),
        part(1).try_cast("int").alias("item"),
        (part(2).try_cast("double") + F.lit(float(shift))).alias("rating"),
    )


def shape_vectors(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Space-separated numbers to ``features ARRAY<DOUBLE>``, beside the columns in ``keep``."""
    return lines.select(*keep, _numbers(F.col("value")).alias("features"))


def shape_labeled_vectors(lines: DataFrame) -> DataFrame:
    """``label,f1 f2 …`` lines; every feature is kept."""
    part = _part(F.split("value", ",", 2))
    return lines.select(part(0).try_cast("double").alias("label"), _numbers(part(1)).alias("features"))


def shape_labeled_pairs(lines: DataFrame, num_features: int) -> DataFrame:
    """``label i:v i:v …`` lines (1-based index) to a dense array of ``num_features`` values.

    The first value of a repeated index counts.
    """
    parts = F.split(F.trim("value"), r"\s+", 2)
    pairs = F.split(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s+")
    named = lines.select(
        F.get(parts, F.lit(0)).try_cast("double").alias("label"),
        F.transform(pairs, lambda p: F.substring_index(p, ":", 1)).alias("_index"),
        F.transform(pairs, lambda p: F.substring_index(p, ":", -1)).alias("_value"),
    )
    positions = F.transform(F.sequence(F.lit(1), F.lit(int(num_features))), lambda i: i.cast("string"))
    value = lambda i: F.get("_value", (F.array_position("_index", i) - 1).cast("int")).try_cast("double")
    return named.select("label", F.transform(positions, lambda i: F.coalesce(value(i), F.lit(0.0))).alias("features"))


def shape_baskets(lines: DataFrame) -> DataFrame:
    """Space-separated items, each once per basket."""
    return lines.select(F.array_distinct(F.split(F.trim("value"), r"\s+")).alias("items"))


def shape_ab_samples(lines: DataFrame) -> DataFrame:
    """``true,1.5`` lines to ``is_treatment BOOLEAN, value DOUBLE``; any other flag text is false."""
    part = _part(F.split("value", ","))
    return lines.select(
        F.coalesce(F.lower(part(0)) == "true", F.lit(False)).alias("is_treatment"),
        part(1).try_cast("double").alias("value"),
    )


def split_bad_rows(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows where every required column parsed, the other rows).

    An array column counts as parsed when none of its elements is null.
    """
    types = dict(df.dtypes)
    good = F.lit(True)
    for name in required:
        good = good & F.col(name).isNotNull()
        if types[name].startswith("array"):
            good = good & ~F.coalesce(F.exists(name, lambda v: v.isNull()), F.lit(False))
    return df.where(good), df.where(~good)


def write_features_text(df: DataFrame, path: str, id_col: str = "id", features_col: str = "features", mode: str = "error") -> None:
    """``id,[f1, f2, …]`` per line."""
    listed = F.concat_ws(", ", F.col(features_col).cast("array<string>"))
    df.select(F.concat(F.col(id_col).cast("string"), F.lit(",["), listed, F.lit("]")).alias("value")).write.mode(mode).text(path)


def read_features_text(spark: SparkSession, path: str) -> DataFrame:
    """Read back what ``write_features_text`` wrote."""
    inside = F.regexp_extract("value", r"\[(.*)\]", 1)
    return read_lines(spark, path).select(
        F.substring_index("value", ",", 1).cast("bigint").alias("id"), _numbers(inside, r",\s*").alias("features")
    )


def write_features(df: DataFrame, path: str, id_col: str = "id", features_col: str = "features", mode: str = "error") -> None:
    """Columnar form of the same table, the default for large factor tables."""
    df.select(F.col(id_col).alias("id"), F.col(features_col).alias("features")).write.mode(mode).parquet(path)
