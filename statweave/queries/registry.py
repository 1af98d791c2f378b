"""The registered queries: name, Spark function and, where SQL can say it, the same result in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statweave.plans.staging import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded(df: DataFrame, places: int = 6, **special: int) -> DataFrame:
    """Round every double column (``special`` sets other places by column); −0.0 becomes 0.0."""
    columns = []
    for name, kind in df.dtypes:
        if kind in ("double", "float"):
            columns.append((F.round(F.col(name).cast("double"), special.get(name, places)) + F.lit(0.0)).alias(name))
        else:
            columns.append(F.col(name))
    return df.select(*columns)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, for queries that write and read back."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
