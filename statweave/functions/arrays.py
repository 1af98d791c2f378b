"""Row-level vector expressions on ``ARRAY<DOUBLE>`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def literal_array(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def as_doubles(values: Column) -> Column:
    return values.cast("array<double>")


def as_vector(values: Column) -> Column:
    """ML vector from a numeric array."""
    return array_to_vector(as_doubles(values))


def as_array(df: DataFrame, name: str) -> Column:
    """``ARRAY<DOUBLE>`` view of a column that is either an array or an ML vector."""
    if isinstance(df.schema[name].dataType, ArrayType):
        return as_doubles(F.col(name))
    return vector_to_array(F.col(name))


def with_vector(df: DataFrame, name: str, output: str | None = None) -> DataFrame:
    """``df`` with ``name`` as an ML vector (under ``output`` when given)."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, ArrayType):
        column = as_vector(column)
    return df.withColumn(output or name, column)


def discretise(values: Column, width: float) -> Column:
    """Index of the fixed-width bin each element falls in: ``floor(v / width)``."""
    return F.transform(values, lambda v: F.floor(v / F.lit(float(width))).cast("double"))


def append_bias(values: Column) -> Column:
    """Add the constant feature 1.0 at the end."""
    return F.array_append(values, F.lit(1.0))


def elementwise_product(values: Column, weights: Sequence[float]) -> Column:
    """Hadamard product with a fixed weight vector."""
    return F.zip_with(values, literal_array(weights), lambda v, w: v * w)


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def squared_distance(left: Column, right: Column) -> Column:
    terms = F.zip_with(left, right, lambda a, b: (a - b) * (a - b))
    return F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)


def select_positions(values: Column, positions: Sequence[int]) -> Column:
    """Elements at the given 0-based positions, in that order."""
    return F.array(*[F.element_at(values, int(p) + 1) for p in positions])


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(value, F.lit(float(high))), F.lit(float(low)))


def binarise(value: Column, threshold: float = 0.0) -> Column:
    return F.when(value > threshold, F.lit(1.0)).otherwise(F.lit(0.0))
