"""Saving and loading fitted models, and their parameters as tables."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession


def save_model(model: Model, path: str, overwrite: bool = True) -> str:
    """Write ``model`` to ``path`` (a folder every executor can reach) and return the path."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)
    return path


def load_model(model_class: type[Model], path: str) -> Model:
    """Load what ``save_model`` wrote, from the same path."""
    return model_class.load(path)


def centers_table(spark: SparkSession, centers: list) -> DataFrame:
    """``cluster INT, center ARRAY<DOUBLE>`` of a k-means or bisecting k-means model."""
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(centers)]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def coefficients_table(spark: SparkSession, model: Model) -> DataFrame:
    """``class_index INT, feature INT, value DOUBLE`` of a linear model; feature -1 is the intercept."""
    if hasattr(model, "coefficientMatrix"):
        matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    else:
        matrix, intercepts = [model.coefficients.toArray()], [model.intercept]
    rows = [(c, j, float(v)) for c, line in enumerate(matrix) for j, v in enumerate(line)]
    rows += [(c, -1, float(v)) for c, v in enumerate(intercepts)]
    return spark.createDataFrame(rows, "class_index int, feature int, value double")
