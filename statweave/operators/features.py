"""Feature transforms and linear algebra over rows of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, ElementwiseProduct, PCAModel
from pyspark.ml.linalg import Vectors
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from statweave.functions.arrays import as_array, dot, literal_array, select_positions, with_vector
from statweave.operators.hypothesis import chi2_by_feature
from statweave.plans.staging import broadcast_if_small, persisted

EXPRESSION_CELLS = 256


def scale_vectors(df: DataFrame, weights: list[float], features: str = "features", output: str = "scaled") -> DataFrame:
    """Hadamard product of an ML vector column with fixed weights (arrays: ``functions.arrays``)."""
    return ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol=features, outputCol=output).transform(df)


def chi2_ranking(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """``feature INT, statistic`` of every feature against the label."""
    return chi2_by_feature(df, features, label).select(F.col("feature").cast("int").alias("feature"), "statistic")


def chi2_top_features(df: DataFrame, k: int, features: str = "features", label: str = "label") -> list[int]:
    """Positions of the ``k`` features with the largest statistic, in feature order."""
    best = chi2_ranking(df, features, label).orderBy(F.desc("statistic"), "feature").limit(k)
    return sorted(row.feature for row in best.collect())


def keep_features(df: DataFrame, positions: list[int], features: str = "features", output: str = "selected") -> DataFrame:
    return df.withColumn(output, select_positions(as_array(df, features), positions))


def _row_vectors(df: DataFrame, features: str) -> DataFrame:
    """The single vector column in the form the distributed matrix takes, converted inside the JVM."""
    return MLUtils.convertVectorColumnsFromML(with_vector(df.select(features), features), features)


def principal_components(df: DataFrame, k: int, features: str = "features") -> PCAModel:
    return PCA(k=k, inputCol=features, outputCol="pca").fit(with_vector(df.select(features), features))


def project_components(model: PCAModel, df: DataFrame, features: str = "features") -> DataFrame:
    """Rows times components, uncentred, in column ``pca``."""
    return model.transform(with_vector(df, features))


def truncated_svd(df: DataFrame, k: int, features: str = "features", r_cond: float = 1e-9) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(``df`` with a column ``u``, singular values, right vectors as a d×k array).

    Spark computes s and V; U = A·V·diag(1/s) is then a projection of each row, so
    rows keep their other columns and no join by position is needed.
    """
    with persisted(_row_vectors(df, features)) as rows:
        svd = RowMatrix(rows).computeSVD(k, False, r_cond)
        s, v = np.array(svd.s.toArray()), np.array(svd.V.toArray())
    return matrix_product(df, v / s, features, "u"), s, v


def matrix_product(df: DataFrame, local: np.ndarray, features: str = "features", output: str = "product") -> DataFrame:
    """Each row vector times a local d×k matrix, as ``ARRAY<DOUBLE>``.

    A small matrix is written out as JVM expressions; a larger one is applied to
    whole Arrow batches, buffer to buffer without an object per row, where one matrix product does the work of many interpreted
    array functions. A null vector has a null product.
    """
    values, matrix = as_array(df, features), np.asarray(local, dtype=float)
    if matrix.size <= EXPRESSION_CELLS:
        products = F.array(*[dot(values, literal_array(column)) for column in matrix.T])
        return df.withColumn(output, F.when(values.isNotNull(), products))

    @F.arrow_udf(ArrayType(DoubleType()))
    def multiply(rows: pa.Array) -> pa.Array:
        block = np.zeros((len(rows), len(matrix)))
        given = rows.is_valid().to_numpy(zero_copy_only=False)
        block[given] = rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(matrix))
        ends = np.arange(len(rows) + 1, dtype=np.int32) * matrix.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array((block @ matrix).reshape(-1)))

    return df.withColumn(output, F.when(values.isNotNull(), multiply(values)))


def matrix_product_long(cells: DataFrame, local: DataFrame) -> DataFrame:
    """Long form ``(row, j, value) × (j, k, weight)`` for a right matrix too large for an argument.

    Every row has an entry at each ``j``, so a matrix counted to be small is broadcast;
    a larger one meets the cells by a shuffle whose skewed partitions are split.
    """
    return (
        cells.join(broadcast_if_small(local), "j")
        .groupBy("row", "k")
        .agg(F.sum(F.col("value") * F.col("weight")).alias("value"))
    )


def gramian(df: DataFrame, features: str = "features") -> DataFrame:
    """``i, j, value`` of AᵀA: one d×d matrix per task is added up by Spark's aggregation."""
    cells = RowMatrix(_row_vectors(df, features)).computeGramianMatrix().toArray()
    rows = [(i, j, float(v)) for i, line in enumerate(cells) for j, v in enumerate(line)]
    return df.sparkSession.createDataFrame(rows, "i int, j int, value double")
