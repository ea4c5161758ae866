"""Principal components and singular values of a vector column.

The decomposition is Spark's own; k vectors of the length of a row reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_means(df: DataFrame, column: str) -> list[float]:
    cells = df.select(F.posexplode(column).alias("slot", "x")).groupBy("slot").agg(F.avg("x").alias("mean"))
    return [row["mean"] for row in cells.orderBy("slot").collect()]


def centred(df: DataFrame, column: str) -> DataFrame:
    """Subtract the column means from every vector."""
    means = F.array(*[F.lit(float(m)) for m in column_means(df, column)])
    return df.withColumn(column, F.zip_with(F.col(column).cast("array<double>"), means, lambda x, m: x - m))


def singular(df: DataFrame, column: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest singular values and their right vectors (one per column), signs fixed."""
    rows = df.select(array_to_vector(F.col(column).cast("array<double>")).alias("x"))
    found = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "x")).computeSVD(k)
    vectors = found.V.toArray()
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return found.s.toArray(), vectors * signs


def project(df: DataFrame, column: str, directions: np.ndarray, name: str) -> DataFrame:
    """Coordinates of every row along the given directions."""
    axes = [F.array(*[F.lit(float(x)) for x in direction]) for direction in directions.T]
    vector = F.col(column).cast("array<double>")
    parts = [F.aggregate(F.zip_with(vector, axis, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x) for axis in axes]
    return df.withColumn(name, F.array(*parts))


__all__ = ["centred", "column_means", "project", "singular"]
