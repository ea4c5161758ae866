"""Second moments of a vector column in one pass, and what follows from them: covariances and principal components.

Each task adds up its rows' count, sum and packed upper triangle of outer products around a common shift, and hands on one
row; these rows are mergeable, so that partial results of different tables can be added too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = 8192


def packed_moments(df: DataFrame, vector: Column, shift: np.ndarray | None = None) -> DataFrame:
    """(slot, v): count, sums and upper triangle of the outer products of x - shift, one row per number; NULL vectors are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                x = x - shift if shift is not None else x
                outer = x.T @ x
                sums = np.concatenate([[len(x)], x.sum(axis=0), outer[np.triu_indices(len(outer))]])
                total = sums if total is None else total + sums
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["sums"])

    rows = df.select(vector.cast("array<double>").alias("x")).where("x IS NOT NULL")
    parts = rows.mapInArrow(run, "sums array<double>")
    return parts.select(F.posexplode("sums").alias("slot", "v")).groupBy("slot").agg(F.sum("v").alias("v"))


def covariance(df: DataFrame, vector: Column) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and sample covariance matrix of vectors of one length.

    The first row's vector is the shift, which keeps the digits of columns far from 0. The driver gets the triangle, whose size
    is that of the matrix whatever the number of rows. Without rows all is empty; one row has no covariance (NaN).
    """
    first = df.select(vector.cast("array<double>").alias("x")).where("x IS NOT NULL").first()
    if first is None:
        return 0, np.zeros(0), np.zeros((0, 0))
    shift = np.array(first["x"])
    width = len(shift)
    sums = packed_moments(df, vector, shift).orderBy("slot").toPandas()["v"].to_numpy()
    n, means = int(sums[0]), sums[1:width + 1] / sums[0]
    outer = np.zeros((width, width))
    outer[np.triu_indices(width)] = sums[width + 1:]
    outer = outer + np.triu(outer, 1).T
    with np.errstate(invalid="ignore", divide="ignore"):
        return n, means + shift, (outer - n * np.outer(means, means)) / (n - 1)


def principal(matrix: np.ndarray, k: int, rounds: int = 200, tolerance: float = 1e-12) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix and their vectors (columns) by subspace iteration; signs are fixed.

    Twice as many directions as asked for are iterated, so that a small gap after the k-th does not slow it down.
    """
    width = len(matrix)
    some = np.linalg.qr(np.random.default_rng(0).normal(size=(width, min(width, 2 * k + 4))))[0]
    before = np.full(k, np.inf)
    for _ in range(rounds):
        some = np.linalg.qr(matrix @ some)[0]
        values, turn = np.linalg.eigh(some.T @ matrix @ some)
        some, values = some @ turn[:, ::-1], values[::-1]
        if np.abs(values[:k] - before).max() <= tolerance * max(1.0, abs(values[0])):
            break
        before = values[:k]
    vectors = some[:, :k]
    return values[:k], vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
