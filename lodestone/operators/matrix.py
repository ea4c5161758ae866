"""Sparse matrices as (i, j, value) rows.

A product cuts both sides into tiles of bounded size, and each pair of tiles is multiplied with numpy in its own task. An
inner index with many rows and columns therefore never emits all their pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = 512


def transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "value")


def scale(a: DataFrame, factor: float) -> DataFrame:
    return a.withColumn("value", F.col("value") * factor)


def add(*parts: DataFrame) -> DataFrame:
    """Sum of matrices; equal cells, also within one matrix, add up."""
    total = parts[0].select("i", "j", "value")
    for part in parts[1:]:
        total = total.unionByName(part.select("i", "j", "value"))
    return total.groupBy("i", "j").agg(F.sum("value").alias("value"))


def identity(names: DataFrame, column: str, value: float = 1.0) -> DataFrame:
    """A diagonal matrix over the given index values."""
    return names.select(F.col(column).alias("i"), F.col(column).alias("j"), F.lit(float(value)).alias("value"))


def multiply(a: DataFrame, b: DataFrame, tile: int = TILE, upper: bool = False) -> DataFrame:
    """Matrix product of two matrices that hold each cell once; with `upper` only the cells with i < j."""
    left = a.select("i", F.col("j").alias("k"), F.col("value").alias("x"))
    right = b.select(F.col("i").alias("k"), "j", F.col("value").alias("y"))
    tiles = _tiles(left, "i", tile), _tiles(right, "j", tile), _tiles(left, "k", tile)
    cells = _tiled(left, right, tiles, upper)
    return cells.groupBy("i", "j").agg(F.sum("value").alias("value"))


def _tiles(df: DataFrame, column: str, tile: int) -> int:
    return max(1, -(-df.select(column).distinct().count() // tile))


def _tiled(left: DataFrame, right: DataFrame, tiles: tuple[int, int, int], upper: bool) -> DataFrame:
    """Block product: each (row tile, column tile, inner tile) holds about tile x tile cells per side."""
    row_tiles, column_tiles, inner_tiles = tiles

    def place(column, tiles):
        return F.pmod(F.xxhash64(column), F.lit(tiles))

    def copies(tiles):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(tiles - 1).cast("bigint")))

    key = ["_i", "_j", "_k"]
    a = left.select("i", "k", "x", place("i", row_tiles).alias("_i"), copies(column_tiles).alias("_j"), place("k", inner_tiles).alias("_k"))
    b = right.select("k", "j", "y", copies(row_tiles).alias("_i"), place("j", column_tiles).alias("_j"), place("k", inner_tiles).alias("_k"))
    types = {f.name: f.dataType.simpleString() for f in [*left.schema.fields, *right.schema.fields]}

    def product(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        y = y[y["k"].isin(x["k"])]
        inner = pd.Index(y["k"].unique())
        x = x[x["k"].isin(inner)]
        if x.empty:
            return pd.DataFrame({"i": [], "j": [], "value": []})
        i, rows = pd.factorize(x["i"])
        j, columns = pd.factorize(y["j"])
        m, n = np.zeros((len(rows), len(inner))), np.zeros((len(inner), len(columns)))
        p, q = m.copy(), n.copy()
        xk, yk = inner.get_indexer(x["k"]), inner.get_indexer(y["k"])
        m[i, xk], p[i, xk] = x["x"], 1.0
        n[yk, j], q[yk, j] = y["y"], 1.0
        some = p @ q > 0  # cells with at least one term, also when the terms cancel
        if upper:
            some &= np.asarray(rows)[:, None] < np.asarray(columns)[None, :]
        at = np.nonzero(some)
        return pd.DataFrame({"i": np.asarray(rows)[at[0]], "j": np.asarray(columns)[at[1]], "value": (m @ n)[at]})

    grouped = a.groupBy(*key).cogroup(b.groupBy(*key))
    return grouped.applyInPandas(product, f"i {types['i']}, j {types['j']}, value double")
