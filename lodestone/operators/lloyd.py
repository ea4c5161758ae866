"""K-means by Lloyd's iterations: every pass assigns rows to centres and adds up the new means in its tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.session import stored

#: Rows whose distances to all centres are held at once.
ROWS = 4096


@dataclass(frozen=True)
class Pass:
    """One iteration: rows and summed squared distance of every cluster, to the centres before the means moved."""

    iteration: int
    sizes: tuple[int, ...]
    costs: tuple[float, ...]


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of the nearest centres of every row, and the squared distance to it."""
    squared = np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1)
    found = squared.argmin(axis=1)
    return found, squared[np.arange(len(x)), found]


def _blocks(batches, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            part = batch.slice(first, ROWS)
            yield part, part.column(part.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _pass(rows: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, costs and vector sums of the clusters."""
    k, width = centres.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, width + 2))
        for _, x in _blocks(batches, width):
            found, squared = nearest(x, centres)
            total[:, 0] += np.bincount(found, minlength=k)
            total[:, 1] += np.bincount(found, squared, minlength=k)
            np.add.at(total[:, 2:], found, x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["cluster", "sums"])

    parts = rows.select("x").mapInArrow(run, "cluster int, sums array<double>").select("cluster", F.posexplode("sums").alias("slot", "v"))
    cells = parts.groupBy("cluster", "slot").agg(F.sum("v").alias("v")).toPandas()  # as many rows as the centres have numbers
    table = np.zeros((k, width + 2))
    table[cells["cluster"], cells["slot"]] = cells["v"]
    return table[:, 0].astype(np.int64), table[:, 1], table[:, 2:]


def hash_chosen(df: DataFrame, key: Column, vector: Column, k: int) -> np.ndarray:
    """The vectors of the k rows whose keys have the least hashes (then the least keys)."""
    name = key.cast("string")
    rows = df.select(F.md5(name).alias("h"), name.alias("key"), vector.cast("array<double>").alias("x")).where("x IS NOT NULL AND key IS NOT NULL")
    return np.array([r["x"] for r in rows.orderBy("h", "key").limit(k).collect()])


def fit(df: DataFrame, vector: Column, centres: np.ndarray, iterations: int, tolerance: float = 0.0) -> tuple[np.ndarray, list[Pass]]:
    """Centres after Lloyd's iterations from given centres, and what each pass saw.

    A cluster without rows keeps its centre. The loop ends early if no centre moves by more than `tolerance`. Ties go to the
    first centre; rows with a NULL vector are left out; the cost of a pass is never above that of the one before.
    """
    rows = stored(df.select(vector.cast("array<double>").alias("x")).where("x IS NOT NULL"), "points")
    done = []
    for t in range(1, iterations + 1):
        sizes, costs, sums = _pass(rows, centres)
        done.append(Pass(t, tuple(int(n) for n in sizes), tuple(float(c) for c in costs)))
        moved = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
        shift = float(np.sqrt(((moved - centres) ** 2).sum(axis=1)).max(initial=0.0))
        centres = moved
        if shift <= tolerance:
            break
    return centres, done


def assigned(df: DataFrame, key: str, vector: Column, centres: np.ndarray) -> DataFrame:
    """(key, cluster, distance): the nearest centre of every row and the squared distance; NULL for a NULL vector."""
    rows = df.select(F.col(key).alias("key"), vector.cast("array<double>").alias("x"))
    kind, width = rows.schema["key"].dataType.simpleString(), centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, width):
            found, squared = nearest(x, centres)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.astype(np.int32)), pa.array(squared)], names=["key", "cluster", "distance"])

    out = rows.where("x IS NOT NULL").mapInArrow(run, f"key {kind}, cluster int, distance double")
    none = rows.where("x IS NULL").select("key", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("double").alias("distance"))
    return out.unionByName(none).withColumnRenamed("key", key)
