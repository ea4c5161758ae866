"""Matrix factorization by alternating least squares on normal equations of our own.

A half-step sends the fixed side's factors along the ratings and adds up, per key, the packed triangle of their outer products
and the weighted factors. A key with many ratings is spread over chunks, whose sums are merged, so that no task holds all
ratings of a key; blocks of keys are then solved together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.session import stored

#: Ratings of one key that are summed together, and keys that are solved together.
CHUNK, BLOCK = 20_000, 4096


def hash_factors(keys: DataFrame, key: str, rank: int) -> DataFrame:
    """(key, f): starting factors between 0 and 1 that depend on the key only."""
    parts = [F.conv(F.substring(F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(k))), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32)) for k in range(rank)]
    return keys.select(F.col(key).alias("key"), F.array(*parts).alias("f"))


def sided(ratings: DataFrame, key: str, other: str, value: str) -> DataFrame:
    """(key, other, v, chunk) for the half-steps that solve `key`, stored; NULL keys and values are left out."""
    rows = ratings.select(F.col(key).alias("key"), F.col(other).alias("other"), F.col(value).cast("double").alias("v")).dropna()
    counts = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    return stored(rows.join(counts, "key").select("key", "other", "v", F.pmod(F.xxhash64("other"), "chunks").cast("int").alias("chunk")), "sided")


def _sums(rows: DataFrame, rank: int) -> DataFrame:
    """(key, sums): packed Gram triangle, weighted factors and count of rows (key, chunk, v, f); several rows per key."""
    upper = np.triu_indices(rank)
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, v = batch.column(0), batch.column(1).to_numpy()
            f = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, rank)
            cells = np.concatenate([f[:, upper[0]] * f[:, upper[1]], f * v[:, None], np.ones((len(f), 1))], axis=1)
            codes = keys.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])  # rows come sorted by key
            sums = np.add.reduceat(cells, starts, axis=0)
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(starts)), pa.array(list(sums), pa.list_(pa.float64()))], names=["key", "sums"])

    dealt = rows.repartition("key", "chunk").sortWithinPartitions("key", "chunk").select("key", "v", "f")
    return dealt.mapInArrow(run, f"key {kind}, sums array<double>")


def half_step(side: DataFrame, factors: DataFrame, rank: int, reg: float) -> DataFrame:
    """(key, f): the factors that minimise the squared errors of `side` plus reg * ratings * |f|^2 while the others stay fixed, stored.

    `factors` is (key, f) of the other side. A key none of whose partners has factors gets none.
    """
    rows = side.join(factors.select(F.col("key").alias("other"), "f"), "other").select("key", "chunk", "v", "f")
    sums = stored(_sums(rows, rank), "gram-sums")
    blocks = max(1, -(-sums.count() // BLOCK))
    kind, upper = sums.schema["key"].dataType.simpleString(), np.triu_indices(rank)

    def solve(table: pa.Table) -> pa.Table:
        column = table["key"].combine_chunks().dictionary_encode()
        codes, n = column.indices.to_numpy(zero_copy_only=False), len(column.dictionary)
        cells = table["sums"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        total = np.zeros((n, cells.shape[1]))
        np.add.at(total, codes, cells)
        gram = np.zeros((n, rank, rank))
        gram[:, upper[0], upper[1]] = gram[:, upper[1], upper[0]] = total[:, :len(upper[0])]
        gram += reg * total[:, -1, None, None] * np.eye(rank)
        found = np.linalg.solve(gram, total[:, len(upper[0]):-1, None])[:, :, 0]
        return pa.table({"key": column.dictionary, "f": pa.array(list(found), pa.list_(pa.float64()))})

    placed = sums.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    return stored(placed.groupBy("block").applyInArrow(lambda table: solve(table.select(["key", "sums"])), f"key {kind}, f array<double>"), "factors")


def dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v)


def loss(users_side: DataFrame, users: DataFrame, items: DataFrame, reg: float) -> DataFrame:
    """(n, squared, penalty) over the ratings of which both sides have factors: what a half-step makes smaller is squared + penalty."""
    rows = users_side.join(users.select("key", F.col("f").alias("p")), "key").join(items.select(F.col("key").alias("other"), F.col("f").alias("q")), "other")
    error = F.col("v") - dot(F.col("p"), F.col("q"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum(error * error).alias("squared"), (reg * F.sum(dot(F.col("p"), F.col("p")) + dot(F.col("q"), F.col("q")))).alias("penalty"))


def alternate(ratings: DataFrame, user: str, item: str, value: str, rank: int, reg: float, iterations: int) -> Iterator[tuple[int, DataFrame, DataFrame, DataFrame]]:
    """(half-step, loss, user factors, item factors) after every half-step; users are solved first, from hashed item factors.

    Each (user, item) may come several times and counts as often. Without ratings nothing is solved.
    """
    by_user, by_item = sided(ratings, user, item, value), sided(ratings, item, user, value)
    users, items = None, hash_factors(by_item.select("key").distinct(), "key", rank)
    for step in range(1, 2 * iterations + 1):
        if step % 2:
            users = half_step(by_user, items, rank, reg)
        else:
            items = half_step(by_item, users, rank, reg)
        yield step, loss(by_user, users, items, reg), users, items
