"""Item similarity, item-based recommendation and factor scoring."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import columns as fn
from lodestone.operators.ordered import broadcast_if_small, top_per_group
from lodestone.operators.similarity import similar_columns
from lodestone.session import stored

BLOCK = 2048
USERS, ITEMS, TASKS = 1 << 16, 1 << 18, 24


def item_cosine(ratings: DataFrame, user: str, item: str, value: str, threshold: float) -> DataFrame:
    """(item, other, similarity): cosine of the rating columns of every two items, both directions, at least ``threshold``.

    Pairs come from sampled co-ratings and are verified exactly; one at the threshold is missed with a chance of one in a
    billion. Each (user, item) must occur once.
    """
    return similar_columns(ratings, user, item, value, threshold, miss=1e-9)


def most_similar(pairs: DataFrame, n: int) -> DataFrame:
    """The n most similar items of every item."""
    return top_per_group(pairs, ["item"], [F.col("similarity").desc(), F.col("other")], n, "place")


def item_based(seen: DataFrame, similar: DataFrame, user: str, item: str, n: int) -> DataFrame:
    """Items similar to a user's items and not yet seen, by highest similarity."""
    mine = seen.select(user, F.col(item).alias("item")).distinct()
    candidates = mine.join(broadcast_if_small(similar.select("item", "other", "similarity")), "item")
    best = candidates.groupBy(user, F.col("other").alias("item")).agg(F.max("similarity").alias("score"))
    return top_per_group(best.join(mine, [user, "item"], "left_anti"), [user], [F.col("score").desc(), F.col("item")], n, "place")


def nearest_to(df: DataFrame, key: str, vector: str, query: list[float], n: int, skip: int = 0) -> DataFrame:
    """The n rows whose vectors have the highest cosine with one given vector, after skipping some."""
    given = F.array(*[F.lit(float(x)) for x in query])
    scored = df.select(key, fn.cosine(fn.doubles(F.col(vector)), given).alias("similarity"))
    return scored.orderBy(F.col("similarity").desc(), key).offset(skip).limit(n)


def score_all(users: DataFrame, items: DataFrame, user: str, item: str, vector: str, n: int, block: int = BLOCK) -> DataFrame:
    """The n best items of every user of a given set by dot product, each user's own key left out.

    The users are the queries of the search, the items all rows. Both sides are cut into blocks; every block pair is one matrix product in one task that
    keeps the n best items per user, and the partial lists are merged. Neither side is
    collected or broadcast, and ties go to the smaller item key.
    """
    user_blocks = max(1, -(-users.count() // block))
    item_blocks = max(1, -(-items.count() // block))

    def side(df, key, own, own_blocks, other, other_blocks):
        return df.select(
            F.col(key).alias("id"), fn.doubles(F.col(vector)).alias("x"),
            F.pmod(F.xxhash64(key), F.lit(own_blocks)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(other_blocks - 1).cast("bigint"))).alias(other),
        )

    left = side(users, user, "_u", user_blocks, "_i", item_blocks).groupBy("_u", "_i")
    right = side(items, item, "_i", item_blocks, "_u", user_blocks).groupBy("_u", "_i")

    def best(u: pd.DataFrame, i: pd.DataFrame) -> pd.DataFrame:
        if not len(u) or not len(i):
            return pd.DataFrame({"user": [], "item": [], "score": []})
        i = i.sort_values("id")
        own, ids = u["id"].to_numpy(), i["id"].to_numpy()
        # Rounding before the choice keeps ties equal however the products are added.
        scores = np.vstack(u["x"].to_numpy()) @ np.vstack(i["x"].to_numpy()).T
        scores[own[:, None] == ids[None, :]] = -np.inf
        top = np.argsort(-np.round(scores, 9), axis=1, kind="stable")[:, :n]
        out = pd.DataFrame({
            "user": np.repeat(own, top.shape[1]), "item": ids[top].ravel(), "score": np.take_along_axis(scores, top, axis=1).ravel(),
        })
        return out[np.isfinite(out["score"])]

    partial = left.cogroup(right).applyInPandas(best, "user bigint, item bigint, score double")
    return top_per_group(partial, ["user"], [F.round("score", 9).desc(), F.col("item")], n, "place")


def _packed(df: DataFrame, key: str, vector: str, blocks: int, name: str) -> DataFrame:
    """(block, ids, x): the vectors in blocks of one row each, the longest first; stored. Rows without key or vector are left out."""

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        order = np.lexsort((ids, -np.linalg.norm(x, axis=1)))
        return pa.table({"block": table.column("block")[:1], "ids": [ids[order].tobytes()], "x": [x[order].tobytes()]})

    rows = df.select(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"), F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<float>").alias("x"))
    rows = rows.where("id is not null and x is not null")
    return stored(rows.groupBy("block").applyInArrow(pack, "block bigint, ids binary, x binary"), name)


def _best(users: np.ndarray, items: np.ndarray, ids: np.ndarray, n: int, rows: int = 256, width: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(users' rows, items' rows, scores) of the n best items of all users by dot product, ties to the smaller id; some users at a time.

    The items come longest first: once no product of lengths reaches a user's n-th best score, the rest is left out. Products in
    single precision find candidates, with room for their error; products in double precision choose among them.
    """
    own, longest = np.linalg.norm(users.astype("f8"), axis=1), np.linalg.norm(items.astype("f8"), axis=1)
    room = 1e-5 * own * longest[0]
    for first in range(0, len(users), rows):
        least = np.full(len(own[first:first + rows]), -np.inf)  # the n-th best score so far
        who, what, score, found, chosen = np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0), [], 1

        def choose():
            nonlocal who, what, score
            u, i = (np.concatenate(x) for x in zip(*found))
            exact = np.einsum("ij,ij->i", users[first + u].astype("f8"), items[i].astype("f8"))
            who, what, score = np.append(who, u), np.append(what, i), np.append(score, exact)
            order = np.lexsort((ids[what], -score, who))
            who, what, score = who[order], what[order], score[order]
            place = np.arange(len(who)) - np.searchsorted(who, who)
            least[who[place == n - 1]] = score[place == n - 1]
            who, what, score = who[place < n], what[place < n], score[place < n]
            found.clear()

        for number, start in enumerate(range(0, len(items), width), 1):
            near = room[first:first + rows]
            open_ = np.flatnonzero(own[first:first + rows] * longest[start] + near >= least)
            if not len(open_):
                break
            products = users[first + open_] @ items[start:start + width].T
            border = (least - near)[open_]
            if number == 1 and products.shape[1] > n:
                border = np.partition(products, -n, axis=1)[:, -n] - 2 * near[open_]
            at = np.flatnonzero(products >= border.astype("f4")[:, None])
            found.append((open_[at // products.shape[1]], at % products.shape[1] + start))
            if number == chosen:  # after 1, 2, 4, 8 ... steps
                choose()
                chosen *= 2
        if found:
            choose()
        yield first + who, what, score


def best_items(users: DataFrame, items: DataFrame, key: str, vector: str, n: int, block: tuple[int, int] = (USERS, ITEMS)) -> DataFrame:
    """(user, item, score, place): the n best items of every user by dot product, all users against all items.

    Both sides are packed into blocks of about as many rows as given; every pair of blocks is one task's work, whose memory is that of
    the two, and the lists of the pairs are merged. Neither side is collected; ties go to the smaller item key.
    """
    n_users, n_items = users.count(), items.count()
    blocks = max(1, -(-n_users // block[0]), min(TASKS, -(-n_users // BLOCK))), max(1, -(-n_items // block[1]))
    left = _packed(users, key, vector, blocks[0], "users").select(F.col("block").alias("u"), F.col("ids").alias("own"), F.col("x").alias("mine"))
    right = _packed(items, key, vector, blocks[1], "items")
    pairs = left.crossJoin(right).repartitionById(blocks[0] * blocks[1], (F.col("u") * blocks[1] + F.col("block")).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own, mine, ids, x = (batch.column(c)[row].as_buffer() for c in range(4))
                own, ids = np.frombuffer(own, "i8"), np.frombuffer(ids, "i8")
                mine, x = np.frombuffer(mine, "f4").reshape(len(own), -1), np.frombuffer(x, "f4").reshape(len(ids), -1)
                for who, what, score in _best(mine, x, ids, n):
                    yield pa.RecordBatch.from_arrays([pa.array(own[who]), pa.array(ids[what]), pa.array(score)], names=["user", "item", "score"])

    partial = pairs.select("own", "mine", "ids", "x").mapInArrow(run, "user bigint, item bigint, score double")
    return top_per_group(partial, ["user"], [F.col("score").desc(), F.col("item")], n, "place")
