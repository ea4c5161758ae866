"""Near-duplicate texts: an n-gram Jaccard join by MinHash LSH banding with exact verification.

Each tree has a sequence of MinHash values. One prefix length holds for all texts: the longest by which a pair at the
threshold meets in some tree with the target recall; texts that share a prefix of that length meet in a node. Inside a node, signatures part what is clearly unlike, and the rest is put together into candidate groups.
Whole groups are then compared exactly, so a pair missed by all trees is still found if its group is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.components import labelled
from lodestone.llm.rows import sliced, tidy, unwrapped, wrapped
from lodestone.session import stored

TREES, DEPTH = 20, 6
MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20)
MULTIPLIERS = _rng.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)
OFFSETS = _rng.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)

#: Texts compared at once; a larger node or group is compared block by block.
BLOCK = 1024
BLOCK_BYTES = 8 << 20


def prefix_length(threshold: float, recall: float) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with the target recall."""
    for length in range(DEPTH, 1, -1):
        if 1 - (1 - threshold**length) ** TREES >= recall:
            return length
    return 1


class Shingler:
    """Text -> sorted distinct 64-bit hashes of its word n-grams. A text of fewer words is one n-gram; of none, empty."""

    def __init__(self, n: int):
        self.n = n
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        fresh = [w for w in set(words) if w not in known]
        if fresh:
            if len(known) + len(fresh) > 150_000:
                known.clear()
                fresh = list(set(words))
            known.update((w, xxhash.xxh3_64_intdigest(w) >> 1) for w in fresh)
        h = np.fromiter(map(known.__getitem__, words), np.int64, len(words)).view(np.uint64)
        n = min(self.n, len(h))
        out = h[:len(h) - n + 1].copy()
        for k in range(1, n):
            out *= MIX
            out += h[k:len(h) - n + 1 + k]
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
        return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """TREES * DEPTH values of 32 bits."""
    least = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(shingles), 512):
        hashed = (shingles[i:i + 512, None] * MULTIPLIERS + OFFSETS) >> np.uint64(32)
        np.minimum(least, hashed.min(axis=0).astype(np.uint32), out=least)
    return least


def sketched(df: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(id, text_hash, content, size, signature) of every row, stored; `content` is a 128-bit hash of the n-gram set.

    Rows without words have size 0 and a NULL signature.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        for batch in sliced(batches):
            contents, sizes, signatures = [], [], []
            for text in batch.column(2).to_pylist():
                grams = shingle(text)
                contents.append(xxhash.xxh3_128_digest(grams))
                sizes.append(len(grams))
                signatures.append(signature(grams).tobytes() if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(contents, pa.binary()), pa.array(sizes, pa.int32()), pa.array(signatures, pa.binary())],
                names=["id", "text_hash", "content", "size", "signature"],
            )

    hashed = rows.select("id", F.xxhash64("text").alias("text_hash"), "text")
    return stored(hashed.mapInArrow(tidy(run), f"id {kind}, text_hash bigint, content binary, size int, signature binary"), "sketches")


def _blocks(blocks: Column, key: str) -> Column:
    """The pairs of blocks that a row takes part in, the row being in block hash(key) mod blocks."""
    own = F.pmod(F.xxhash64(key, F.lit(1)), blocks).cast("int")
    return F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), own.alias("own")))


def _joined_groups(alike: np.ndarray) -> np.ndarray:
    """The least row of each row's connected component in a symmetric matrix."""
    label = np.arange(len(alike))
    while True:
        least = np.minimum(label, np.where(alike, label[None, :], len(alike)).min(axis=1))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _near_in_node(table: pa.Table, floor: float) -> pa.Table:
    """Edges that join the texts of a node whose signatures agree in at least `floor` of their values."""
    signs = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint32).reshape(table.num_rows, -1)
    agree = np.zeros((len(signs), len(signs)), np.uint8)
    for k in range(signs.shape[1]):
        column = signs[:, k]
        agree += column[:, None] == column[None, :]
    label = _joined_groups(agree >= floor * signs.shape[1])
    moved = np.flatnonzero(label != np.arange(len(label)))
    content = table["content"].combine_chunks()
    return pa.table({"u": content.take(pa.array(moved)), "v": content.take(pa.array(label[moved]))})


def candidate_edges(sketches: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(u, v) contents of texts that meet in a node of the forest, as few edges as keep them together."""
    length = prefix_length(threshold, recall)
    distinct = sketches.where("size > 0").groupBy("content").agg(F.first("signature").alias("signature"))
    distinct = stored(distinct, "signatures")
    start = lambda t: t * F.lit(4 * DEPTH) + 1
    nodes = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.xxhash64(t, F.substring("signature", start(t), F.lit(4 * length))))
    rows = distinct.select("content", F.explode(nodes).alias("node"))
    shared = rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(rows.join(shared, "node"), "nodes")
    met = met.join(distinct, "content")
    pairs = met.withColumn("b", F.explode(_blocks(F.ceil(F.col("n") / BLOCK).cast("int"), "content")))
    pairs = pairs.select("node", F.col("b.i").alias("i"), F.col("b.j").alias("j"), "content", "signature")
    # the spread of an estimate from all values is below 0.04, so true pairs stay
    near = pairs.groupBy("node", "i", "j").applyInArrow(lambda table: _near_in_node(table, threshold - 0.2), "u binary, v binary")
    return near.distinct()


def _verified(table: pa.Table, threshold: float) -> pa.Table:
    """Exact similarities of the texts of two blocks (or one) of a group: links per text, and edges that join what is linked."""
    sets = [np.frombuffer(s, np.uint64) for s in table["grams"].to_pylist()]
    own, copies = table["own"].to_numpy(), table["copies"].to_numpy()
    cross = table["i"][0].as_py() != table["j"][0].as_py()
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    rows = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    several = count[column] > 1
    place = np.cumsum(count > 1) - 1
    rows, column = rows[several], place[column[several]]
    common = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    width = 2048
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [first, first + width])
        part = np.zeros((len(sets), width), np.float32)
        part[rows[a:b], column[a:b] - first] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    alike = common >= threshold * union - 1e-6
    np.fill_diagonal(alike, False)
    if cross:  # pairs inside a block belong to the block alone
        alike &= own[:, None] != own[None, :]
    label = _joined_groups(alike)
    content = table["content"].combine_chunks()
    return pa.table({"content": content, "links": pa.array(alike @ copies, pa.int64()), "root": content.take(pa.array(label))})


def near_duplicates(df: DataFrame, id_col: str, text_col: str, n: int = 5, threshold: float = 0.8, recall: float = 0.999, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(id, text_hash, class_id, n_links, keep) for every row: its group of near-duplicates, named by its least id, the number
    of rows linked to it, and whether it is the row that stands for the group.

    Two rows are linked if the Jaccard similarity of their word n-grams (lower case, cut at white space) is at least
    `threshold`; a class is a connected component of links. Rows with equal sets are found first and compared once; they
    are links of each other and count as often as they come. NULL and empty texts have no n-grams and link to nothing: each is
    its own class. NULL ids are a class id like any other; repeated rows are copies; other columns are left out.
    A node of the forest or a candidate group of any size is compared in blocks of at most about BLOCK texts, as tasks of
    their own; no pair is written out.
    """
    sketches = sketched(df, id_col, text_col, n)
    contents = stored(sketches.where("size > 0").groupBy("content").agg(
        F.min(F.struct("id", "text_hash")).alias("first"), F.count("*").alias("copies"), F.first("size").alias("size")), "contents")
    groups = labelled(candidate_edges(sketches, threshold, recall))
    members = groups.select(F.col("u").alias("content"), F.col("v").alias("group")).unionByName(groups.select(F.col("v").alias("content"), F.col("v").alias("group")).distinct())
    members = members.join(contents, "content").select("content", "group", "copies", "size", F.col("first.id").alias("id"), F.col("first.text_hash").alias("text_hash"))
    members = stored(members, "members")
    totals = members.groupBy("group").agg(F.count("*").alias("texts"), F.sum("size").alias("grams"))
    blocks = F.greatest(F.ceil(F.col("texts") / (BLOCK // 2)), F.ceil(F.col("grams") * 8 / BLOCK_BYTES)).cast("int")
    members = stored(members.join(totals, "group").select("content", "group", "copies", "id", "text_hash", blocks.alias("blocks")), "members")
    bytes_of = (members.count()) * 96
    sized = F.broadcast(members) if bytes_of <= broadcast_bytes else members
    texts = df.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col).cast("string")).alias("_hash"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(sized, texts["_id"].eqNullSafe(sized["id"]) & (texts["_hash"] == sized["text_hash"]))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        for batch in sliced(batches):
            found = pa.array([shingle(t).tobytes() for t in batch.column(4).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], found], names=["content", "group", "copies", "blocks", "grams"])

    # a text that comes twice with one id is the same content
    sets = texts.select("content", "group", "copies", "blocks", "text").mapInArrow(tidy(grams), "content binary, group binary, copies bigint, blocks int, grams binary")
    dealt = sets.withColumn("b", F.explode(_blocks(F.col("blocks"), "content")))
    dealt = dealt.select("group", F.col("b.i").alias("i"), F.col("b.j").alias("j"), F.col("b.own").alias("own"), "content", "copies", "grams")

    def verify(table: pa.Table) -> pa.Table:
        seen: dict[bytes, int] = {}
        for row, content in enumerate(table["content"].to_pylist()):
            seen.setdefault(content, row)
        return _verified(table.take(pa.array(list(seen.values()))), threshold)

    linked = stored(dealt.groupBy("group", "i", "j").applyInArrow(verify, "content binary, links bigint, root binary"), "links")
    classes = labelled(linked.where(F.col("content") != F.col("root")).select(F.col("content").alias("u"), F.col("root").alias("v")))
    links = linked.groupBy("content").agg(F.sum("links").alias("links"))
    named = contents.join(classes.withColumnRenamed("u", "content"), "content", "left").join(links, "content", "left")
    named = stored(named.select(
        "content", F.coalesce("v", "content").alias("root"), "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named")
    # structs are compared field by field, NULL before any id
    least = named.groupBy("root").agg(F.min("first").alias("class"))
    named = stored(named.join(least, "root").select("content", "class", "n_links"), "classes")
    rows = sketches.select("id", "text_hash", "content", "size").join(named, "content", "left")
    own = F.col("size") == 0
    return rows.select(
        F.col("id").alias(id_col), "text_hash", F.when(own, F.col("id")).otherwise(F.col("class.id")).alias("class_id"),
        F.when(own, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        (own | (F.col("id").eqNullSafe(F.col("class.id")) & (F.col("text_hash") == F.col("class.text_hash")))).alias("keep"))


def without_near_duplicates(df: DataFrame, id_col: str, text_col: str, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row of each class of `near_duplicates`, the one with the least id; all columns stay.

    Rows without words all stay. Of rows with equal id and text one stays.
    """
    found = stored(near_duplicates(df, id_col, text_col, n, threshold), "near-duplicates")
    keys = found.groupBy(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash")).agg(F.max("keep").alias("_keep"), F.max("n_links").alias("links"), F.count("*").alias("_n"))
    # what stays as it is need not be looked up
    keys = stored(keys.where(~F.col("_keep") | ((F.col("_n") > 1) & (F.col("links") > 0))).select("_id", "_hash", "_keep"), "dropped")
    side = F.broadcast(keys) if keys.count() * 112 <= 64 << 20 else keys
    rows = wrapped(df, id=F.col(id_col), hash=F.xxhash64(F.col(text_col).cast("string")))
    both = rows.join(side, F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")), "left")
    single = both.where("_keep IS NULL").select("row")
    return unwrapped(single.unionByName(both.where("_keep").dropDuplicates(["id", "hash"]).select("row")), df.columns)
