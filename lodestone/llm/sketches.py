"""Near-duplicate documents by bottom-k sketches: components of the links between their sets of word n-grams.

One hash function orders all n-grams; a set keeps its 128 least values as its sketch. Inverted lists hold the nodes (distinct
sets) of the 32 least of them: two linked sets share so many of these that each needs to stand in the lists of its rarest
values only. Per list every node is paired with the least node; the sketch of a pair's union, the least 128 values of both,
filters pairs, and full sets decide. That joins groups of copies without all their pairs. In lists whose nodes are not yet in
one component, the nodes outside the largest are compared with all others, block by block: sketches put components that may
be linked into groups, and the full sets of a group decide. Only pairs that join components leave a block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.components import labelled
from lodestone.llm.rows import sliced, tidy
from lodestone.operators.ordered import broadcast_if_small
from lodestone.session import spread, stored

KEPT, LISTED = 128, 32
#: Chance that a linked pair of large sets shares fewer values than `sure_overlap` says.
MISS = 1e-9
#: Nodes, and n-grams of their sets, that are compared at once with as many others.
BLOCK, BLOCK_GRAMS = 1024, 1 << 20
WORDS_HELD = 300_000
_FACTORS = np.random.default_rng(11).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def sure_overlap(width: int, percent: int) -> int:
    """The largest number that at least so many of the union's `width` least values are shared, but for a chance of MISS."""
    p, below = percent / 100, 0.0
    for shared in range(width + 1):
        below += math.comb(width, shared) * p**shared * (1 - p) ** (width - shared)
        if below > MISS:
            return shared
    return width


class Grams:
    """Text -> sorted distinct 64-bit hashes of its word n-grams; fewer words are one n-gram, none give an empty set."""

    def __init__(self, n: int):
        self.n = n
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()  # of bytes: A-Z only, ASCII white space only
        if not words:
            return np.empty(0, np.int64)
        known = self.known
        if len(known) > WORDS_HELD:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(h))
        size = len(h) - n + 1
        out = np.full(size, n, np.uint64)
        for k in range(n):
            out += h[k:size + k] * _FACTORS[k]
            out ^= out >> np.uint64(31)
            out *= np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
        return np.unique(out.view(np.int64))


def _sketched(df: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(row, id, text_hash, content, size, sketch) of every row, stored; an empty set has no content and no sketch."""
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(n)
        for batch in sliced(batches, 200):
            sets = [grams(t) for t in batch.column(2).to_pylist()]
            sketches = pa.array([s[:KEPT] if len(s) else None for s in sets], pa.list_(pa.int64()))
            contents = pa.array([xxhash.xxh3_128_digest(s) if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), contents, pa.array([len(s) for s in sets], pa.int64()), sketches],
                names=["id", "text_hash", "content", "size", "sketch"],
            )

    out = spread(rows).mapInArrow(tidy(run), f"id {kind}, text_hash bigint, content binary, size bigint, sketch array<bigint>")
    return stored(out.withColumn("row", F.monotonically_increasing_id()), "bottom-k")


def _firsts(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows that stand for their content: all with one but its copies, which are broadcast while they are few, so that sketches stay where they are."""
    copied = nodes.where("copies > 1").select("content", "node")
    copies = stored(rows.select("content", "row").join(copied, "content").where("row <> node").select("row"), "copies")
    return rows.where("content is not null").join(broadcast_if_small(copies, rows=1 << 20, most=64 << 20), "row", "left_anti")


def _index(sets: DataFrame, percent: int) -> DataFrame:
    """(value, node): the inverted lists of the values that each node must be found by, stored.

    Of r listed values a linked set shares at least s, so one of the r - s + 1 rarest is shared. A value that no other node has
    takes one of these places, though it makes no list. Of lists that hold the same nodes, one is kept.
    """
    listed = F.slice("sketch", 1, LISTED)
    values = sets.select("node", F.size(listed).alias("r"), F.explode(listed).alias("value"))
    lists = values.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    shared = values.join(lists, "value").groupBy("node", "r").agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("found"))  # 32 at most
    places = F.col("r") - F.least(F.lit(sure_overlap(LISTED, percent)), F.ceil(F.col("r") * percent / 100)) + 1
    rarest = F.slice("found", 1, F.greatest(F.lit(0), places - (F.col("r") - F.size("found"))).cast("int"))
    index = stored(shared.select("node", F.explode(rarest).alias("at")).select(F.col("at.value").alias("value"), "node"), "lists")
    nodes = [F.sum(F.xxhash64("node", F.lit(k)).cast("decimal(38,0)")).alias(f"h{k}") for k in (1, 2)]
    members = index.groupBy("value").agg(F.count("*").alias("n"), *nodes).where("n > 1")
    return stored(index.join(members.groupBy("n", "h1", "h2").agg(F.min("value").alias("value")), "value").select("value", "node"), "distinct-lists")


def _spanning(held: list, close) -> list[tuple[int, int]]:
    """Pairs of components that some close pair of a row outside and a row inside joins; (outside, comp, values) rows."""
    inside, outside = [h for h in held if not h[0]], [h for h in held if h[0]]
    sizes = np.array([len(h[2]) for h in inside])
    values = np.concatenate([h[2] for h in inside])
    order = np.argsort(values, kind="stable")
    values, owners = values[order], np.repeat(np.arange(len(inside)), sizes)[order]
    root = {h[1]: h[1] for h in held}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for _, comp, own in outside:
        low, high = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
        some = high > low
        low, n = low[some], (high - low)[some]
        ends = np.cumsum(n)
        met = owners[np.arange(ends[-1] if len(n) else 0) + np.repeat(low - (ends - n), n)]
        both = np.bincount(met, minlength=len(inside))
        for x in np.flatnonzero((both > 0) & close(both, sizes, len(own))):
            one, two = find(comp), find(inside[x][1])
            if one != two:
                root[max(one, two)] = min(one, two)
                out.append((comp, inside[x][1]))
    return out


def _opened(rows: DataFrame, cost: Column, most: int) -> DataFrame:
    """(value, i, j, outside, node, comp): the groups of (value, node, comp, size) that hold more than one component, in blocks.

    Rows outside a group's largest component meet all its rows, in blocks of about BLOCK rows and `most` of the cost each: a
    group is copied as often as its outside rows fill blocks, so that many copies with some strangers are gone through once.
    """
    rows = rows.withColumn("cost", cost.cast("bigint"))
    parts = rows.groupBy("value", "comp").agg(F.count("*").alias("c"), F.sum("cost").alias("s"))
    groups = parts.groupBy("value").agg(F.max(F.struct("c", "comp", "s")).alias("most"), F.sum("c").alias("n"), F.sum("s").alias("cost"), F.count("*").alias("parts")).where("parts > 1")
    blocks = lambda n, cost: F.greatest(F.ceil(n / BLOCK), F.ceil(cost / most)).cast("int")
    groups = groups.select("value", F.col("most.comp").alias("largest"), blocks(F.col("n"), F.col("cost")).alias("blocks"), blocks(F.col("n") - F.col("most.c"), F.col("cost") - F.col("most.s")).alias("outer"))
    met = stored(rows.select("value", "node", "comp").join(groups, "value"), "open-groups")
    own, each = F.xxhash64("node"), lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    inner = met.select("value", each("outer").alias("i"), F.pmod(own, "blocks").cast("int").alias("j"), F.lit(False).alias("outside"), "node", "comp")
    outer = met.where("comp <> largest").select("value", F.pmod(own, "outer").cast("int").alias("i"), each("blocks").alias("j"), F.lit(True).alias("outside"), "node", "comp")
    return inner.unionByName(outer)


def _joining(rows: DataFrame, values: DataFrame, close) -> DataFrame:
    """(u, v): pairs of components of opened rows that hold a close pair, stored; `values` has (node, values).

    `close(both, sizes, size)` tells from shared values and sizes which rows inside are close to a row outside. Two blocks
    are held at once, and pairs that a block has joined by others are not written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, sides = None, [], set()

        def pairs():
            found = _spanning(held, close) if len(sides) == 2 else []
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

        for batch in sliced(batches, 256):
            at = list(zip(*[batch.column(k).to_pylist() for k in range(5)]))
            starts, numbers = batch.column(5).offsets.to_numpy(), batch.column(5).values.to_numpy()
            for k, (value, i, j, outside, comp) in enumerate(at):
                if (value, i, j) != key:
                    if held:
                        yield pairs()
                    key, held, sides = (value, i, j), [], set()
                held.append((outside, comp, numbers[starts[k]:starts[k + 1]].copy()))
                sides.add(outside)
        if held:
            yield pairs()

    rows = broadcast_if_small(stored(rows, "blocks"), rows=1 << 20, most=64 << 20)  # so that the values stay where they are
    keyed = rows.join(values, "node").repartition("value", "i", "j").sortWithinPartitions("value", "i", "j")
    return stored(keyed.select("value", "i", "j", "outside", "comp", "values").mapInArrow(tidy(run), "u bigint, v bigint").distinct(), "joining")


def _outside_links(index: DataFrame, comps: DataFrame, sets: DataFrame, grams, percent: int) -> DataFrame:
    """(u, v): pairs of components (u, v) that links between their nodes join.

    In the lists that hold several components, sketches that may be of linked sets put components together in groups; in each
    group, which holds a node once however many lists it stands in, full sets decide.
    """
    sure = sure_overlap(KEPT, percent)
    nodes = sets.join(comps, sets["node"] == comps["u"], "left").select("node", "size", F.coalesce("v", "node").alias("comp"))
    listed = _opened(index.join(nodes, "node").select("value", "node", "comp", "size"), F.lit(0), 1)
    near = _joining(listed, sets.select("node", F.col("sketch").alias("values")), lambda both, sizes, size: both >= np.minimum(sure, np.ceil(np.maximum(sizes, size) * percent / 100)))
    groups = labelled(near)
    members = groups.select(F.col("u").alias("comp"), F.col("v").alias("value")).unionByName(groups.select(F.col("v").alias("comp"), F.col("v").alias("value")).distinct())
    grouped = _opened(nodes.join(members, "comp").select("value", "node", "comp", "size"), F.col("size"), BLOCK_GRAMS)
    full = grams(nodes.join(members, "comp").select("node"))
    return _joining(grouped, full.select("node", F.col("grams").alias("values")), lambda both, sizes, size: both * 100 >= (sizes + size - both) * percent)


def _side(sets: DataFrame, name: str, column: str) -> DataFrame:
    return sets.select(F.col("node").alias(name), F.col("size").alias(f"size_{name}"), F.col(column).alias(f"set_{name}"))


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _of_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of the given nodes; the nodes are broadcast while they are few, so that the rows stay where they are."""
    return rows.join(broadcast_if_small(stored(nodes, "nodes"), rows=1 << 20, most=64 << 20), "node", "left_semi")


def union_sketch_passes(percent: int) -> Column:
    """Whether the sketches set_a and set_b leave it possible that 100 * intersection >= percent * union."""
    union, common = F.array_sort(F.array_union("set_a", "set_b")), F.array_intersect("set_a", "set_b")
    both = F.size(F.array_intersect(common, F.slice(union, 1, KEPT)))
    whole = (F.col("size_a") <= KEPT) & (F.col("size_b") <= KEPT)  # nothing is cut: the sketches are the sets
    exact = F.size(common) * 100 >= F.size(union) * percent
    return F.when(whole, exact).otherwise(both >= F.least(F.lit(sure_overlap(KEPT, percent)), F.ceil(F.size(union) * percent / 100)))


def _full_sets(nodes: DataFrame, sets: DataFrame, df: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(node, size, grams) of the given nodes, stored: the sketch if nothing was cut, else made from the text again."""
    wanted = _of_nodes(sets, nodes)
    whole = wanted.where(F.col("size") <= KEPT).select("node", "size", F.col("sketch").alias("grams"))
    large = stored(wanted.where(F.col("size") > KEPT).select("node", F.col("id").alias("_id"), F.col("text_hash").alias("_hash")), "large")
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    large = broadcast_if_small(large, rows=1 << 20, most=64 << 20)  # else the texts are shuffled
    texts = texts.join(large, (F.xxhash64("text") == F.col("_hash")) & F.col("id").eqNullSafe(F.col("_id")))
    texts = texts.groupBy("node").agg(F.min("text").alias("text")).select("node", F.col("text").cast("binary").alias("text"))  # a row may come again

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(n)
        for batch in sliced(batches, 64):
            found = [grams(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["node", "size", "grams"])

    return stored(texts.mapInArrow(tidy(run), "node bigint, size bigint, grams array<bigint>").unionByName(whole), "full-sets")


def _linked(pairs: DataFrame, sets: DataFrame, grams, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are linked, stored; sketches of their unions sort out most others."""
    pairs = stored(pairs, "pairs")
    sketches = stored(_of_nodes(sets.select("node", "size", "sketch"), _nodes(pairs)), "met")
    likely = stored(pairs.join(_side(sketches, "a", "sketch"), "a").join(_side(sketches, "b", "sketch"), "b").where(union_sketch_passes(percent)).select("a", "b"), "likely")
    full = grams(_nodes(likely))
    both = F.size(F.array_intersect("set_a", "set_b"))
    joined = likely.join(_side(full, "a", "grams"), "a").join(_side(full, "b", "grams"), "b")
    return stored(joined.where(both * 100 >= (F.col("size_a") + F.col("size_b") - both) * percent).select("a", "b"), "links")


def near_duplicates(df: DataFrame, id_col: str, text_col: str, n: int = 3, percent: int = 85) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row: the component of rows linked by n-gram sets alike.

    Texts are lower-cased (A-Z) and cut at ASCII white space; rows are linked if 100 * intersection >= percent * union of
    their sets of distinct n-grams, whose full sets are compared (as 64-bit hashes). A text of fewer words is one n-gram. A
    NULL or empty text, or one without words, has an empty set and is linked with nothing: its component is itself.
    `component_id` is the least id that links reach, `kept` whether that is the row's own. NULL ids are no least id, unless a
    component has no other. Repeated rows are linked, being equal; rows that repeat the least id are all kept. An empty table
    gives no rows. Very long texts are read whole. Other columns are left out, whatever their names.

    Sets of up to 128 n-grams meet for sure; a linked pair of larger sets is missed with a chance of about one in a billion.
    Work grows with the rows, with the lists' sizes, and with the product of a list's nodes and its nodes outside its largest
    component.
    """
    rows = _sketched(df, id_col, text_col, n)
    nodes = stored(rows.where("content is not null").groupBy("content").agg(F.min("row").alias("node"), F.min("id").alias("least"), F.count("*").alias("copies")), "nodes")
    sets = stored(_firsts(rows, nodes).select(F.col("row").alias("node"), "id", "text_hash", "size", "sketch"), "sets")
    index = _index(sets, percent)
    heads = index.groupBy("value").agg(F.min("node").alias("a"), F.max("node").alias("other")).where("a < other").select("value", "a")
    first = index.join(heads, "value").where("node <> a").select("a", F.col("node").alias("b")).distinct()

    def grams(wanted: DataFrame) -> DataFrame:
        return _full_sets(wanted, sets, df, id_col, text_col, n)

    links = _linked(first, sets, grams, percent)
    comps = labelled(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    more = _outside_links(index, comps, sets, grams, percent)
    if not more.isEmpty():
        comps = labelled(comps.unionByName(more))
    of = nodes.join(comps, nodes["node"] == comps["u"], "left").select("content", "least", F.coalesce("v", "node").alias("comp"))
    leasts = of.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = of.join(leasts, "comp").select("content", "component_id")
    out = rows.select("id", "size", "content").join(named, "content", "left")
    component = F.when(F.col("content").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
