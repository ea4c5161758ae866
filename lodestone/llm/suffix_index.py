"""Removal of long byte strings that occur more than once, by a logarithmic family of tables of anchored fingerprints.

Of all starts only anchors are kept: a window of LENGTH bytes is represented by the position of its least k-gram hash among its
first SPAN positions, so equal windows have the same anchor at the same place. All starts with one anchor form a run, whose
key is the fingerprint of the bytes that every window of the run has in common. No suffix order is kept: only equality is
asked for. New batches are counted together with the existing levels; levels of equal size are merged into the next one.
Anchors that met another are then told apart exactly: runs with equal surroundings are repeated as a whole, others are cut
into ever shorter ranges of starts until each window is compared by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from lodestone.llm.rows import sliced, tidy, unwrapped, wrapped
from lodestone.session import stored

GRAM = 16
CHUNK = 1 << 19
PLACE = np.uint64((1 << 20) - 1)
POSTING = "id {}, text_hash bigint, p int, lo int, hi int, key bigint, same bigint"


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def digest(data: bytes, seed: int = 0) -> int:
    return signed(xxhash.xxh3_64_intdigest(data, seed))


def runs(data: bytes, length: int, span: int) -> Iterator[tuple[int, int, int]]:
    """(anchor, first start, last start) of every run of windows of `length` bytes."""
    n_starts = len(data) - length + 1
    for base in range(0, n_starts, CHUNK):
        n = min(CHUNK, n_starts - base)
        size = n + span - 1  # positions whose k-gram may be an anchor
        words = np.ndarray((size + GRAM - 8,), "<u8", data, base, (1,))
        h = words[:size] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        h += words[GRAM - 8:]
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h &= ~PLACE
        h |= np.arange(size, dtype=np.uint64)  # of equal hashes the first
        width = 1
        while 2 * width <= span:
            h = np.minimum(h[:-width], h[width:])
            width *= 2
        h = np.minimum(h[:n], h[span - width:span - width + n])
        at = (h & PLACE).astype(np.int64) + base
        first = np.flatnonzero(np.diff(at, prepend=-1))
        last = np.append(first[1:], n) - 1
        yield from zip(at[first].tolist(), (first + base).tolist(), (last + base).tolist())


class SuffixFamily:
    """Levels of (key, number of anchors); level r holds 2**r batches. Postings stay with their batch.

    A batch has the columns id and text. NULL texts are empty. Rows with equal id and text are one document for the
    postings, whose strings all occur twice.
    """

    def __init__(self, spark: SparkSession, id_type: str, length: int = 400, span: int = 200):
        self.spark, self.id_type, self.length, self.span = spark, id_type, length, span
        self.levels: dict[int, DataFrame] = {}
        self.batches: list[DataFrame] = []
        self.met: list[DataFrame] = []

    def suffixes(self, docs: DataFrame) -> DataFrame:
        """The anchored fingerprints of a batch, stored."""
        length, span = self.length, self.span

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches, 500):
                row, ps, los, his, keys, sames = [], [], [], [], [], []
                for i, text in enumerate(batch.column(2).to_pylist()):
                    data = (text or "").encode()
                    before = len(ps)
                    for p, first, last in runs(data, length, span):
                        ps.append(p)
                        los.append(p - last)
                        his.append(p - first)
                        keys.append(digest(data[p:p + length - span + 1]))
                        sames.append(digest(data[first:last + length], 1))
                    row.extend([i] * (len(ps) - before))
                take = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), *(pa.array(x, pa.int32()) for x in (ps, los, his)), *(pa.array(x, pa.int64()) for x in (keys, sames))],
                    names=["id", "text_hash", "p", "lo", "hi", "key", "same"])

        rows = docs.select("id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(tidy(run), POSTING.format(self.id_type))
        return stored(rows, "suffixes")

    def ingest(self, docs: DataFrame) -> None:
        """Add a batch: its fingerprints, counted together with those of all levels, and the merge of equal levels."""
        batch = self.suffixes(docs)
        self.batches.append(batch)
        rank = 0
        while rank in self.levels:
            rank += 1
        new = batch.groupBy("key").agg(F.count("*").alias("n")).select("key", "n", F.lit(-1).alias("level"))
        both = new
        for r, level in self.levels.items():
            both = both.unionByName(level.select("key", "n", F.lit(r).alias("level")))
        # levels below `rank` are merged with the batch into the level `rank`
        scan = both.groupBy("key").agg(
            F.sum("n").alias("all"), F.sum(F.when(F.col("level") < 0, F.col("n")).otherwise(0)).alias("new"), F.sum(F.when(F.col("level") < rank, F.col("n")).otherwise(0)).alias("n"))
        scan = stored(scan.where("n > 0"), "level")
        self.met.append(scan.where((F.col("new") > 0) & (F.col("all") > 1)).select("key"))
        self.levels = {r: level for r, level in self.levels.items() if r > rank} | {rank: scan.select("key", "n")}

    def candidates(self) -> DataFrame:
        """The postings whose key met another one in some scan, stored."""
        met, postings = self.met[0], self.batches[0]
        for more in self.met[1:]:
            met = met.unionByName(more)
        for more in self.batches[1:]:
            postings = postings.unionByName(more)
        met = stored(met.distinct(), "met")
        return stored(postings.join(sized(met, 8), "key", "left_semi"), "candidates")


def sized(df: DataFrame, row_bytes: int, most: int = 64 << 20) -> DataFrame:
    """A stored table as it is, or to be broadcast if its rows, with what a hash table adds, take at most `most` bytes."""
    return F.broadcast(df) if df.count() * (row_bytes + 64) <= most else df


def packed(df: DataFrame, kind: str, values: str, merge: int = 0) -> DataFrame:
    """(_id, _hash, values) with an array of structs of ints as one binary column of little-endian 32-bit integers.

    With `merge`, pairs (first, last) of starts of strings of that length become disjoint, sorted (begin, end) pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2000):
            out = []
            for own in batch.column(2):
                fields = [f.to_numpy(zero_copy_only=False) for f in own.values.flatten()]
                if merge:
                    order = np.argsort(fields[0], kind="stable")
                    begin, end = fields[0][order], np.maximum.accumulate(fields[1][order] + merge)
                    heads = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]))
                    fields = [begin[heads], end[np.append(heads[1:], len(begin)) - 1]]
                out.append(np.stack(fields, axis=1).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["_id", "_hash", values])

    return df.mapInArrow(tidy(run), f"_id {kind}, _hash bigint, {values} binary")


def sized_lists(df: DataFrame, values: str, most: int = 64 << 20) -> DataFrame:
    """The same for a table of packed lists."""
    size = df.agg(F.sum(F.octet_length(values) + 96)).first()[0] or 0
    return F.broadcast(df) if size <= most else df


def _told_apart(rows: DataFrame, key: list[str], same: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose `same` comes twice or more under their key; one row of each `same` under keys with several)."""
    posting = [c for c in rows.columns if c not in key + same]
    classes = stored(rows.groupBy(*key, *same).agg(F.count("*").alias("n"), F.min(F.struct(*posting)).alias("one")), "classes")
    repeated = rows.join(classes.where("n > 1").select(*key, *same), key + same, "left_semi")
    several = classes.groupBy(*key).agg(F.count("*").alias("classes")).where("classes > 1").select(*key)
    return repeated, classes.join(several, key, "left_semi").select(*key, *same, "one.*")


def repeated_runs(family: SuffixFamily, docs: DataFrame) -> DataFrame:
    """(id, text_hash, first, last) of starts of windows that occur anywhere else, exactly."""
    length, part = family.length, 15
    found, open_ones = _told_apart(family.candidates(), ["key"], ["same"])
    marks = [found.select("id", "text_hash", (F.col("p") - F.col("hi")).alias("first"), (F.col("p") - F.col("lo")).alias("last"))]
    runs_of = open_ones.groupBy("id", "text_hash").agg(F.collect_list(F.struct("p", "lo", "hi")).alias("runs"))
    runs_of = stored(packed(runs_of, family.id_type, "runs"), "open-runs")
    side = sized_lists(runs_of, "runs")
    texts = docs.select("id", F.xxhash64("text").alias("text_hash"), "text").join(side, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    kind = family.id_type

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 500):
            row, ps, los, his, around = [], [], [], [], []
            for i, (text, own) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                data = (text or "").encode()
                for p, lo, hi in np.frombuffer(own, "<i4").reshape(-1, 3).tolist():
                    row.append(i)
                    ps.append(p)
                    los.append(lo)
                    his.append(hi)
                    around.append(data[p - hi:p - lo + length])
            take = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *(pa.array(x, pa.int32()) for x in (ps, los, his)), pa.array(around, pa.binary())],
                                             names=["id", "text_hash", "p", "lo", "hi", "around"])

    # rows with equal id and text would meet themselves
    around = texts.select("id", "text_hash", "text", "runs").mapInArrow(tidy(contexts), f"id {kind}, text_hash bigint, p int, lo int, hi int, around binary")
    around = stored(around.dropDuplicates(["id", "text_hash", "p", "lo"]), "contexts")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ranges of `part` starts: what all their windows share, and all that they cover."""
        for batch in sliced(batches, 2000):
            row, los, his, keys, sames = [], [], [], [], []
            for i, (lo, hi, data) in enumerate(zip(*(batch.column(c).to_pylist() for c in (3, 4, 5)))):
                for j in range(lo // part, hi // part + 1):
                    a, b = j * part, j * part + part
                    least, most = max(a, lo), min(b - 1, hi)
                    row.append(i)
                    los.append(least)
                    his.append(most)
                    keys.append(digest(data[hi - a:hi - b + 1 + length], 2 + j))
                    sames.append(digest(data[hi - most:hi - least + length], 1))
            take = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in (0, 1, 2)), pa.array(los, pa.int32()), pa.array(his, pa.int32()), pa.array(keys, pa.int64()), pa.array(sames, pa.int64())],
                                             names=["id", "text_hash", "p", "lo", "hi", "key", "same"])

    ranges = stored(around.mapInArrow(tidy(parts), POSTING.format(kind)), "ranges")
    found, open_ones = _told_apart(ranges, ["key"], ["same"])
    marks.append(found.select("id", "text_hash", (F.col("p") - F.col("hi")).alias("first"), (F.col("p") - F.col("lo")).alias("last")))
    left = open_ones.select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("p").alias("_p"), F.col("lo").alias("from"), F.col("hi").alias("to"))
    match = around["id"].eqNullSafe(left["_id"]) & (around["text_hash"] == left["_hash"]) & (around["p"] == left["_p"]) & (left["from"] >= around["lo"]) & (left["to"] <= around["hi"])
    single = around.join(left, match).select("id", "text_hash", "p", "hi", "around", "from", "to")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2000):
            row, starts, one, two = [], [], [], []
            for i, (p, hi, data, first, last) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(2, 7)))):
                for back in range(first, last + 1):
                    whole = xxhash.xxh3_128_intdigest(data[hi - back:hi - back + length])
                    row.append(i)
                    starts.append(p - back)
                    one.append(signed(whole >> 64))
                    two.append(signed(whole & ((1 << 64) - 1)))
            take = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(starts, pa.int32()), pa.array(one, pa.int64()), pa.array(two, pa.int64())],
                                             names=["id", "text_hash", "first", "one", "two"])

    each = stored(single.mapInArrow(tidy(windows), f"id {kind}, text_hash bigint, first int, one bigint, two bigint"), "windows")
    twice = each.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two")
    marks.append(each.join(twice, ["one", "two"], "left_semi").select("id", "text_hash", "first", F.col("first").alias("last")))
    out = marks[0]
    for more in marks[1:]:
        out = out.unionByName(more)
    return out


def deduplicated(df: DataFrame, id_col: str, text_col: str, length: int = 400, batches: int = 4, as_text: bool = False) -> DataFrame:
    """All rows and columns, with `kept` (bytes, or with `as_text` text without characters of which a part was cut off), `n_bytes`, `n_removed` and `n_spans`; columns of these names are replaced.

    A byte goes if a string of `length` bytes that covers it starts anywhere else in the input as well, in the same text too.
    Matches do not cross texts and are judged on the input. NULL texts are empty; texts shorter than `length` stay whole;
    repeated rows of at least `length` bytes remove each other; no rows give no rows. The rows come in `batches` parts by hash.
    """
    rows = wrapped(df, id=F.col(id_col), text=F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    docs = rows.select("id", "text")
    family = SuffixFamily(df.sparkSession, docs.schema["id"].dataType.simpleString(), length)
    for b in range(batches):
        family.ingest(docs.where(F.pmod(F.xxhash64("id", F.lit(9)), F.lit(batches)) == b))
    marks = repeated_runs(family, docs)
    starts = marks.groupBy("id", "text_hash").agg(F.collect_set(F.struct("first", "last")).alias("starts"))  # repeated rows mark the same
    spans = sized_lists(stored(packed(starts, family.id_type, "spans", merge=length), "spans"), "spans")
    both = rows.join(spans, F.col("id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left").select("row", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            kept, sizes, removed, counts = [], [], [], []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode()
                at, gone, n, parts = 0, 0, 0, []
                for a, b in np.frombuffer(own or b"", "<i4").reshape(-1, 2).tolist():
                    parts.append(data[at:a])
                    at, gone, n = b, gone + b - a, n + 1
                parts.append(data[at:])
                kept.append("".join([p.decode("utf-8", "ignore") for p in parts]) if as_text else b"".join(parts))
                sizes.append(len(data))
                removed.append(gone)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string() if as_text else pa.binary()), *(pa.array(x, pa.int64()) for x in (sizes, removed, counts))],
                                             names=["row", "kept", "n_bytes", "n_removed", "n_spans"])

    new = ["n_bytes", "n_removed", "n_spans"]
    schema = StructType([rows.schema["row"]]).add("kept", StringType() if as_text else BinaryType())
    for name in new:
        schema = schema.add(name, LongType())
    return unwrapped(both.mapInArrow(tidy(cut), schema), df.columns, **{c: F.col(c) for c in ["kept", *new]})
