"""Files of token ids: fixed-size blocks transposed into bit or byte planes, each plane compressed with zstandard.

A file is: MAGIC; the planes of all blocks; the chunk index, a table of (offset, ids, bytes of each plane); the document
index, an Arrow stream of (id, start, n_tokens) with starts inside the file; a trailer of fixed size with the place of
both. A block can be read alone: seek to its offset and undo its planes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.pieces import WORDS, LibraryMemory
from lodestone.session import scratch_path, stored

MAGIC = b"LSPLANE1"
TRAILER = struct.Struct("<QQQQQQ8s")  # chunk index: offset, bytes; document index: offset, bytes; bits; ids; MAGIC
BLOCK = 1 << 16


def to_planes(ids: np.ndarray, bits: int, unit: int) -> list[bytes]:
    """The bytes of each plane of a block: `unit` 1 for bit planes, 8 for byte planes; `bits` is a multiple of `unit`."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if unit == 8:
        return [octets[:, k].tobytes() for k in range(bits // 8)]
    flags = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(flags[:, k]).tobytes() for k in range(bits)]


def from_planes(planes: list[bytes], n: int, unit: int) -> np.ndarray:
    if unit == 8:
        octets = np.zeros((n, 4), np.uint8)
        for k, plane in enumerate(planes):
            octets[:, k] = np.frombuffer(plane, np.uint8)
        return octets.view("<u4").reshape(-1)
    flags = np.zeros((n, 32), np.uint8)
    for k, plane in enumerate(planes):
        flags[:, k] = np.unpackbits(np.frombuffer(plane, np.uint8), count=n)
    return np.packbits(flags, axis=1, bitorder="little").view("<u4").reshape(-1)


class Writer:
    """Takes documents in order; holds one block of ids and the document index."""

    def __init__(self, out, bits: int, unit: int, block: int = BLOCK):
        self.out, self.bits, self.unit, self.block = out, bits, unit, block
        self.press = zstandard.ZstdCompressor(level=3)
        self.chunks: list[list[int]] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.at = len(MAGIC)
        out.write(MAGIC)

    def add(self, ids: np.ndarray) -> int:
        """The place of the first id inside the file."""
        start = self.n_ids
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block:
            self._flush(whole=False)
        return start

    def _flush(self, whole: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, "<u4")
        end = len(ids) if whole else len(ids) // self.block * self.block
        for i in range(0, end, self.block):
            part = ids[i:min(i + self.block, end)]
            packed = [self.press.compress(p) for p in to_planes(part, self.bits, self.unit)]
            self.chunks.append([self.at, len(part), *map(len, packed)])
            self.out.write(b"".join(packed))
            self.at += sum(map(len, packed))
        self.waiting, self.n_waiting = [ids[end:]], len(ids) - end

    def finish(self, documents: pa.Table) -> int:
        """Writes both indexes; the bytes of the file."""
        self._flush(whole=True)
        chunks = np.array(self.chunks, "<i8").tobytes()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, documents.schema) as stream:
            stream.write_table(documents)
        index = self.press.compress(sink.getvalue().to_pybytes())
        self.out.write(chunks + index + TRAILER.pack(self.at, len(chunks), self.at + len(chunks), len(index), self.bits // self.unit, self.n_ids, MAGIC))
        return self.at + len(chunks) + len(index) + TRAILER.size


class Reader:
    """Reads the indexes of a file, then any of its chunks."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        file.seek(size - TRAILER.size)
        at, n_at, docs, n_docs, self.planes, self.n_ids, magic = TRAILER.unpack(file.read(TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a file of token planes")
        file.seek(at)
        self.chunks = np.frombuffer(file.read(n_at), "<i8").reshape(-1, 2 + self.planes)
        file.seek(docs)
        self.press = zstandard.ZstdDecompressor()
        self.documents = pa.ipc.open_stream(self.press.decompress(file.read(n_docs))).read_all()

    def chunk(self, k: int, unit: int) -> np.ndarray:
        at, n, *sizes = map(int, self.chunks[k])
        self.file.seek(at)
        return from_planes([self.press.decompress(self.file.read(s)) for s in sizes], n, unit)

    def ids(self, unit: int) -> Iterator[tuple[int, list[np.ndarray]]]:
        """For each document its row in the document index and its ids in parts, one chunk in memory at a time."""
        k, part, used = 0, np.empty(0, "<u4"), 0
        for row, n in enumerate(self.documents.column("n_tokens").to_pylist()):
            def parts(n=n):
                nonlocal k, part, used
                while n:
                    if used == len(part):
                        part, used, k = self.chunk(k, unit), 0, k + 1
                    take = part[used:used + n]
                    used, n = used + len(take), n - len(take)
                    yield take
            yield row, parts()


@lru_cache(maxsize=2)
def _word_encoder(path: str) -> LibraryMemory:
    return LibraryMemory(path, WORDS, lambda e: struct.pack(f"<{len(e.ids)}I", *e.ids), limit=800_000)


def encode_texts(texts: list[str], path: str) -> list[np.ndarray]:
    """The ids of whole texts by a vocabulary that drops white space."""
    return [np.frombuffer(b"".join(pieces), "<u4") for pieces in _word_encoder(path).of_many(texts)]


def _opened(uri: str):
    """The file system of a folder that all executors share, and the path in it."""
    return fs.FileSystem.from_uri(uri)


def write(df: DataFrame, id_col: str, text_col: str, path: str, end_id: int, bits: int = 16, unit: int = 8, folder: str | None = None) -> DataFrame:
    """Write all texts in ascending id order; the manifest (file, uri, n_docs, n_ids, n_bytes, first_id), stored.

    One shuffle deals the rows by ranges of (id, hash of the text), so an id that comes very often is dealt out too; file k
    holds the k-th range. A task writes to a name of its own attempt and renames it at the end, so one that is run again
    replaces its file. NULL ids come first, NULL texts are empty and have the end id only; no rows make no files.
    """
    spark = df.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    if bits % unit or bits > 32:
        raise ValueError("bits must be a multiple of unit, 32 at most")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number, attempt = context.partitionId(), context.taskAttemptId()
        out = writer = None
        system, base = _opened(folder)
        end, ids, starts, sizes = np.array([end_id], "<u4"), [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(base, recursive=True)
                out = system.open_output_stream(f"{base}/part-{number:06d}.{attempt}.tmp")
                writer = Writer(out, bits, unit)
            ids.append(batch.column(0))
            for part in range(0, batch.num_rows, 64):
                for encoded in encode_texts([t or "" for t in batch.column(1).slice(part, 64).to_pylist()], path):
                    tokens = np.concatenate([encoded, end])
                    if int(tokens.max()) >> bits:
                        raise ValueError(f"an id does not fit {bits} bits")
                    starts.append(writer.add(tokens))
                    sizes.append(len(tokens))
        if writer is None:
            return
        documents = pa.table({"id": pa.chunked_array(ids), "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(sizes, pa.int64())})
        n_bytes = writer.finish(documents)
        out.close()
        system.move(f"{base}/part-{number:06d}.{attempt}.tmp", f"{base}/part-{number:06d}.planes")
        row = [[number], [f"{folder}/part-{number:06d}.planes"], [len(sizes)], [writer.n_ids], [n_bytes]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], names=["file", "uri", "n_docs", "n_ids", "n_bytes"])

    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("h", F.xxhash64("text")).repartitionByRange(files, "id", "h").sortWithinPartitions("id", "h").select("id", "text")
    manifest = stored(dealt.mapInArrow(run, "file bigint, uri string, n_docs bigint, n_ids bigint, n_bytes bigint"), "manifest")
    return manifest.select("*", F.lit(unit).alias("unit"), F.lit(kind).alias("id_type"))


def read(manifest: DataFrame, id_type: str, digest: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids or ids_crc32) of every document, from the files of a manifest.

    `start` counts the ids of all documents before, over all files. With `digest` the crc32 of the ids as little-endian
    unsigned 32-bit integers is given instead of the ids, and no document is held whole.
    """
    # one row per file: their number is that of the tasks that wrote them
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("uri", "unit", before.cast("long").alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, unit, base in zip(*(batch.column(c).to_pylist() for c in range(3))):
                system, place = _opened(uri)
                with system.open_input_file(place) as file:
                    reader = Reader(file)
                    rows, found = [], []
                    for row, parts in reader.ids(unit):
                        if digest:
                            crc = 0
                            for part in parts:
                                crc = zlib.crc32(part.tobytes(), crc)
                            found.append(crc)
                        else:
                            found.append(np.concatenate([*parts, np.empty(0, "<u4")]).astype("i8"))
                        rows.append(row)
                        if len(rows) == 1000:
                            yield _batch(reader, rows, found, base, digest)
                            rows, found = [], []
                    if rows:
                        yield _batch(reader, rows, found, base, digest)

    last = "ids_crc32 bigint" if digest else "ids array<bigint>"
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(n, "uri").mapInArrow(run, f"id {id_type}, start bigint, n_tokens bigint, {last}")


def _batch(reader: Reader, rows: list[int], found: list, base: int, digest: bool) -> pa.RecordBatch:
    docs = reader.documents.slice(rows[0], len(rows)).combine_chunks()
    starts = pa.array(docs.column("start").to_numpy() + base, pa.int64())
    last = pa.array(found, pa.int64()) if digest else pa.array(found, pa.list_(pa.int64()))
    ids, sizes = (docs.column(c).combine_chunks() for c in ("id", "n_tokens"))
    return pa.RecordBatch.from_arrays([ids, starts, sizes, last], names=["id", "start", "n_tokens", "ids_crc32" if digest else "ids"])
