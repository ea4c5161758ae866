"""Byte-level BPE as a transducer that is determinised while it reads, and decoding of id streams.

The encoding of a piece is the only sequence of tokens in which every neighbouring pair is stable, that is, in which no
merge across the border would have been made before the merges inside. So the token written last is all that the next one
depends on besides the bytes ahead, and the merges never have to be replayed over a text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.pieces import PIECES, WHITE, PieceMemory
from lodestone.llm.rows import sliced, tidy

START = -1
NEVER = 1 << 60


class Merges:
    """The ranks of a vocabulary as a trie, and which pairs of neighbouring tokens are stable."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.halves = {rank: self._halves(token) for token, rank in ranks.items()}
        self.child: dict[int, int] = {}  # node << 8 | byte
        self.token = [START]  # by node
        self.parent = [0]
        self.size = {rank: len(token) for token, rank in ranks.items()}
        for token, rank in ranks.items():
            if len(token) > 1 and self.halves[rank] is None:
                continue  # no merges lead to it; it only ever stands for a whole piece
            node = 0
            for byte in token:
                below = self.child.setdefault(node << 8 | byte, len(self.token))
                if below == len(self.token):
                    self.token.append(START)
                    self.parent.append(node)
                node = below
            self.token[node] = rank

    def _halves(self, token: bytes) -> tuple[int, int] | None:
        """The two tokens whose merge gives this one, found by plain merging, lowest rank first, until two are left."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            found = [self.ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            best = found.index(min(found))
            if found[best] == NEVER:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def stable(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives these two tokens again.

        The merges of both sides are taken back, latest first, with a look at the border before each of them.
        """
        later = NEVER  # the merge at the border would have to come before this one
        while True:
            across = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if across is not None and across < later:
                return False
            a, b = self.halves[left], self.halves[right]
            if a is None and b is None:
                return True
            # of equal ranks the left one is merged first, so the right one is undone first
            if b is None or (a is not None and left > right):
                later, left = left, a[1]
            else:
                later, right = right + 1, b[0]


class Transducer:
    """Bytes in, tokens out.

    A state is the token written last; an arc reads ahead to the longest token that can start here, never further than the
    longest token of the vocabulary, and writes one of its prefixes. The arc's outputs, longest first, are those that are
    stable beside the state's token. Arcs are determined when first needed and kept, `limit` of them at most.
    """

    def __init__(self, merges: Merges, limit: int = 150_000):
        self.merges = merges
        self.limit = limit
        self.longest = max(map(len, merges.ranks))
        self.arcs: dict[int, tuple[int, ...]] = {}

    def _arc(self, last: int, node: int) -> tuple[int, ...]:
        """The tokens on the way to a node of the trie that may follow `last`, longest first."""
        out, merges = [], self.merges
        while node:
            token = merges.token[node]
            if token != START and (last == START or merges.stable(last, token)):
                out.append(token)
            node = merges.parent[node]
        return tuple(out)

    def encode(self, data: bytes) -> list[int]:
        """The tokens of one piece. Where no token may follow, the one before is taken back for its next shorter choice."""
        whole = self.merges.ranks.get(data)
        if whole is not None:
            return [whole]
        arcs, below_of, size, longest = self.arcs, self.merges.child.get, self.merges.size, self.longest
        if len(arcs) > self.limit:
            arcs.clear()
        n, at, last = len(data), 0, START
        tokens: list[int] = []
        choices: list[tuple[tuple[int, ...], int]] = []
        dead: set[int] | None = None
        while at < n:
            node = 0
            for byte in data[at:at + longest]:
                below = below_of(node << 8 | byte)
                if below is None:
                    break
                node = below
            key = last << 32 | node
            arc = arcs.get(key)
            if arc is None:
                arc = arcs[key] = self._arc(last, node)
            if arc and not dead:  # as nearly always
                last = arc[0]
                tokens.append(last)
                choices.append((arc, 0))
                at += size[last]
                continue
            pick = 0
            while pick >= len(arc) or (dead and at + size[arc[pick]] in dead):
                if pick < len(arc):
                    pick += 1
                    continue
                dead = dead or set()
                dead.add(at)  # the tokens before a place are the same on all ways, so the place itself leads nowhere
                at -= size[tokens.pop()]
                arc, pick = choices.pop()
                pick += 1
            token = arc[pick]
            tokens.append(token)
            choices.append((arc, pick))
            at += size[token]
            last = token
        return tokens


class StreamDecoder:
    """Ids in, text out: whole characters are given back, the bytes of an unfinished one wait for the next call."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.take = bytes_of.__getitem__
        self.waiting = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end belong to a character that is not complete."""
        for back in range(1, min(4, len(data) + 1)):
            byte = data[-back]
            if byte >= 0xC0:  # first byte of a character of 2, 3 or 4 bytes
                size = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if back < size else 0
            if byte < 0x80:
                return 0
        return 0

    def feed(self, ids: Iterable[int]) -> str:
        data = self.waiting + b"".join(map(self.take, ids))
        cut = len(data) - self.unfinished(data)
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", "replace")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> tuple[PieceMemory, Transducer]:
    """The memory of pieces as little-endian 32-bit ids, and the transducer behind it."""
    import regex

    transducer = Transducer(Merges(read_ranks(path)))
    # \s of the pattern means White_Space
    own = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
    matches = regex.compile(own).findall

    def encode_all(pieces: list[str]) -> list[bytes]:
        out = []
        for piece in pieces:
            ids: list[int] = []
            if piece.isascii() and piece.lstrip(" ").isalpha():
                ids = transducer.encode(piece.encode())  # one match of any such pattern
            else:
                for match in matches(piece):
                    ids += transducer.encode(match.encode())
            out.append(np.array(ids, "<i4").tobytes())
        return out

    return PieceMemory(PIECES, encode_all, limit=300_000), transducer


@lru_cache(maxsize=2)
def _decoder(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(path).items()}


def encode_text(text: str, path: str, pattern: str) -> np.ndarray:
    return np.frombuffer(b"".join(_encoder(path, pattern)[0].of(text)), "<i4")


def encode(df: DataFrame, id_col: str, text_col: str, path: str, pattern: str) -> DataFrame:
    """(id, ids array<int>) for every row; NULL and empty texts give an empty array.

    No shuffle. Each match of `pattern` is encoded alone and special strings are ordinary text. Texts are cut at white
    space, so one of any length needs memory for its own bytes and ids only. Other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches, 512):  # ids take more room than their text
            found = [encode_text(t, path, pattern) if t else np.empty(0, "<i4") for t in rows.column(1).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(f) for f in found], dtype="i8")]).astype("i4")
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([rows.column(0), ids], names=["id", "ids"])
        memory, transducer = _encoder(path, pattern)
        memory.forget()
        transducer.arcs.clear()

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, id_col: str, path: str, chunk: int = 4096) -> DataFrame:
    """(id, ids, text) for every row of (id, ids): the ids are read `chunk` at a time by the streaming decoder.

    An empty or NULL array gives an empty text; bytes that are no UTF-8 become U+FFFD, as in any stream.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = _decoder(path)
        for rows in sliced(batches, 512):
            texts = []
            for ids in rows.column(1):
                values = ids.values.to_numpy(zero_copy_only=False) if ids.is_valid else np.empty(0, "<i4")
                stream = StreamDecoder(bytes_of)
                texts.append("".join([stream.feed(values[i:i + chunk].tolist()) for i in range(0, len(values), chunk)]) + stream.finish())
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(texts, pa.string())], names=["id", "ids", "text"])

    rows = df.select(F.col(id_col).alias("id"), "ids")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"id {kind}, ids array<int>, text string").withColumnRenamed("id", id_col)
