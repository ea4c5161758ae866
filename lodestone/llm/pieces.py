"""Splitting of texts at boundaries that no tokenizer pattern crosses, and a bounded memory of what pieces encode to.

Before white space, and after a run of letters that ends at ASCII punctuation, the patterns of the supported vocabularies
always cut. A text may therefore be encoded piece by piece, whatever its length, and a piece that comes again need not be
encoded again.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: The characters with the Unicode property White_Space, as the body of a character class.
WHITE = "\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"

#: Latin letters (not U+0130, whose lower case ends with a mark), and what may follow a run of them without being joined to it by a pattern or a normaliser.
LATIN = "A-Za-z\\xC0-\\xD6\\xD8-\\xF6\\xF8-\\u012F\\u0131-\\u024F"
BREAK = f"(?=[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F{WHITE}]|\\Z)"

#: A run of letters, or else all up to white space, with the one space before it; of other white space, all but the last
#: character goes alone.
PIECES = re.compile(f" ?[{LATIN}]+{BREAK}| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: The same without white space, for vocabularies that drop it.
WORDS = re.compile(f"[{LATIN}]+{BREAK}|[^{WHITE}]+")

#: Longer pieces are encoded each time, so that a few of them cannot fill the memory.
LONGEST_KEPT = 64


class PieceMemory:
    """What `encode_all(list of pieces)` gives for each piece; forgets everything when it holds `limit` pieces."""

    def __init__(self, pattern: re.Pattern, encode_all: Callable[[list[str]], list], limit: int = 300_000, batch_chars: int = 1 << 20):
        self.split = pattern.findall
        self.encode_all = encode_all
        self.limit = limit
        self.batch_chars = batch_chars
        self.known: dict[str, object] = {}

    def _batches(self, pieces: list[str]):
        """Lists of pieces with about as many characters each."""
        batch, chars = [], 0
        for piece in pieces:
            batch.append(piece)
            chars += len(piece)
            if chars >= self.batch_chars:
                yield batch
                batch, chars = [], 0
        if batch:
            yield batch

    def forget(self) -> None:
        """Give the memory back, as a worker that has finished its rows may go on to other work."""
        self.known.clear()

    def of(self, text: str) -> list:
        """The encoded pieces of a whole text, in order."""
        return self.of_many([text])[0]

    def of_many(self, texts: list[str]) -> list[list]:
        """The same for several texts, whose new pieces are encoded together."""
        pieces = [self.split(t) for t in texts]
        known = self.known
        fresh = list(set().union(*pieces).difference(known))
        if fresh:
            if len(known) + len(fresh) > self.limit:
                known.clear()
                fresh = list(set().union(*pieces))
            for batch in self._batches(fresh):
                known.update(zip(batch, self.encode_all(batch)))
        out = [list(map(known.__getitem__, p)) for p in pieces]
        for piece in fresh:
            if len(piece) > LONGEST_KEPT:
                del known[piece]
        return out


class LibraryMemory:
    """The memory over a file of the tokenizers library; `result` is what is kept of an encoding.

    Special strings are cut out first, as the library does; what stands before one ends there.
    """

    def __init__(self, path: str, pattern: re.Pattern, result: Callable, limit: int = 300_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        special = tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word for t in special):
            raise ValueError("special tokens that take white space or words around them are not supported")
        self.marks = re.compile("(" + "|".join(re.escape(t.content) for t in sorted(special, key=lambda t: -len(t.content))) + ")") if special else None
        self.memory = PieceMemory(pattern, lambda batch: [result(e) for e in tokenizer.encode_batch_fast(batch, add_special_tokens=False)], limit)

    def of_many(self, texts: list[str]) -> list[list]:
        if self.marks is None or not any(map(self.marks.search, texts)):
            return self.memory.of_many(texts)
        return [[x for part in self.marks.split(t) if part for x in self.memory.of(part)] for t in texts]
