"""Token counts of whole texts, with the tokenizer run in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.pieces import PIECES, LibraryMemory


@lru_cache(maxsize=2)
def _tokenizers_counter(path: str):
    memory = LibraryMemory(path, PIECES, len)
    return lambda texts: [sum(pieces) for pieces in memory.of_many(texts)]


@lru_cache(maxsize=2)
def _sentencepiece_counter(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]


def counter(path: str):
    """The function list of texts -> numbers of tokens for a vocabulary file, one per worker.

    A `.json` file must cut before white space, as byte-level vocabularies do; a `.model` file gets each text whole, since
    its normaliser may look across white space.
    """
    return _sentencepiece_counter(path) if path.endswith(".model") else _tokenizers_counter(path)


def with_token_counts(df: DataFrame, id_col: str, text_col: str, path: str, limit: int) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row: UTF-8 bytes, tokens, and whether the tokens exceed `limit`.

    No shuffle: each Arrow batch, which Spark bounds in bytes, is cut into pieces at safe boundaries; pieces not seen
    before are encoded in lists of equal size. NULL and empty texts have 0 bytes and 0 tokens. Repeated rows stay repeated;
    other columns are left out, whatever their names.
    """

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts.cast(pa.binary())), 0).cast(pa.int64())
            tokens = pa.array([n for part in range(0, len(texts), 64) for n in count([t or "" for t in texts.slice(part, 64).to_pylist()])], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, tokens], names=["id", "n_bytes", "n_tokens"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(lengths, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
