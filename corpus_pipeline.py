"""A corpus pipeline over `documents`: each stage works on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import bpe, decontaminate, jaccard, suffix_index, toxicity
from lodestone.llm.rows import small_batches
from lodestone.session import Tables, stored


def numbered_columns(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """The table with its columns named by their place, and the new names of `doc_id` and `text`: nothing clashes with an operator's own columns."""
    names = [f"column_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names[docs.columns.index("doc_id")], names[docs.columns.index("text")]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold of their language; fitted on the labels that are not held out.

    NULL and empty texts are scored as texts without words, a NULL language takes the general threshold, repeated rows are
    judged alike, long texts are read whole, and no documents give none. All columns are kept, whatever their names.
    """
    tables = Tables(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = toxicity.train(tables.documents, tables.labels.where(~held_out))
    rows, _, text = numbered_columns(docs)
    lang = rows.columns[docs.columns.index("lang")]
    scored = toxicity.with_scores(rows.withColumn("lang", F.col(lang)), text, "lang", model)
    return scored.where(~F.col("toxic_flag")).select(*rows.columns).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id.

    Rows without words (NULL and empty texts among them) all stay; of rows with equal id and text one stays; NULL ids come
    before all others. Long texts are compared whole; no documents give none; all columns are kept, whatever their names.
    """
    return jaccard.without_near_duplicates(docs, "doc_id", "text", n=5, threshold=0.8)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 400-byte strings that come more than once; a text of which nothing is left goes.

    A NULL text stays NULL and an empty one empty; repeated rows of 400 bytes or more cut each other, so nothing of them is
    left; texts of any length are cut whole; no documents give none. Of the columns only `text` and `n_chars` change.
    """
    rows, key, text = numbered_columns(docs)
    cut = suffix_index.deduplicated(rows, key, text, length=400, as_text=True)
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    now = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col(text))
    new = {"text": now, "n_chars": F.length(now).cast("long")}
    return left.select(*[new.get(name, F.col(c)).alias(name) for name, c in zip(docs.columns, rows.columns)])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of the benchmark.

    NULL and empty texts have no words and stay, as do all documents if the benchmark is empty; repeated rows are judged
    alike; long texts are searched whole; no documents give none. All columns are kept, whatever their names.
    """
    return decontaminate.decontaminate(docs, "doc_id", "text", Tables(spark, sf_dir).benchmark, "item_id", "text", n=10, remove="documents")


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count, digest of the ids and round trip of every document that is left.

    NULL and empty texts have no tokens and the digests of nothing; repeated rows stay repeated, NULL ids stay NULL; long texts
    are encoded whole; no documents give none. Other columns are left out, whatever their names.
    """
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = stored(bpe.encode(docs, "doc_id", "text", path, public_tokenizers.PATTERN), "ids")  # else encoders and decoders are held at once
    back = bpe.decode(ids, "doc_id", path)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage with small Arrow batches."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", in_small_batches(drop_toxic)),
    ("near_duplicates", in_small_batches(drop_near_duplicates)),
    ("repeated_strings", in_small_batches(cut_repeats)),
    ("decontamination", in_small_batches(drop_contaminated)),
    ("encoding", in_small_batches(encode_texts)),
]

#: A trained classifier, a similarity join and byte-pair merges are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result stored and read again."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
