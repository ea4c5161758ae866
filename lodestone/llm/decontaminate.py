"""Benchmark decontamination with DataFrame functions only.

The word n-grams of the benchmark form a set that is broadcast after a check of its size. Every window of every document
is hashed and looked up in the set; a hit is verified word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.rows import unwrapped, wrapped
from lodestone.session import stored

#: What separates words after A-Z are lowered, and a word before that.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The set is broadcast up to this many bytes of words; beyond, the windows are shuffled to it by their hash.
BROADCAST_BYTES = 64 << 20


def words(text: str) -> Column:
    """The words of a text column, A-Z lowered; none for NULL.

    Splitting reads a text once; regexp_extract_all copies the whole text for each of its words.
    """
    parts = F.split(F.translate(F.col(text).cast("string"), UPPER, LOWER), BETWEEN_WORDS, -1)
    return F.coalesce(F.array_remove(parts, ""), F.array().cast("array<string>"))


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, n: int) -> DataFrame:
    """(window, items, at, anchor): distinct windows with their items.

    An item of at least `n` words has all its runs of `n` words; a shorter one is a window of its own, which is looked for
    by its longest word, the `at`-th of the window.
    """
    items = benchmark.select(F.col(item_col).alias("item"), words(text_col).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (n - 1), F.lit(1)))
    rows = items.select("item", "w", F.explode(starts).alias("i")).select("item", F.slice("w", F.col("i"), n).alias("window"))
    sets = rows.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
    longest = F.array_max(F.transform("window", lambda w, i: F.struct(F.length(w).alias("n"), (-i).alias("at"), w.alias("w"))))
    return sets.withColumn("at", F.when(F.size("window") < n, 1 - longest["at"])).withColumn("anchor", F.when(F.size("window") < n, longest["w"]))


def find_hits(docs: DataFrame, id_col: str, text_col: str, benchmark: DataFrame, item_col: str, item_text: str, n: int = 10) -> DataFrame:
    """(id, text_hash, spans, items) of the documents that hold a window: maximal spans of hit words, and the items.

    `spans` is an array of (first, end), from 1, the end being the word after the last. Rows with the same id and text are
    one row here. The only shuffle carries hits, of which each task has already put those of a document together.
    """
    windows = stored(benchmark_windows(benchmark, item_col, item_text, n), "windows")
    size = windows.agg(F.sum(F.aggregate("window", F.lit(32), lambda a, w: a + F.octet_length(w) + 16))).first()[0] or 0
    sized = F.broadcast if size <= BROADCAST_BYTES else (lambda df: df)
    long_ones = sized(windows.where(F.size("window") == n).select(F.xxhash64("window").alias("h"), F.col("window").alias("known"), "items"))
    short_ones = sized(windows.where(F.size("window") < n).select("anchor", "at", F.col("window").alias("known"), "items"))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), words(text_col).alias("w"))
    at_each = rows.where(F.size("w") >= n).select("id", "text_hash", "w", F.explode(F.sequence(F.lit(1), F.size("w") - (n - 1))).alias("i"))
    scanned = at_each.select("id", "text_hash", "i", F.slice("w", F.col("i"), n).alias("window")).withColumn("h", F.xxhash64("window"))
    hits = scanned.join(long_ones, "h").where(F.col("window") == F.col("known")).select("id", "text_hash", "i", "known", "items")
    anchored = rows.select("id", "text_hash", "w", F.posexplode("w").alias("p", "anchor")).join(short_ones, "anchor")
    anchored = anchored.withColumn("i", F.col("p") + 2 - F.col("at")).where(F.col("i") >= 1)
    anchored = anchored.where(F.slice("w", F.col("i"), F.size("known")) == F.col("known"))
    hits = hits.unionByName(anchored.select("id", "text_hash", "i", "known", "items"))
    end = F.col("i") + F.size("known")
    found = hits.groupBy("id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct(F.col("i").alias("first"), end.alias("end")))).alias("all"), F.collect_set("items").alias("sets"),
    )
    return found.select("id", "text_hash", _merged("all").alias("spans"), F.array_distinct(F.flatten("sets")).alias("items"))


def _merged(spans: str) -> Column:
    """Overlapping and touching spans of a sorted array as one. An end is where no span reaches across."""
    reach = "array<struct<first:int,end:int>>"

    def join(acc, s):
        last = F.element_at(acc, -1)
        longer = F.array_append(F.slice(acc, 1, F.size(acc) - 1), F.struct(last["first"].alias("first"), F.greatest(last["end"], s["end"]).alias("end")))
        return F.when((F.size(acc) > 0) & (s["first"] <= F.get(acc, F.size(acc) - 1)["end"]), longer).otherwise(F.array_append(acc, s))

    return F.aggregate(spans, F.array().cast(reach), join)


def reported(docs: DataFrame, id_col: str, text_col: str, hits: DataFrame) -> DataFrame:
    """(id, n_words, n_hit, items, contaminated) for every row; `items` sorted as strings, empty for a clean row."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), F.size(words(text_col)).cast("long").alias("n_words"))
    both = _beside(rows, hits)
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["first"]), F.lit(0)).cast("long")
    items = F.array_sort(F.filter(F.coalesce(F.col("items").cast("array<string>"), F.array().cast("array<string>")), lambda x: x.isNotNull()))
    return both.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), items.alias("items"), (n_hit > 0).alias("contaminated"))


def _beside(rows: DataFrame, hits: DataFrame, how: str = "left") -> DataFrame:
    h = hits.select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), "spans", "items")
    return rows.join(h, rows["id"].eqNullSafe(h["_id"]) & (rows["text_hash"] == h["_hash"]), how)


def decontaminate(docs: DataFrame, id_col: str, text_col: str, benchmark: DataFrame, item_col: str, item_text: str, n: int = 10, remove: str = "documents") -> DataFrame:
    """The rows of `docs` without what they share with the benchmark.

    remove="documents" drops the rows with a hit; remove="spans" cuts the hit words and what lies between them out of the
    text and keeps all rows. NULL and empty texts have no words and stay; an empty benchmark changes nothing; repeated rows
    are treated alike; all columns of `docs` stay.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove}")
    hits = find_hits(docs, id_col, text_col, benchmark, item_col, item_text, n)
    hits = hits.select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("spans").alias("_spans"))
    rows = wrapped(docs, id=F.col(id_col), text=F.col(text_col).cast("string"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    if remove == "documents":
        return unwrapped(rows.join(hits, same, "left_anti"), docs.columns)
    both = rows.join(hits, same, "left")
    both = both.withColumn("_w", F.when(F.col("_spans").isNotNull(), F.regexp_extract_all("text", F.lit(WORD_ANY_CASE), F.lit(0))))
    both = both.withColumn("_between", F.when(F.col("_spans").isNotNull(), F.split("text", WORD_ANY_CASE, -1)))
    hit = lambda i: F.exists("_spans", lambda s: (s["first"] <= i) & (i < s["end"]))
    inside = lambda i: F.exists("_spans", lambda s: (s["first"] <= i) & (i + 1 < s["end"]))
    parts = F.transform("_w", lambda w, i: F.concat(F.when(hit(i + 1), "").otherwise(w), F.when(inside(i + 1), "").otherwise(F.get("_between", i + 1))))
    cut = F.concat(F.get("_between", F.lit(0)), F.array_join(parts, ""))
    changed = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(cut)
    return unwrapped(both, docs.columns, **{text_col: changed}).select(*docs.columns)
