"""Text processing in long form: (document, position, token) rows and (document, term, tf) rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel, NGram, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.ordered import broadcast_if_small, top_per_group, with_group_values, with_row_number
from lodestone.session import spread, stored

# The custom stop-word list of the cleaning chain.
STOP_WORDS = [
    "the", "a", "an", "of", "or", "in", "for", "by", "on", "but", "is", "not", "with", "as", "was", "if",
    "they", "are", "this", "and", "it", "have", "from", "at", "my", "be", "that", "to",
]


def whitespace_tokens(df: DataFrame, text: str, name: str) -> DataFrame:
    """Lower-cased tokens between single white-space characters."""
    return Tokenizer(inputCol=text, outputCol=name).transform(df)


def word_tokens(df: DataFrame, text: str, name: str) -> DataFrame:
    """Lower-cased runs of ASCII word characters; none for a NULL text."""
    tokens = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "\\W+"), lambda x: x != "")
    return df.withColumn(name, tokens)


def token_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per token: key, position, token.

    The outer form with a filter behind it keeps Spark from splitting the text once more in a filter before it.
    """
    rows = word_tokens(spread(df.select(key, text)), text, "_tokens")
    return rows.select(key, F.posexplode_outer("_tokens").alias("pos", "token")).where("token IS NOT NULL")


def no_digits(token: Column) -> Column:
    return ~token.rlike("[0-9]")


def clean_token(token: Column, stop_words: Sequence[str] = tuple(STOP_WORDS), length: int = 2) -> Column:
    """Tokens without digits, not on the stop list, of at least ``length`` characters."""
    return no_digits(token) & ~token.isin(*stop_words) & (F.length(token) >= length)


def token_counts(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def common_tokens(tokens: DataFrame, least: int = 2) -> DataFrame:
    """Tokens that occur at least ``least`` times in all documents."""
    return token_counts(tokens).where(F.col("n") >= least)


def clean_documents(df: DataFrame, key: str, text: str) -> DataFrame:
    """The full chain per document: tokenize, clean, drop rare tokens; tokens keep their order.

    Positions are put together per (document, token) first, so a frequent token is one row per document, and the text is
    tokenized once. Every document stays, with an empty list if nothing is left of it.
    """
    tokens = token_rows(df, key, text).where(clean_token(F.col("token")))
    places = stored(tokens.groupBy(key, "token").agg(F.collect_list("pos").alias("at")), "places")
    rare = places.groupBy("token").agg(F.sum(F.size("at")).alias("n")).where("n < 2").select("token")
    common = places.join(rare, "token", "left_anti").select(key, F.explode("at").alias("pos"), "token")
    ordered = common.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("_rows"))
    lists = ordered.select(F.col(key).alias("_key"), F.transform("_rows", lambda r: r["token"]).alias("tokens"))
    every = df.select(key).join(lists, F.col(key).eqNullSafe(F.col("_key")), "left")
    return every.select(key, F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"))


def term_frequencies(tokens: DataFrame, key: str) -> DataFrame:
    return tokens.groupBy(key, F.col("token").alias("term")).agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(tf: DataFrame, key: str, size: int, least_documents: int = 1) -> DataFrame:
    """The most frequent terms, numbered from 0; ties in alphabetical order."""
    totals = tf.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
    top = totals.where(F.col("df") >= least_documents).orderBy(F.col("total").desc(), "term").limit(size)
    numbered = with_row_number(top, [], [F.col("total").desc(), F.col("term")], "_n")
    return numbered.select("term", (F.col("_n") - 1).alias("idx"))


def count_cells(tf: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """(key, idx, tf) cells of the count matrix for a vocabulary."""
    return tf.join(words, "term").select(key, "idx", "tf")


def count_vectors(df: DataFrame, tokens: str, name: str, words: Sequence[str]) -> DataFrame:
    """Sparse count vectors for a given vocabulary."""
    model = CountVectorizerModel.from_vocabulary(list(words), inputCol=tokens, outputCol=name)
    return model.transform(df)


def hashed_counts(tokens: DataFrame, key: str, slots: int) -> DataFrame:
    """(key, slot, n): tokens counted by the first 32 bits of their MD5, modulo the number of slots."""
    slot = F.conv(F.substring(F.md5("token"), 1, 8), 16, 10).cast("bigint") % slots
    return tokens.groupBy(key, slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))


def ngrams(df: DataFrame, tokens: str, n: int, name: str) -> DataFrame:
    """Runs of n tokens; empty when there are fewer."""
    return NGram(n=n, inputCol=tokens, outputCol=name).transform(df)


def clean_frequencies(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf, total, df) of the cleaned tokens, terms that occur only once dropped.

    Counting per document comes first; the corpus totals are sums over those counts, so the
    text is tokenized once and a frequent term is one row per document.
    """
    tokens = token_rows(df, key, text)
    tf = stored(term_frequencies(tokens.where(clean_token(F.col("token"))), key), "tf")
    return with_group_values(tf, ["term"], total=F.sum("tf"), df=F.count(F.lit(1))).where(F.col("total") >= 2)


def tf_idf(frequencies: DataFrame, documents: int) -> DataFrame:
    """Add the weight tf * ln((documents + 1) / (df + 1)) of each (document, term)."""
    idf = F.log((F.lit(documents) + 1) / (F.col("df") + 1))
    return frequencies.withColumn("weight", F.col("tf") * idf)


def pair_cosine(weights: DataFrame, key: str, pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Cosine of the weight vectors of given document pairs.

    The pairs table says which documents meet, so the work grows with the pairs and their
    lengths, never with all documents that share a term. A document without terms has cosine 0.
    """
    norms = weights.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    cells = pairs.select(left, right).join(weights.select(F.col(key).alias(left), "term", "weight"), left)
    other = weights.select(F.col(key).alias(right), "term", F.col("weight").alias("_other"))
    dots = cells.join(other, [right, "term"]).groupBy(left, right).agg(F.sum(F.col("weight") * F.col("_other")).alias("dot"))
    return (
        pairs.join(dots, [left, right], "left")
        .join(norms.select(F.col(key).alias(left), F.col("norm").alias("_a")), left, "left")
        .join(norms.select(F.col(key).alias(right), F.col("norm").alias("_b")), right, "left")
        .withColumn("cosine", F.coalesce(F.try_divide("dot", F.col("_a") * F.col("_b")), F.lit(0.0)))
        .drop("dot", "_a", "_b")
    )


def heaviest_terms(weights: DataFrame, key: str, n: int) -> DataFrame:
    return top_per_group(weights, [key], [F.col("weight").desc(), F.col("term")], n, "place")


def classified(tf: DataFrame, labels: DataFrame, key: str, smoothing: float) -> DataFrame:
    """(key, actual, predicted) of the rows of `labels` (key, actual, train) that are not for training.

    Multinomial naive Bayes over TF-IDF weights; inverse document frequencies come from the training rows, and terms they lack
    are left out. A score is prior + sum of weight * log likelihood: every class takes the mass of the document times the
    likelihood of an unseen term, and a (document, class) pair the rest for the terms that the class has. Classes are few; of
    equal scores the first class by name wins.
    """
    train = stored(labels.where("train").select(key, "actual"), "train")
    documents = train.count()
    seen = tf.join(train.select(key), key).groupBy("term").agg(F.log((F.lit(documents) + 1.0) / (F.count(F.lit(1)) + 1)).alias("idf"))
    weights = stored(tf.join(seen, "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("x")), "weights")
    sums = stored(weights.join(train, key).groupBy("actual", "term").agg(F.sum("x").alias("sum")), "sums")
    size = sums.agg(F.count_distinct("term")).first()[0]
    classes = sums.groupBy("actual").agg(F.log(F.sum("sum") + smoothing * size).alias("z")).join(train.groupBy("actual").agg(F.log(F.count(F.lit(1))).alias("prior")), "actual")
    classes = broadcast_if_small(stored(classes.withColumnRenamed("actual", "class"), "classes"))  # one row per class
    asked = labels.where("NOT train").select(key, "actual")
    mass = weights.groupBy(key).agg(F.sum("x").alias("mass"))
    unseen = float(math.log(smoothing))
    gain = F.col("x") * (F.log(F.col("sum") + smoothing) - unseen)
    hits = weights.join(asked.select(key), key).join(sums.withColumnRenamed("actual", "class"), "term").groupBy(key, "class").agg(F.sum(gain).alias("gain"))
    every = asked.join(mass, key, "left").join(classes).join(hits, [key, "class"], "left")
    score = F.round(F.col("prior") + F.coalesce("mass", F.lit(0.0)) * (unseen - F.col("z")) + F.coalesce("gain", F.lit(0.0)), 6)
    best = every.groupBy(key, "actual").agg(F.min_by("class", F.struct((-score).alias("s"), "class")).alias("predicted"))
    return best.select(key, "actual", "predicted")
