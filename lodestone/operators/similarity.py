"""Similar columns of a sparse matrix by sampled co-ratings, then exact dot products of the pairs that were met.

Each entry is divided by the norm of its column, so that the cosine of two columns is the sum over the rows of x * y. A row of
entries draws pairs of them with a rate of `rate * x * y`: every entry draws partners, by the hash of its keys, in proportion
to its weight and the row's weight, and a partner is the entry whose interval of the row's running weight holds the drawn
point. A pair with cosine c is met rate * c times on average, wherever its weight lies, and the number of draws is that of the
similarity there is, not that of the pairs in a row: a row of a million entries costs its draws only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.ordered import with_group_values, with_running
from lodestone.session import stored

#: Meetings that make a pair a candidate.
LEAST_HITS = 3
#: Entries of a row in one cell of its grid, on average.
CELL = 32


def sampling_rate(threshold: float, miss: float, hits: int = LEAST_HITS) -> float:
    """The rate at which a pair at the threshold is met fewer than `hits` times with a chance of at most `miss`.

    Meetings are independent rare events, so their number is at least as concentrated as a Poisson number of that mean.
    """

    def below(mean: float) -> float:
        return math.exp(-mean) * sum(mean**k / math.factorial(k) for k in range(hits))

    low, high = 0.0, 1.0
    while below(high) > miss:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) > miss else (low, middle)
    return high / threshold


def _uniform(*keys: Column) -> Column:
    """A number in [0, 1) that depends on the keys only."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11) / F.lit(float(1 << 53))


def unit_columns(ratings: DataFrame, user: str, item: str, value: str) -> DataFrame:
    """(u, i, x): the entries divided by the norm of their column, stored; zeros and NULLs are left out."""
    cells = ratings.select(F.col(user).alias("u"), F.col(item).alias("i"), F.col(value).cast("double").alias("v")).where("u IS NOT NULL AND i IS NOT NULL AND v <> 0")
    norms = cells.groupBy("i").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    return stored(cells.join(norms, "i").select("u", "i", (F.col("v") / F.col("norm")).alias("x")), "unit")


def sampled_pairs(unit: DataFrame, rate: float, seed: int = 0) -> DataFrame:
    """(a, b, hits): how often the columns a < b of (u, i, x) were drawn together; `hits / rate` estimates their cosine."""
    rows = with_running(unit.withColumn("w", F.abs("x")), ["u"], ["i"], {"high": ("sum", F.col("w"))})
    rows = with_group_values(rows, ["u"], total=F.sum("w"), n=F.count(F.lit(1)))
    rows = stored(rows.withColumns({"cells": F.ceil(F.col("n") / CELL), "scale": F.ceil(F.col("n") / CELL) / F.col("total")}), "weights")

    def cell(point):
        return F.least(F.col("cells") - 1, F.floor(point * F.col("scale")))

    mean = F.col("w") * F.col("total") * (rate / 2)
    draws = (F.floor(mean) + (_uniform("u", "i", F.lit(seed)) < mean - F.floor(mean)).cast("bigint")).alias("draws")
    drawn = rows.select("u", "i", "total", "cells", "scale", draws).where("draws > 0").withColumn("draw", F.explode(F.sequence(F.lit(1).cast("bigint"), "draws")))
    points = drawn.withColumn("point", _uniform("u", "i", "draw", F.lit(seed + 1)) * F.col("total"))
    points = points.select("u", F.col("i").alias("one"), "point", cell(F.col("point")).alias("cell"))
    low = F.greatest(F.lit(0.0), F.col("high") - F.col("w"))
    held = rows.select("u", F.col("i").alias("other"), low.alias("low"), "high", F.explode(F.sequence(cell(low), cell(F.col("high")))).alias("cell"))
    met = points.join(held, ["u", "cell"]).where("low <= point AND point < high AND one <> other")
    return met.groupBy(F.least("one", "other").alias("a"), F.greatest("one", "other").alias("b")).agg(F.count(F.lit(1)).alias("hits"))


def exact_cosines(unit: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, similarity) of given pairs of columns: the entries of the shorter column look up those of the longer one."""
    sizes = unit.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    sized = pairs.join(sizes.select(F.col("i").alias("a"), F.col("n").alias("n_a")), "a").join(sizes.select(F.col("i").alias("b"), F.col("n").alias("n_b")), "b")
    short = F.when(F.col("n_a") <= F.col("n_b"), F.col("a")).otherwise(F.col("b"))
    long = F.when(F.col("n_a") <= F.col("n_b"), F.col("b")).otherwise(F.col("a"))
    walked = sized.select("a", "b", short.alias("i"), long.alias("other")).join(unit, "i").select("a", "b", "u", F.col("x").alias("y"), F.col("other").alias("i"))
    return walked.join(unit, ["u", "i"]).groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("similarity"))


def similar_columns(ratings: DataFrame, user: str, item: str, value: str, threshold: float, miss: float = 1e-6, seed: int = 0) -> DataFrame:
    """(item, other, similarity) of every two items with a cosine of at least ``threshold``, both directions.

    A pair at the threshold is missed with a chance of at most ``miss``, a more similar one more rarely; a given seed always
    gives the same pairs, and every similarity is exact. Each (user, item) must occur once. NULL keys and values and zero
    values count as no rating; an empty table gives no rows.
    """
    unit = unit_columns(ratings, user, item, value)
    met = sampled_pairs(unit, sampling_rate(threshold, miss), seed).where(F.col("hits") >= LEAST_HITS)
    half = exact_cosines(unit, stored(met.select("a", "b"), "candidates")).where(F.col("similarity") >= threshold)
    both = F.explode(F.array(F.struct(F.col("a").alias("item"), F.col("b").alias("other")), F.struct(F.col("b").alias("item"), F.col("a").alias("other"))))
    return half.select(both.alias("p"), "similarity").select("p.item", "p.other", "similarity")
