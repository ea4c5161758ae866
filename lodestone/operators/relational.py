"""Joins and row filters with checked sizes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.ordered import broadcast_if_small

def lookup(df: DataFrame, key: str, dictionary: DataFrame, dictionary_key: str, value: str) -> DataFrame:
    """Add ``value`` from a dictionary table; a missing key gives NULL."""
    side = dictionary.select(F.col(dictionary_key).alias("_key"), F.col(value))
    return df.join(broadcast_if_small(side), F.col(key) == F.col("_key"), "left").drop("_key")


def split_valid(df: DataFrame, column: str, pattern: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose column matches the pattern, and the rejected values with their counts."""
    valid = df.where(F.col(column).rlike(pattern))
    rejected = df.where(~F.col(column).rlike(pattern)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return valid, rejected


def digit_split(key: Column, bounds: Mapping[str, int], last: str) -> Column:
    """Name the part a row belongs to by the last digit of its key: below the first bound, the second, ..."""
    digit = F.pmod(key, F.lit(10))
    part = F.lit(last)
    for name, bound in sorted(bounds.items(), key=lambda item: -item[1]):
        part = F.when(digit < bound, F.lit(name)).otherwise(part)
    return part


def by_key_rule(df: DataFrame, rule: Column, parts: int, name: str = "part") -> DataFrame:
    """Partition rows by a user rule that yields 0 .. parts-1."""
    return df.withColumn(name, rule).repartition(parts, name)


def last_digit_rule(key: Column, parts: int) -> Column:
    """Partition number from the last character of a key."""
    return F.pmod(F.right(key, F.lit(1)).cast("int"), F.lit(parts))


def random_split(df: DataFrame, keys: Sequence[str], shares: Mapping[str, float], seed: int, name: str = "part") -> DataFrame:
    """Assign every row to a part at random by a seeded hash of its key.

    The parts are disjoint and cover the table, and a row keeps its part however the data is
    partitioned or recomputed. Rows with equal keys stay together.
    """
    uniform = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 30)) / F.lit(float(1 << 30))
    total = sum(shares.values())
    reached, part = 1.0, None
    for label, share in reversed(shares.items()):
        part = F.lit(label) if part is None else F.when(uniform < reached, F.lit(label)).otherwise(part)
        reached -= share / total
    return df.withColumn(name, part)
