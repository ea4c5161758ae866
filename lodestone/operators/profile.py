"""Column profiles and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, sample deviation, min, max, in one pass with typed results."""
    pieces = []
    for c in columns:
        x = F.col(c).cast("double")
        pieces += [F.count(x), F.avg(x), F.stddev_samp(x), F.min(x), F.max(x)]
    wide = df.agg(*[p.alias(f"_{i}") for i, p in enumerate(pieces)])
    rows = ", ".join(f"'{c}', " + ", ".join(f"_{5 * i + j}" for j in range(5)) for i, c in enumerate(columns))
    return wide.select(F.expr(f"stack({len(columns)}, {rows}) as (column, n, mean, stddev, min, max)"))


def stat_counter(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per group and column: count, mean, population deviation, max, min; NaN counts as missing."""
    aggregates = []
    for c in columns:
        x = F.col(c).cast("double")
        known = F.when(~F.isnan(x), x)
        aggregates += [
            F.count(known).alias(f"{c}_count"),
            F.avg(known).alias(f"{c}_avg"),
            F.stddev_pop(known).alias(f"{c}_stdev"),
            F.max(known).alias(f"{c}_max"),
            F.min(known).alias(f"{c}_min"),
            F.count_if(F.isnan(x)).alias(f"{c}_missing"),
        ]
    return df.groupBy(*keys).agg(*aggregates)


def to_long(df: DataFrame, keys: Sequence[str], name: str, value: str) -> DataFrame:
    """Turn every other column into a (name, value) row."""
    others = [c for c in df.columns if c not in keys]
    typed = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in others])
    return typed.unpivot([F.col(k) for k in keys], others, name, value)


def histogram_wide(df: DataFrame, column: str, width: float, bins: int) -> DataFrame:
    """One row of counts per fixed-width bin from 0, plus an open last bin."""
    x = F.col(column)
    counts: list[Column] = []
    for i in range(bins):
        low, high = i * width, (i + 1) * width
        counts.append(F.count_if((x >= low) & (x < high)).alias(f"count{low:g}_{high:g}"))
    top = bins * width
    counts.append(F.count_if(x >= top).alias(f"count{top:g}max"))
    return df.agg(*counts)


def histogram_long(df: DataFrame, column: str, width: float, bins: int) -> DataFrame:
    """The same histogram as rows: bin number from 0, the last bin open."""
    bin_id = F.least(F.floor(F.col(column) / F.lit(float(width))), F.lit(bins)).cast("bigint")
    return df.where(F.col(column) >= 0).groupBy(bin_id.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def mode(df: DataFrame, column: str) -> DataFrame:
    """All values that share the highest count."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    highest = counts.agg(F.max("n").alias("_highest"))  # one row
    return counts.join(F.broadcast(highest), F.col("n") == F.col("_highest")).drop("_highest")


def vector_stats(df: DataFrame, column: str) -> DataFrame:
    """Per vector slot: count, mean, sample variance, min, max and non-zero count."""
    cells = df.select(F.posexplode(column).alias("slot", "x")).withColumn("x", F.col("x").cast("double"))
    return cells.groupBy("slot").agg(
        F.count("x").alias("n"),
        F.avg("x").alias("mean"),
        F.var_samp("x").alias("variance"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        F.count_if(F.col("x") != 0).alias("non_zero"),
    )
