"""Quantiles from mergeable KLL sketches: bounded size, a stated rank error, no sort and no second pass.

Sketches are made map-side and merged by Spark; stored sketches of parts of a table (a day, a source) can be merged later into
those of any union, without reading the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter: about 3 * K numbers are kept, whatever the number of rows.
K = 400


def rank_error(k: int = K) -> float:
    """Share of the rows by which the rank of a returned quantile is off at most, in 99 of 100 sketches."""
    return 2.296 / k**0.9021


def sketched(df: DataFrame, keys: Sequence[str], value: Column, k: int = K) -> DataFrame:
    """(keys, sketch) of the values of each group; NULLs are left out."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(value.cast("double"), F.lit(k)).alias("sketch"))


def merged(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, sketch): the sketches of coarser groups from those of finer ones."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def borders(sketch: Column, buckets: int) -> Column:
    """The borders that cut the values into so many parts of equal size, ascending and distinct."""
    cuts = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    return F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double(sketch, cuts)))


def bucket(value: Column, cuts: Column) -> Column:
    """The number of borders that are at most the value: its bucket, from 0; NULL for NULL."""
    return F.when(value.isNotNull(), F.size(F.filter(cuts, lambda c: c <= value)))
