"""User-defined scalar, aggregate and partition functions, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTIAL_GROUPS = 100_000


def partial_sums(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """(sum, count) of a column per key and task, the map side of an average.

    A task holds at most PARTIAL_GROUPS keys before it hands its partial rows on, so a hot
    key leaves each task as one row and is never collected.
    """
    names = list(keys)

    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        if names:
            return frame.groupby(names, as_index=False, dropna=False)[["total", "n"]].sum()
        return frame[["total", "n"]].sum().to_frame().T.astype({"n": "int64"})

    def partials(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            rows = frame[names].assign(total=frame[column].fillna(0.0), n=frame[column].notna().astype("int64"))
            held = combine(rows if held is None else pd.concat([held, rows]))
            if len(held) > PARTIAL_GROUPS:
                yield held
                held = None
        if held is not None:
            yield held

    inputs = df.select(*names, F.col(column).cast("double").alias(column))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in inputs.schema.fields if f.name in names]
    return inputs.mapInPandas(partials, ", ".join([*fields, "total double", "n bigint"]))


def register_average(spark, name: str = "u_avg"):
    """Register the reduce side of the average for SQL: merges (total, n) states, skips empty groups."""

    @F.pandas_udf("double")
    def average(total: pd.Series, n: pd.Series) -> float:
        rows = n.sum()
        return float(total.sum() / rows) if rows else None

    spark.udf.register(name, average)
    return average


def aggregate(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Average through a zero / reduce / merge / finish aggregator: partial rows, then one merge per key."""
    names = list(keys)

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        out = frame[names].head(1).reset_index(drop=True)
        rows = frame["n"].sum()
        out[name] = [frame["total"].sum() / rows if rows else None]
        return out

    partial = partial_sums(df, keys, column)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in partial.schema.fields if f.name in names]
    return partial.groupBy(*names).applyInPandas(finish, ", ".join([*fields, f"`{name}` double"]))


def map_partitions(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a function to the Arrow batches of every partition."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield function(frame)

    return df.mapInPandas(run, schema)


def group_map(
    df: DataFrame, keys: Sequence[str], function: Callable[[pd.DataFrame], pd.DataFrame], schema: str, rows: int = 50_000
) -> DataFrame:
    """Apply a function to whole groups, many groups per call, about ``rows`` rows at a time.

    The function gets every row of each group it sees, so it groups by the keys itself; one
    call for many small groups saves the cost of a call per group. Groups must be small:
    aggregate first when a key may be hot.
    """
    buckets = max(1, -(-df.count() // rows))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    return df.groupBy(bucket.alias("_bucket")).applyInPandas(lambda frame: function(frame), schema)


def sql_transform(df: DataFrame, statement: str) -> DataFrame:
    """Run SQL text over the table that the text calls __THIS__."""
    return df.sparkSession.sql(statement.replace("__THIS__", "{df}"), df=df)
