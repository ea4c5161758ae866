"""Keyed serving tables that streams and batch jobs update.

Every batch writes its changed rows to a folder of its own, overwriting that folder when the
batch is retried, so a restart neither loses nor doubles an update. Readers take the newest
row per key; ``compact`` folds the batches into one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def batch_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that stores each micro-batch below ``path`` by its number."""

    def write(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def all_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of every batch, with their batch number."""
    return spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(path)


def newest(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The last written row per key."""
    values = [f.name for f in schema.fields if f.name not in keys]
    rows = all_batches(spark, path, schema)
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_row"))
    return last.select(*keys, *[F.col(f"_row.{v}").alias(v) for v in values])


def upsert(spark: SparkSession, path: str, changes: DataFrame, number: int, keys: Sequence[str]) -> DataFrame:
    """Store one numbered set of changes (one row per key) and return the current table."""
    batch_writer(path)(changes, number)
    return newest(spark, path, changes.schema, keys)


def append(spark: SparkSession, path: str, rows: DataFrame, number: int) -> DataFrame:
    """Store one numbered set of rows beside all earlier ones; a repeated number replaces its rows. All rows."""
    batch_writer(path)(rows, number)
    return all_batches(spark, path, rows.schema).select(*rows.columns)


def increment(spark: SparkSession, path: str, changes: DataFrame, number: int, keys: Sequence[str]) -> DataFrame:
    """Store one numbered set of amounts per key; a repeated number replaces its amounts. The sums per key."""
    values = [f.name for f in changes.schema.fields if f.name not in keys]
    totals = changes.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
    batch_writer(path)(totals, number)
    return all_batches(spark, path, totals.schema).groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])


def compact(spark: SparkSession, path: str, target: str, schema: StructType, keys: Sequence[str]) -> None:
    """Write the current rows as batch 0 of a new table."""
    newest(spark, path, schema, keys).write.mode("overwrite").parquet(f"{target}/batch=0")
