"""Rows carried as one struct, so that the columns of a table and those of an operator cannot clash."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows, so that an executor copies few texts outside its heap at once.

    The setting is lowered for the session and stays, because a result is computed when it is read; rows do not depend on it.
    """
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:  # 0 is no limit
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def wrapped(df: DataFrame, **own: Column) -> DataFrame:
    """The whole row as `row`, and the operator's own columns."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(name) for name, c in own.items()])


def unwrapped(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns of the row again, and new columns, which replace those of the same name."""
    kept = [F.col("row")[c].alias(c) for c in columns if c.lower() not in {n.lower() for n in new}]
    return df.select(*kept, *[c.alias(name) for name, c in new.items()])


def give_back() -> None:
    """Return freed memory to the system: the worker, or the driver, may go on to other work."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function over batches, giving memory back when its task ends and its tables are gone."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return whole


def sliced(batches: Iterable[pa.RecordBatch], n: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are held as Python strings at once."""
    for batch in batches:
        for first in range(0, batch.num_rows, n):
            yield batch.slice(first, n)
    pa.default_memory_pool().release_unused()
