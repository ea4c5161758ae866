"""Structured Streaming jobs.

Sources are any streaming format; a job is a function from a streaming DataFrame to another,
and ``drain`` runs it until the available input is used up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from lodestone.session import scratch_path
from lodestone.sources import serving


def read_stream(spark: SparkSession, fmt: str, schema: StructType | None = None, **options: str) -> DataFrame:
    """A stream of any source format, for example parquet files or a message topic."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load()


def drain(
    stream: DataFrame, checkpoint: str, mode: str, write: Callable[[DataFrame, int], None]
) -> None:
    """Run a streaming query over all available input, batch by batch, then stop."""
    job = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()


def drain_to_files(stream: DataFrame, checkpoint: str, path: str) -> DataFrame:
    """Append a streaming query to Parquet files, each input row exactly once, and read the files."""
    job = (
        stream.writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", checkpoint).option("path", path)
        .trigger(availableNow=True).start()
    )
    job.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def running_totals(stream: DataFrame, keys: list[str], label: str, checkpoint: str | None = None, path: str | None = None) -> DataFrame:
    """Run an aggregation with state across batches and return the newest totals per key.

    Update mode writes only the keys that changed in a batch.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, f"{label}-table")
    drain(stream, checkpoint or scratch_path(spark, f"{label}-state"), "update", serving.batch_writer(path))
    return serving.newest(spark, path, stream.schema, keys)


def per_batch(stream: DataFrame, summary: Callable[[DataFrame], DataFrame], label: str, checkpoint: str | None = None, path: str | None = None) -> DataFrame:
    """Summarise every micro-batch by itself, without state; returns all summaries with their batch number."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, f"{label}-table")
    drain(stream, checkpoint or scratch_path(spark, f"{label}-state"), "append", serving.batch_writer(path, summary))
    return spark.read.parquet(path)


def windowed_count(stream: DataFrame, time: str, keys: list[str], length: str, slide: str | None = None, *, lateness: str | None) -> DataFrame:
    """Count per sliding or tumbling event-time window.

    The lateness bound lets closed windows leave the state. It has no default: None keeps every window open, which only the
    replay of a bounded set of files in any order may ask for.
    """
    rows = stream.withWatermark(time, lateness) if lateness else stream
    counted = rows.groupBy(F.window(time, length, slide), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def last_value_state(stream: DataFrame, key: str, order: str, value: str, salt: Column, salts: int) -> DataFrame:
    """Keep (rows seen, newest value) per key in arbitrary state.

    Each key is split by a salt, so that a hot key's rows spread over several state entries;
    ``merge_last_values`` folds them together.
    """
    rows = stream.select(
        F.col(key).alias("key"), F.pmod(salt, F.lit(salts)).cast("int").alias("salt"),
        F.col(order).cast("bigint").alias("at"), F.col(value).cast("double").alias("value"),
    )

    def update(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, at, last = state.get if state.exists else (0, None, None)
        for frame in frames:
            newest = frame.loc[frame["at"].idxmax()]
            seen += len(frame)
            if at is None or newest["at"] >= at:
                at, last = int(newest["at"]), float(newest["value"])
        state.update((seen, at, last))
        yield pd.DataFrame({"key": [group[0]], "salt": [group[1]], "seen": [seen], "at": [at], "last": [last]})

    schema = "key bigint, salt int, seen bigint, at bigint, last double"
    return rows.groupBy("key", "salt").applyInPandasWithState(
        update, schema, "seen bigint, at bigint, last double", "update", GroupStateTimeout.NoTimeout
    )


def merge_last_values(states: DataFrame) -> DataFrame:
    """One row per key from its salted states."""
    return states.groupBy("key").agg(F.sum("seen").alias("seen"), F.max_by("last", "at").alias("last"))


def lookup_join(stream: DataFrame, static: DataFrame, on: str) -> DataFrame:
    """Inner join of a stream with a static table; rows without a match are skipped."""
    return stream.join(static, on)


def follow_last_item(
    clicks: DataFrame, lists: DataFrame, user: str, item: str, order: list[str], label: str, checkpoint: str | None = None, path: str | None = None,
) -> DataFrame:
    """Keep for every user the list of the item clicked last, in a keyed table updated batch by batch; returns the table.

    ``lists`` has one row per item. Each micro-batch joins its clicks with it, keeps the last matching click of every user and
    writes one row per changed user to a folder of its own, so that a retried batch changes nothing. A click on an item without
    a list, or by no user, leaves the table as it is. Late clicks do not replace newer ones: the greatest ``order`` counts.
    """
    spark = clicks.sparkSession
    path = path or scratch_path(spark, f"{label}-table")
    values = [c for c in lists.columns if c != item]
    row = F.struct(*order, *values)

    def changed(batch: DataFrame) -> DataFrame:
        found = lookup_join(batch.select(user, item, *order), lists, item).where(F.col(user).isNotNull())
        return found.groupBy(user).agg(F.max_by(row, F.struct(*order)).alias("last"))

    drain(clicks, checkpoint or scratch_path(spark, f"{label}-state"), "append", serving.batch_writer(path, changed))
    return spark.read.parquet(path).groupBy(user).agg(F.max_by("last", F.struct(*[F.col("last")[c] for c in order])).alias("last")).select(user, "last.*")
