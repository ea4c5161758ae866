"""Sliding windows kept incrementally: counts per pane, and a running total with an inverse function.

A window is a run of panes. When a window closes, the newest pane's count is added to the total and that of the pane that
slid out is subtracted, so a window costs two updates whatever its length. State per key: the open panes, those of the current
window, and the total; timers on the watermark close windows and drop panes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lodestone.streaming.jobs import drain_to_files

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SCHEMA = "key string, salt int, start timestamp, end timestamp, n bigint"


class PaneCounts(StatefulProcessor):
    """Counts of one key's panes and the total of its current window; times are milliseconds."""

    def __init__(self, pane: int, per_window: int):
        self.pane = pane
        self.length = pane * per_window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "start bigint", "n bigint")
        self.window = handle.getValueState("window", "end bigint, total bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs()
        for frame in rows:
            for start, n in frame.groupby(frame["ms"] // self.pane * self.pane).size().items():
                start = int(start)
                if start + self.pane <= closed:  # its first window has been written
                    continue
                known = self.panes.getValue((start,))[0] if self.panes.containsKey((start,)) else 0
                self.panes.updateValue((start,), (known + int(n),))
                self.handle.registerTimer(start + self.pane)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs()
        last, total = self.window.get() if self.window.exists() else (None, 0)
        end, found = expiredTimerInfo.getExpiryTimeInMs(), []
        if last is not None:
            end = last + self.pane if total else max(end, last + self.pane)
        while end <= closed:
            newest, oldest = (end - self.pane,), (end - self.pane - self.length,)
            if self.panes.containsKey(newest):
                total += self.panes.getValue(newest)[0]
            if self.panes.containsKey(oldest):
                total -= self.panes.getValue(oldest)[0]
                self.panes.removeKey(oldest)
            last = end
            if not total:
                break
            found.append((end - self.length, end, total))
            end += self.pane
        if last is not None:
            if total:
                self.window.update((last, total))
                self.handle.registerTimer(last + self.pane)
            elif self.window.exists():
                self.window.clear()
        if found:
            start, stop, n = (pd.Series(x) for x in zip(*found))
            yield pd.DataFrame({"key": key[0], "salt": key[1], "start": pd.to_datetime(start, unit="ms"), "end": pd.to_datetime(stop, unit="ms"), "n": n})

    def close(self) -> None:
        pass


def sliding_counts(stream: DataFrame, time: str, key: str, salt: Column, pane_seconds: int, per_window: int, lateness: str, salts: int = 8) -> DataFrame:
    """(key, salt, start, end, n) of every closed window of `per_window` panes that holds a row of the key; append mode.

    Rows of a key are spread over `salts` state entries by the salt; `merged` adds them up. Rows later than the bound are left
    out. Windows start at multiples of the pane since 1970. Rows without a time are left out; NULL is a key.
    """
    rows = stream.withWatermark(time, lateness).where(F.col(time).isNotNull())
    rows = rows.select(F.col(key).cast("string").alias("key"), F.pmod(F.coalesce(salt, F.lit(0)), F.lit(salts)).cast("int").alias("salt"), F.unix_millis(time).alias("ms"), F.col(time))
    grouped = rows.groupBy("key", "salt")
    return grouped.transformWithStateInPandas(PaneCounts(pane_seconds * 1000, per_window), SCHEMA, "Append", "EventTime")


def drained(windows: DataFrame, checkpoint: str, path: str) -> DataFrame:
    """Run the windows over all available input and return what has been written so far; goes on from the checkpoint."""
    spark = windows.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)  # the only store that has map states and timers
    try:
        return drain_to_files(windows, checkpoint, path)
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def merged(windows: DataFrame) -> DataFrame:
    """One row per key and window from its salted parts."""
    return windows.groupBy("key", "start", "end").agg(F.sum("n").alias("n"))
