"""Session builder, table loader and shared scratch storage."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def build_session(name: str = "lodestone", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=None)
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="lodestone-")


@lru_cache(maxsize=8)
def _tried(spark: SparkSession, folder: str) -> str:
    """The folder with its file system; a local one only if the driver finds there what tasks have written."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(context._jsc.hadoopConfiguration())
    named = system.makeQualified(path).toString()
    if named.startswith("file:"):
        trial, n = f"{named.rstrip('/')}/lodestone-trial-{uuid.uuid4().hex}", 4 * max(8, context.defaultParallelism)
        spark.range(0, n, 1, n).write.parquet(trial)
        found = spark.read.schema("id bigint").parquet(trial).count()
        system.delete(context._jvm.org.apache.hadoop.fs.Path(trial), True)
        if found != n:
            raise RuntimeError(f"executors have written {n} rows, and the driver finds {found}")
    return named


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, below the folder named in spark.checkpoint.dir.

    All executors must see it. Without the setting it lies below the folder given to setCheckpointDir, or else in the warehouse,
    which executors share as well; a master whose executors are threads of the driver takes a temporary folder. A path that names
    no file system (file://, hdfs://, s3a:// ...) is one of fs.defaultFS, as everywhere in Spark, and where all executors are
    processes of this machine (local-cluster), a folder of this machine. On several machines a local folder that was not named
    with its file system is tried once, so that one which each machine has for itself is not taken by mistake.
    """
    context = spark.sparkContext
    threads = re.fullmatch(r"local(\[.*\])?", context.master) is not None
    processes = context.master.startswith("local-cluster[")
    root = spark.conf.get("spark.checkpoint.dir", None)
    given = root is not None
    if not given and threads:
        root = _local_root(context.applicationId)
    elif not given:
        root = spark.conf.get("spark.sql.warehouse.dir", None)
        if root is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = context.getCheckpointDir() or root
    named = "://" in root or re.match(r"[a-z0-9]+:/", root) is not None
    if processes and not named:
        root = Path(root).absolute().as_uri()  # the executors have working folders of their own
    elif not threads and not processes and not (given and named):
        try:
            root = _tried(spark, root)
        except Exception as error:
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that every executor can reach; this one failed: {root}") from error
    return f"{root.rstrip('/')}/lodestone-{context.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results that still read them can no longer be computed."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to shared scratch storage and read them back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing the plan, and
    every later pass sees the same rows with the same slice numbers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows over `spark.lodestone.spread` partitions, if that is set, before work that costs far more than a shuffle.

    For small files of one row group, which Spark cannot split; large tables come in enough splits.
    """
    parts = df.sparkSession.conf.get("spark.lodestone.spread", None)
    return df.repartition(int(parts)) if parts else df


class Tables:
    """The Parquet tables below one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._schemas: dict[str, StructType] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        if name in self._schemas:  # finding the schema is a job
            return self.spark.read.schema(self._schemas[name]).parquet(self.path(name))
        df = self.spark.read.parquet(self.path(name))
        self._schemas[name] = df.schema
        return df
