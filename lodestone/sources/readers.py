"""Readers for text, delimited, JSON, labelled-point and whole-file inputs."""

from __future__ import annotations

import re

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestone.sources.schemas import conform


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def delimited(spark: SparkSession, path: str, separator: str, schema: StructType, header: bool = False) -> DataFrame:
    """Typed columns from text with a separator of one or more characters; quotes are ordinary characters."""
    return spark.read.csv(path, sep=separator, schema=schema, header=header, quote="")


def headed_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header: every column is read as a string, then cast; bad values become NULL."""
    return conform(spark.read.option("header", True).csv(path), schema)


def json_lines(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """JSON lines; without a schema Spark infers one, which costs a pass over the data."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: path, content, and the parent folder as label."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return files.select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"),
        F.element_at(F.split("_metadata.file_path", "/"), -2).alias("label"),
    )


def libsvm(spark: SparkSession, path: str, features: int | None = None) -> DataFrame:
    reader = spark.read.format("libsvm")
    if features is not None:
        reader = reader.option("numFeatures", str(features))
    return reader.load(path)


def labelled_points(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``label,f1 f2 ...`` or ``(label,[f1,f2,...])`` as label and feature vector."""
    plain = F.regexp_replace("value", r"[()\[\]]", "")
    parts = F.split(plain, ",", 2)
    numbers = F.transform(F.split(F.trim(parts[1]), r"[,\s]+"), lambda x: x.cast("double"))
    return spark.read.text(path).where(F.trim("value") != "").select(
        F.trim(parts[0]).cast("double").alias("label"), array_to_vector(numbers).alias("features")
    )


def tagged_by_file(spark: SparkSession, path: str, pattern: str, name: str, folder: bool = False) -> DataFrame:
    """Lines of several files, each with the part of its file name, or of its folder's path, that the pattern captures."""
    lines = spark.read.text(path)
    source = "_metadata.file_path" if folder else "_metadata.file_name"
    return lines.select(F.regexp_extract(source, pattern, 1).alias(name), "value")


def count_per_file(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, file, n): lines of every input file, 0 for an empty one. Files are told apart by their whole path."""
    text = spark.read.text(path)
    lines = text.select(F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    # the list that Spark has made on the driver anyway; empty files have no rows to be found by
    files = spark.createDataFrame([(re.sub(r"^file:/+", "file:/", f),) for f in text.inputFiles()], "path string")
    return files.join(lines, "path", "left").select("path", F.element_at(F.split("path", "/"), -1).alias("file"), F.coalesce("n", F.lit(0)).alias("n"))


def jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
