"""Writers; all replace old output unless stated otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def to_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def to_parquet(df: DataFrame, path: str, *partition_columns: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition_columns).parquet(path)


def to_text(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def to_delimited(df: DataFrame, path: str, separator: str, header: bool = False) -> None:
    df.write.mode("overwrite").csv(path, sep=separator, header=header)


def to_multichar_text(df: DataFrame, path: str, separator: str) -> None:
    """Text with a separator of several characters, which the CSV writer does not take."""
    line = F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    to_text(df.select(line.alias("value")), path)


def to_single_file(report: DataFrame, path: str) -> None:
    """One text file; for small reports only, since one task writes it."""
    report.coalesce(1).write.mode("overwrite").text(path)


def to_table(df: DataFrame, name: str, location: str | None = None) -> None:
    """Drop and re-create a table, managed unless a location is given."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.write.mode("overwrite")
    (writer.option("path", location) if location else writer).saveAsTable(name)


def load_into(df: DataFrame, name: str) -> None:
    """Append rows to an existing table, columns by position."""
    df.write.insertInto(name)


def create_table(spark: SparkSession, name: str, schema: StructType, location: str | None = None) -> None:
    """Create an empty Parquet table unless it is there; with a location its files outlive the table."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")


def to_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.format("jdbc").mode("overwrite").options(url=url, dbtable=table, **options).save()


def wide_text_to_parquet(spark: SparkSession, source: str, target: str, separator: str, schema: StructType) -> None:
    """Text to typed Parquet, so that later readers fetch only the columns and rows they filter on."""
    spark.read.csv(source, sep=separator, schema=schema).write.mode("overwrite").parquet(target)
