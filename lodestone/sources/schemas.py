"""Declared schemas and the projection that makes a table follow one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ShortType, StringType, StructField, StructType


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns by name and cast each to its declared type.

    Text that does not parse becomes NULL; the declared order is kept.
    """
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def string_schema(names: str) -> StructType:
    """A schema of string columns from a space-separated list of names."""
    return StructType([StructField(n, StringType()) for n in names.split()])


def wide_schema(leading: list[str], groups: int) -> StructType:
    """Leading string columns, then ``groups`` triples of (letter, number, flag) columns."""
    fields = [StructField(n, StringType()) for n in leading]
    for i in range(1, groups + 1):
        fields += [
            StructField(f"letter{i}", StringType()),
            StructField(f"number{i}", ShortType()),
            StructField(f"bool{i}", BooleanType()),
        ]
    return StructType(fields)
