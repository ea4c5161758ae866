"""Registration of named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestone.session import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a plan over the tables, with the SQL text that must give the same rows."""

    def register(plan: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plan(Tables(spark, folder))

        run.__name__ = name
        run.__doc__ = plan.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return plan

    return register
