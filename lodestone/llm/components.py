"""Connected components by alternating stars, with every step written to shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import stored


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's larger (or not larger) neighbours become neighbours of the least node next to it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # the minimum has one row per node, so a node with many neighbours is skewed on one side only, which Spark splits
    seen = both.join(least, "u")
    if large:
        out = seen.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = seen.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") > F.col("v")).distinct()


def labelled(edges: DataFrame) -> DataFrame:
    """(u, v): every node of the edges (u, v) that is not the least of its component, with the least.

    The nodes can be of any ordered type. Loops and repeated edges are allowed; no edges give no rows. The number of rounds
    grows with the logarithm of the longest path.
    """
    a, b = F.greatest("u", "v"), F.least("u", "v")
    edges = stored(edges.select(a.alias("u"), b.alias("v")).where(F.col("u") > F.col("v")).distinct(), "edges")
    before = None
    while True:
        edges = stored(_starred(_starred(edges, True), False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges
        before = now
