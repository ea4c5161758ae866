"""Bipartite graphs from edge lists: dictionaries, degrees, triplets, SimRank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.operators import matrix
from lodestone.operators.features import dictionary
from lodestone.session import stored


def count_edges(edges: DataFrame, source: str, target: str) -> DataFrame:
    """One row per (src, dst) pair with the number of parallel edges."""
    return edges.groupBy(F.col(source).alias("src"), F.col(target).alias("dst")).agg(F.count(F.lit(1)).alias("n"))


def vertices(edges: DataFrame) -> DataFrame:
    """All end points with ids from 0 in sorted order."""
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    return dictionary(nodes, "node", "id")


def index_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges between ids instead of names."""
    return (
        edges.join(nodes.select(F.col("node").alias("src"), F.col("id").alias("src_id")), "src")
        .join(nodes.select(F.col("node").alias("dst"), F.col("id").alias("dst_id")), "dst")
        .select("src_id", "dst_id", "n")
    )


def degrees(nodes: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """Out- and in-degree of every node, 0 when it has none; parallel edges count each."""
    out = edges.groupBy(F.col("src").alias(node)).agg(F.sum("n").alias("out_degree"))
    into = edges.groupBy(F.col("dst").alias(node)).agg(F.sum("n").alias("in_degree"))
    joined = nodes.join(out, node, "left").join(into, node, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("out_degree", "in_degree")})


def triplets(edges: DataFrame, nodes: DataFrame, node: str, attribute: str) -> DataFrame:
    """Edges with an attribute of both end points."""
    return (
        edges.join(nodes.select(F.col(node).alias("src"), F.col(attribute).alias(f"src_{attribute}")), "src")
        .join(nodes.select(F.col(node).alias("dst"), F.col(attribute).alias(f"dst_{attribute}")), "dst")
        .select("src", "dst", "n", f"src_{attribute}", f"dst_{attribute}")
    )


def transition(edges: DataFrame) -> DataFrame:
    """T[dst, src] = n / out(src) and T[src, dst] = n / in(dst); parallel edges add up."""
    out = edges.groupBy("src").agg(F.sum("n").alias("out"))
    into = edges.groupBy("dst").agg(F.sum("n").alias("into"))
    rows = edges.join(out, "src").join(into, "dst")
    down = rows.select(F.col("dst").alias("i"), F.col("src").alias("j"), (F.col("n") / F.col("out")).alias("value"))
    up = rows.select(F.col("src").alias("i"), F.col("dst").alias("j"), (F.col("n") / F.col("into")).alias("value"))
    return matrix.add(down, up)


def _moved(vectors: DataFrame, step: DataFrame) -> DataFrame:
    """step * x for every vector x, as (query, node, x) rows."""
    moved = vectors.join(step, vectors["node"] == step["j"]).select("query", F.col("i").alias("node"), (F.col("x") * F.col("value")).alias("x"))
    return moved.groupBy("query", "node").agg(F.sum("x").alias("x"))


def simrank(edges: DataFrame, queries: DataFrame, query: str, damp: float, steps: int) -> DataFrame:
    """(i, j, value): similarity of each query node i to every node j that it reaches.

    S <- damp * T' S T + (1 - damp) * I, ``steps`` times from (1 - damp) * I, is the sum of damp^m T'^m T^m, so a row of S needs
    one vector per query node, moved forward m times and back. No node x node matrix is built; the work grows with the
    queries and what they reach.
    """
    step = stored(transition(edges), "transition")
    back = matrix.transpose(step)
    start = queries.select(F.col(query).alias("query")).distinct().withColumns({"node": F.col("query"), "x": F.lit(1.0)})
    forward = [start]
    for _ in range(steps):
        forward.append(stored(_moved(forward[-1], step), "forward"))
    row = forward[-1]
    for vectors in reversed(forward[:-1]):
        returned = _moved(row, back).withColumn("x", F.col("x") * damp)
        row = vectors.unionByName(returned).groupBy("query", "node").agg(F.sum("x").alias("x"))
    return row.select(F.col("query").alias("i"), F.col("node").alias("j"), (F.col("x") * (1 - damp)).alias("value"))


def without_self(similarity: DataFrame) -> DataFrame:
    """Pairs of different nodes, to six decimals."""
    return similarity.where(F.col("i") != F.col("j")).select("i", "j", F.round("value", 6).alias("value"))
