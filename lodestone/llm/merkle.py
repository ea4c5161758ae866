"""Merkle manifest of a dataset: one tree per group, one tree over the groups, and a proof for every row.

A level is a table of (group, position, digest). Lag and lead windows of fixed offsets give each node the others of its run of
`arity` neighbours; offsets that leave the run are masked by the node's slot and the run's length. The first node of a run
hashes the run into the parent. Windows span blocks of a bounded number of positions, so a group that holds a third of all
rows is spread over many tasks. Levels are stored; proofs are put together from the root down, one join per level on the
run's number. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.session import stored

ARITY = 16
#: Runs whose nodes one window scans together.
RUNS_PER_BLOCK = 16

LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts' UTF-8 bytes, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """`-` for NULL, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The digest of a row of values."""
    return digest(*[field(v) for v in values])


def _group(value: Column) -> Column:
    """Text that sorts as the groups do, NULL first."""
    return F.coalesce(F.concat(F.lit("s"), value.cast("string")), F.lit(""))


def positioned(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows of (g, node, ...) with `pos`, their number from 0 within g by `order`, and `n`, the size of g; stored.

    Rows are range-partitioned by (g, order), numbered within each range, and moved by the ranges before: no group has to fit
    in one task.
    """
    ranged = stored(df.repartitionByRange("g", *order).withColumn("_range", F.spark_partition_id()), "merkle-ranges")
    sizes = ranged.groupBy("g", "_range").agg(F.count("*").alias("_rows"))
    whole = Window.partitionBy("g")
    before = F.coalesce(F.sum("_rows").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("g", "_range", before.alias("_before"), F.sum("_rows").over(whole).alias("n"))
    local = F.row_number().over(Window.partitionBy("g", "_range").orderBy(*order)) - 1
    numbered = ranged.withColumn("_local", local).join(sizes, ["g", "_range"])
    return stored(numbered.select(*df.columns, (F.col("_local") + F.col("_before")).alias("pos"), "n"), "merkle-nodes")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """`left` and `right`: the digests of the run's other nodes before and after each node, concatenated."""
    slot, run = F.col("pos") % ARITY, F.floor(F.col("pos") / ARITY)
    length = F.least(F.lit(ARITY), F.col("n") - run * ARITY)
    near = Window.partitionBy("g", F.floor(F.col("pos") / (ARITY * RUNS_PER_BLOCK))).orderBy("pos")
    left = [F.when(slot >= k, F.lag("node", k).over(near)) for k in range(ARITY - 1, 0, -1)]
    right = [F.when(slot + k < length, F.lead("node", k).over(near)) for k in range(1, ARITY)]
    return nodes.select("*", run.alias("run"), F.concat_ws("", *left).alias("left"), F.concat_ws("", *right).alias("right"))


def climbed(nodes: DataFrame) -> list[DataFrame]:
    """The levels of every group's tree, from the leaves up; a group ends at the level on which it has one node."""
    levels = [nodes]
    while (levels[-1].agg(F.max("n")).first()[0] or 0) > 1:
        firsts = with_siblings(levels[-1].where("n > 1").select("g", "pos", "n", "node")).where(F.col("pos") % ARITY == 0)
        above = firsts.select("g", F.col("run").alias("pos"), F.ceil(F.col("n") / ARITY).alias("n"), digest(F.col("node"), F.col("right")).alias("node"))
        levels.append(stored(above, "merkle-level"))
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """(g, node): the last node of every group."""
    out = levels[0].where("n = 1").select("g", "node")
    for level in levels[1:]:
        out = out.unionByName(level.where("n = 1").select("g", "node"))
    return out


def descended(levels: list[DataFrame], roots: DataFrame) -> DataFrame:
    """The leaves with `path`, their siblings level by level, followed by what `roots` (g, path, ...) says of the group."""
    own = roots.columns
    rest = [c for c in own if c not in ("g", "path")]
    above = None
    for level in reversed(levels):
        columns = [c for c in level.columns if c != "g"]
        ended = level.where("n = 1").join(roots, "g").select("g", *columns, "path", *rest)
        if above is None:
            above = ended
            continue
        parents = above.select("g", F.col("pos").alias("run"), F.col("path").alias("_above"), *rest)
        path = F.concat(F.array(F.struct("left", "right")), F.col("_above"))
        below = with_siblings(level.where("n > 1")).join(parents, ["g", "run"]).select("g", *columns, path.alias("path"), *rest)
        above = below.unionByName(ended)
    return above


def folded(path: Column, start: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level and from left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


def manifest(df: DataFrame, id_col: str, group_col: str, fields: Sequence[str], now: Column | None = None) -> DataFrame:
    """(id, leaf, subroot, root, path, now) for every row of the table.

    `leaf` hashes the fields of the row; per group, leaves ascend by (id, leaf), and every 16 consecutive nodes become one
    until one node is left, the `subroot`. Subroots, NULL's first and then by the bytes of the group, give `root` likewise.
    `path` is an array of (left, right) siblings from the leaf to the root, `now` the digest of the given column, which stands
    for the row as it is found later (the leaf itself if none is given): `folded(path, now)` equals `root` if it is unchanged.

    NULL fields count as `-`; NULL ids come first; rows of one id are ordered by their leaves, so repeated rows have equal
    leaves and neighbouring places. Empty and very long texts are hashed whole, and no text is moved between tasks. An empty
    table gives no rows. Other columns are left out, whatever their names.
    """
    kept = leaf(*[F.col(f) for f in fields])
    rows = df.select(_group(F.col(group_col)).alias("g"), F.col(id_col).alias("id"), kept.alias("node"), (kept if now is None else F.coalesce(now, kept)).alias("now"))
    levels = climbed(positioned(stored(rows, "merkle-leaves"), ["id", "node"]))
    groups = tops(levels).select(F.lit("").alias("g"), F.col("g").alias("of"), "node")
    roots = climbed(positioned(groups, ["of"]))
    root = tops(roots).select("g", F.expr(f"cast(array() as {PATH})").alias("path"), F.col("node").alias("root"))
    subroots = stored(descended(roots, root).select(F.col("of").alias("g"), F.col("node").alias("subroot"), "path", "root"), "merkle-subroots")
    return descended(levels, subroots).select(F.col("id").alias(id_col), F.col("node").alias("leaf"), "subroot", "root", "path", "now")
