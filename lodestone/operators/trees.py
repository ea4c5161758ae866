"""Decision trees and forests grown level by level from histograms.

One aggregation per level counts rows by (tree, node, feature, bin, label) with map-side combine; all trees of a forest share
it. The best split of every node comes from running sums over its bins, and rows find their node again by walking the splits
so far, which are as many as the trees have nodes. Rows are never sorted, sampled or moved.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.session import stored

#: P(a Poisson number of mean 1 is at most k), k = 0, 1, ...
_POISSON = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.999989750803325)


@dataclass
class Forest:
    """Splits (feature, bin) by tree and node; rows with a bin above the split's go right. Node k has children 2k+1 and 2k+2."""

    trees: int
    depth: int
    splits: list[dict[int, tuple[int, int]]] = field(default_factory=list)
    nodes: list[DataFrame] = field(default_factory=list)

    def node(self, bins: Column, tree: int) -> Column:
        """The node that a row of bins reaches by the splits so far."""
        known = [self.splits[tree].get(k, (-1, 0)) for k in range((1 << (self.depth + 1)) - 1)]
        features, borders = (F.array(*[F.lit(s[i]) for s in known]) for i in (0, 1))

        def step(at: Column, _: Column) -> Column:
            feature = F.element_at(features, at + 1)
            right = F.element_at(bins, F.greatest(feature, F.lit(0)) + 1) > F.element_at(borders, at + 1)
            return F.when(feature >= 0, 2 * at + 1 + right.cast("int")).otherwise(at)

        return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, self.depth))), F.lit(0), step)


def equal_width_bins(value: Column, low: Column, high: Column, bins: int) -> Column:
    """The number of the value's bin between low and high, from 0; values outside fall into the outer bins."""
    place = F.floor((value - low) / (high - low) * bins)
    return F.when(high > low, F.least(F.lit(bins - 1), F.greatest(F.lit(0), place))).otherwise(F.lit(0)).cast("int")


def bootstrap_weight(key: Column, tree: int) -> Column:
    """How often the row with this key is drawn for a tree: a Poisson number of mean 1 from the hash of both."""
    drawn = F.substring(F.md5(F.concat_ws("-", key, F.lit(tree))), 1, 8)
    return F.transform(F.array(drawn), lambda d: sum((d >= f"{int(p * (1 << 32)):08x}").cast("int") for p in _POISSON))[0]  # one hash, not one for each bound


def impurity(kind: str, pos: Column, n: Column) -> Column:
    """Gini impurity or entropy (in bits) of two classes."""
    p = pos / n
    if kind == "gini":
        return 2 * p * (1 - p)
    if kind == "entropy":
        part = lambda x: F.when(x > 0, -x * F.log2(x)).otherwise(0.0)
        return part(p) + part(1 - p)
    raise ValueError("impurity is gini or entropy")


def _allowed(tree: Column, node: Column, feature: Column, features: int) -> Column:
    """Features in a random order of their own for every node, by hash."""
    return F.row_number().over(Window.partitionBy("tree", "node").orderBy(F.md5(F.concat_ws("-", tree, node, feature)))) <= features


def best_splits(histograms: DataFrame, kind: str, least_rows: int, features: int | None = None) -> DataFrame:
    """(tree, node, n, pos, feature, border, gain) from counts (tree, node, feature, bin, n, pos).

    The split of the largest gain (to nine digits) wins, then the least feature and bin; a node without a gain, or whose parts
    would have fewer than `least_rows` rows, has NULLs. With `features`, each node may use so many, chosen by hash.
    """
    upto = Window.partitionBy("tree", "node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("tree", "node", "feature")
    cuts = histograms.select(
        "tree", "node", "feature", "bin", F.sum("n").over(upto).alias("ln"), F.sum("pos").over(upto).alias("lp"),
        F.sum("n").over(whole).alias("n"), F.sum("pos").over(whole).alias("pos"),
    )
    rn, rp = F.col("n") - F.col("ln"), F.col("pos") - F.col("lp")
    gain = impurity(kind, F.col("pos"), F.col("n")) - (F.col("ln") * impurity(kind, F.col("lp"), F.col("ln")) + rn * impurity(kind, rp, rn)) / F.col("n")
    fits = (F.col("ln") >= least_rows) & (rn >= least_rows)
    cuts = cuts.withColumn("gain", F.when(fits, F.round(gain, 9)))
    nodes = cuts.groupBy("tree", "node").agg(F.max("n").alias("n"), F.max("pos").alias("pos"))
    if features is not None:
        chosen = cuts.select("tree", "node", "feature").distinct()
        chosen = chosen.withColumn("allowed", _allowed(F.col("tree"), F.col("node"), F.col("feature"), features)).where("allowed")
        cuts = cuts.join(chosen.drop("allowed"), ["tree", "node", "feature"])
    order = Window.partitionBy("tree", "node").orderBy(F.desc("gain"), "feature", "bin")
    best = cuts.where("gain > 0").withColumn("place", F.row_number().over(order)).where("place = 1")
    return nodes.join(best.select("tree", "node", "feature", F.col("bin").alias("border"), "gain"), ["tree", "node"], "left")


def grow(
    rows: DataFrame, depth: int, kind: str = "gini", least_rows: int = 1, weights: Sequence[Column] | None = None, features: int | None = None,
) -> Forest:
    """A forest from rows of (label 0 or 1, bins array<int>), one tree for each column of row weights, or one tree.

    `nodes` of the result holds one table per level: (tree, node, n, pos, feature, border, gain), n and pos being weighted
    counts. Rows with a NULL label or NULL bins are left out; without rows a tree has no node. Every level computes the weights
    again: store those that are costly, as `bootstrap_weight` is.
    """
    weights = weights or [F.lit(1)]
    forest = Forest(len(weights), depth, [{} for _ in weights])
    rows = rows.where("label IS NOT NULL AND bins IS NOT NULL")
    for level in range(depth + 1):
        first = (1 << level) - 1
        of_tree = [F.struct(F.lit(t).alias("tree"), forest.node(F.col("bins"), t).alias("node"), w.cast("bigint").alias("w")) for t, w in enumerate(weights)]
        placed = rows.select("label", "bins", F.inline(F.array(*of_tree))).where(f"w > 0 AND node >= {first}")
        cells = placed.select("tree", "node", "label", "w", F.posexplode("bins").alias("feature", "bin"))
        counts = cells.groupBy("tree", "node", "feature", "bin").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("label").cast("bigint")).alias("pos"))
        table = stored(best_splits(counts, kind, least_rows, features), "tree-level")  # at most trees * 2^level rows
        if level == depth:
            table = table.withColumns({c: F.lit(None).cast(table.schema[c].dataType) for c in ("feature", "border", "gain")})
        forest.nodes.append(table)
        for split in [] if level == depth else table.where("feature IS NOT NULL").collect():
            forest.splits[split["tree"]][split["node"]] = (split["feature"], split["border"])
    return forest


def leaves(forest: Forest) -> DataFrame:
    """(tree, node, n, pos) of all nodes of all levels."""
    out = forest.nodes[0]
    for level in forest.nodes[1:]:
        out = out.unionByName(level)
    return out


def votes(rows: DataFrame, forest: Forest, trees: Sequence[Column]) -> Column:
    """The share of the trees that say 1 for a row, among those whose condition holds; NULL where none does.

    A node says 1 if more than half of its weight has label 1. The nodes' table is small and becomes a lookup array.
    """
    says = {(r["tree"], r["node"]): int(2 * r["pos"] > r["n"]) for r in leaves(forest).collect()}  # trees * 2^(depth + 1) rows
    size = (1 << (forest.depth + 1)) - 1
    cast = [F.element_at(F.array(*[F.lit(says.get((t, k), 0)) for k in range(size)]), forest.node(F.col("bins"), t) + 1) for t in range(forest.trees)]
    yes = sum(F.when(use, vote).otherwise(0) for use, vote in zip(trees, cast))
    asked = sum(use.cast("int") for use in trees)
    return F.when(asked > 0, yes / asked)
