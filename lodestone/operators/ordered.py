"""Ordered scans: row numbers, ranks, running aggregates, neighbours, exact quantiles.

A plain window sends each partition-by group to one task. That is right while groups are
small, so the size of the largest group is checked first. Beyond the bound the rows are
range-partitioned into slices by (group, order), each slice is scanned by itself, and the
totals of the earlier slices of the same group are added. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType

from lodestone.session import stored

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
GROUP_ROWS_SETTING = "spark.lodestone.maxGroupRows"
GROUP_ROWS = 2_000_000

_AGGREGATES = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes, its texts and lists by their length."""
    size = F.lit(16)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            size = size + 16 + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, AtomicType):
            size = size + 16
        else:
            size = size + 32 + F.coalesce(F.octet_length(column.cast("string")), F.lit(0))
    return size


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a table for broadcast when it is counted to hold at most ``rows`` rows and ``most`` bytes; store a table that is costly to compute.

    A larger table is returned as it is, and Spark picks a shuffled join, which splits skewed partitions at run time.
    """
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df).cast("bigint")), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and size <= most else df


def group_row_bound(df: DataFrame) -> int:
    """Rows of one group that a single task may hold; a session setting overrides it."""
    return int(df.sparkSession.conf.get(GROUP_ROWS_SETTING, str(GROUP_ROWS)))


def groups_fit(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether no group holds more rows than one task may sort."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0]
    return (largest or 0) <= group_row_bound(df)


def null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Join condition on equal columns that also pairs NULL with NULL."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def in_slices(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Rows range-partitioned by (keys, order) and stored with their slice number; as many slices as the rows need."""
    bound = group_row_bound(df)
    slices = max(2, -(-df.count() // bound)) if bound > 0 else 8
    ranged = df.repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id())
    return stored(ranged, "slices")


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    measures: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """Add running aggregates from the group's first row up to and including the current row.

    ``measures`` maps a new column to (sum | count | min | max, input column). The order
    must be total within each group for a deterministic result.
    """
    if groups_fit(df, keys):
        frame = _up_to_here(keys, order)
        return df.select("*", *[_AGGREGATES[f](c).over(frame).alias(n) for n, (f, c) in measures.items()])

    rows = in_slices(df, keys, order)
    inputs = {n: f"_in_{i}" for i, n in enumerate(measures)}
    rows = rows.select("*", *[c.alias(inputs[n]) for n, (_, c) in measures.items()])
    totals = rows.groupBy("_slice", *keys).agg(
        *[_AGGREGATES[f](inputs[n]).alias(n) for n, (f, _) in measures.items()]
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    merge = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    # Only groups that cross a slice border need a carry: at most two rows per slice.
    carried = totals.select(
        F.col("_slice").alias("_from"),
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("_parts"),
        *[merge[f](n).over(before).alias(f"_before_{n}") for n, (f, _) in measures.items()],
    ).where("_parts > 1").drop("_parts")
    frame = _up_to_here(["_slice", *keys], order)
    local = rows.select("*", *[_AGGREGATES[f](inputs[n]).over(frame).alias(f"_here_{n}") for n, (f, _) in measures.items()])
    condition = F.col("_slice") == F.col("_from")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    joined = local.join(F.broadcast(carried), condition, "left")
    return joined.select(*df.columns, *[_carry(f, n).alias(n) for n, (f, _) in measures.items()])


def _up_to_here(keys, order):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _carry(function: str, name: str) -> Column:
    here, before = F.col(f"_here_{name}"), F.col(f"_before_{name}")
    if function == "min":
        return F.least(here, before)
    if function == "max":
        return F.greatest(here, before)
    return F.coalesce(here + before, here, before)


def with_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str) -> DataFrame:
    """Number the rows of each group from 1; with no keys this numbers the whole table."""
    return with_running(df, keys, order, {name: ("count", F.lit(1))})


def with_rank(
    df: DataFrame, keys: Sequence[str], by: str, name: str, descending: bool = False, dense: bool = False
) -> DataFrame:
    """Add rank() or dense_rank() of one column within each group.

    Beyond the group bound the distinct values are counted first (map-side combine), the
    counts are scanned in order, and the ranks are joined back to the rows.
    """
    order = F.col(by).desc() if descending else F.col(by).asc()
    if groups_fit(df, keys):
        function = F.dense_rank() if dense else F.rank()
        return df.select("*", function.over(Window.partitionBy(*keys).orderBy(order)).cast("bigint").alias(name))
    values = df.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("_peers"))
    scanned = with_running(values, keys, [order], {"_rows": ("sum", F.col("_peers")), "_values": ("count", F.lit(1))})
    rank = F.col("_values") if dense else F.col("_rows") - F.col("_peers") + 1
    ranks = scanned.select(*[F.col(k).alias(f"_r_{k}") for k in [*keys, by]], rank.cast("bigint").alias(name))
    condition = F.lit(True)
    for k in [*keys, by]:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return df.join(ranks, condition).select(*df.columns, name)


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    columns: Mapping[str, tuple[str, int, object]],
) -> DataFrame:
    """Add values of earlier (positive offset) or later (negative offset) rows of the group.

    ``columns`` maps a new column to (source column, offset, default when there is no such row).
    """
    if groups_fit(df, keys):
        spec = Window.partitionBy(*keys).orderBy(*order)
        return df.select(
            "*",
            *[
                (F.lag(c, k, d) if k > 0 else F.lead(c, -k, d)).over(spec).alias(n)
                for n, (c, k, d) in columns.items()
            ],
        )
    numbered = stored(with_row_number(df, keys, order, "_n"), "numbered")
    out = numbered
    for name, (source, offset, default) in columns.items():
        other = numbered.select(
            *[F.col(k).alias(f"_o_{k}") for k in keys],
            (F.col("_n") + offset).alias("_o_n"),
            F.col(source).alias("_o_value"),
        )
        condition = F.col("_n") == F.col("_o_n")
        for k in keys:
            condition = condition & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
        value = F.when(F.col("_o_n").isNull(), F.lit(default)).otherwise(F.col("_o_value"))
        out = out.join(other, condition, "left").select(*out.columns, value.alias(name))
    return out.drop("_n")


def with_group_values(df: DataFrame, keys: Sequence[str], /, **aggregates: Column) -> DataFrame:
    """Put aggregates of the group beside every row: aggregate with map-side combine, join back.

    The aggregates are stored and counted. A table of few groups is broadcast, so the rows are
    not shuffled on a handful of hot keys; otherwise the join is shuffled, and Spark splits
    skewed partitions at run time. Store an input that is costly to compute: it is read twice.
    """
    values = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    if not keys:
        return df.join(F.broadcast(values))  # one row
    renamed = stored(values.select(*[F.col(k).alias(f"_g_{k}") for k in keys], *aggregates), "groups")
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    return df.join(broadcast_if_small(renamed), condition).select(*df.columns, *aggregates)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str) -> DataFrame:
    """First ``n`` rows of each group.

    Spark limits every map task to ``n`` rows per group before the shuffle, so a hot group
    sends at most ``n`` rows per task.
    """
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(spec)).where(F.col(name) <= n).withColumn(name, F.col(name).cast("bigint"))


def exact_median(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Exact median per group: the middle value, or the mean of the two middle values.

    Values are counted first, so the shuffle carries distinct values, and no task collects
    a group's values in memory.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_rows"))
    values = with_group_values(stored(counts, "values"), keys, _total=F.sum("_rows"))
    scanned = with_running(values, keys, [F.col(column)], {"_upto": ("sum", F.col("_rows"))})
    low = F.expr("(_total + 1) div 2")
    high = F.expr("_total div 2 + 1")
    return scanned.groupBy(*keys).agg(
        (
            (F.min(F.when(F.col("_upto") >= low, F.col(column))) + F.min(F.when(F.col("_upto") >= high, F.col(column)))) / 2
        ).alias(name)
    )


def chunked_lists(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: Column, size: int, name: str
) -> DataFrame:
    """Collect the values of each group into sorted lists of at most ``size`` elements.

    Every value is kept; a large group becomes several rows numbered by ``chunk``.
    """
    numbered = with_row_number(df, keys, order, "_n")
    chunk = F.expr(f"(_n - 1) div {int(size)}").alias("chunk")
    rows = numbered.select(*keys, chunk, "_n", value.alias("_value"))
    pairs = F.array_sort(F.collect_list(F.struct("_n", "_value")))
    return rows.groupBy(*keys, "chunk").agg(F.transform(pairs, lambda p: p["_value"]).alias(name))
