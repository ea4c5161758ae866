"""Feature engineering beyond the ready-made transformers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.ordered import chunked_lists, with_group_values, with_row_number, with_running
from lodestone.session import stored


def vector(*columns: str) -> Column:
    """A vector of numeric columns."""
    return array_to_vector(F.array(*[F.col(c).cast("double") for c in columns]))


def apply(df: DataFrame, stage, column: str, digits: int = 6) -> DataFrame:
    """Fit the stage when it needs fitting, transform, and turn its vector output into a rounded array."""
    model = stage if isinstance(stage, Transformer) else stage.fit(df)
    values = vector_to_array(F.col(column))
    return model.transform(df).withColumn(column, F.transform(values, lambda x: F.round(x, digits) + F.lit(0.0)))


def quantile_splits(df: DataFrame, column: str, buckets: int) -> list[float]:
    """Exact split points: the value at rank ceil(n * i / buckets) for each inner split.

    Distinct values are counted and scanned in slices; only the split points reach the driver. NULL and NaN have no rank; a
    column without any other value has no split points.
    """
    x = F.col(column).cast("double")
    values = stored(df.where(x.isNotNull() & ~F.isnan(x)).groupBy(x.alias("x")).agg(F.count(F.lit(1)).alias("_rows")), "values")
    total = values.agg(F.sum("_rows")).first()[0]
    if not total:
        return []
    scanned = with_running(values, [], ["x"], {"_upto": ("sum", F.col("_rows"))})
    ranks = [-(-total * i // buckets) for i in range(1, buckets)]
    row = scanned.agg(*[F.min(F.when(F.col("_upto") >= r, F.col("x"))).alias(f"q{i}") for i, r in enumerate(ranks)]).first()
    return sorted(set(row))


def quantile_buckets(df: DataFrame, column: str, buckets: int, name: str) -> DataFrame:
    """Discretise a column into buckets of about equal size, each closed on the left."""
    splits = [float("-inf"), *quantile_splits(df, column, buckets), float("inf")]
    return Bucketizer(splits=splits, inputCol=column, outputCol=name).transform(df)


def chi_square(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Chi-square statistic and degrees of freedom of each categorical feature against the label.

    One pass counts (feature, value, label); everything after works on the contingency table.
    """
    long = df.select(F.col(label).alias("label"), *[F.col(f).cast("string").alias(f) for f in features]).unpivot(
        ["label"], list(features), "feature", "value"
    )
    cells = long.groupBy("feature", "value", "label").agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy("feature", "value").agg(F.sum("n").alias("row_n"))
    columns = cells.groupBy("feature", "label").agg(F.sum("n").alias("column_n"))
    joined = cells.join(rows, ["feature", "value"]).join(columns, ["feature", "label"])
    shares = joined.groupBy("feature").agg(
        F.sum("n").alias("total"),
        F.sum(F.col("n") * F.col("n") / (F.col("row_n") * F.col("column_n"))).alias("share"),
        F.countDistinct("value").alias("values"),
        F.countDistinct("label").alias("labels"),
    )
    return shares.select(
        "feature", (F.col("total") * (F.col("share") - 1)).alias("statistic"), ((F.col("values") - 1) * (F.col("labels") - 1)).alias("freedom")
    )


def top_features(statistics: DataFrame, n: int) -> DataFrame:
    return statistics.orderBy(F.col("statistic").desc(), "feature").limit(n)


def target_mean(df: DataFrame, column: str, positive: Column, name: str) -> DataFrame:
    """Put the positive rate of the row's own value beside the row."""
    return with_group_values(df, [column], **{name: F.avg(positive.cast("double"))})


def dictionary(df: DataFrame, column: str, name: str = "idx") -> DataFrame:
    """Number the distinct values from 0 in sorted order."""
    values = df.select(column).distinct()
    return with_row_number(values, [], [column], "_n").select(column, (F.col("_n") - 1).alias(name))


def multi_hot(items: DataFrame, key: str, item: str, words: DataFrame, name: str = "slots") -> DataFrame:
    """Sorted dictionary slots of each key's items; a list is never longer than the dictionary."""
    pairs = items.select(key, item).distinct().join(words, item)
    return pairs.groupBy(key).agg(F.array_sort(F.collect_set("idx")).alias(name))


def balance_ratio(label: Column) -> Column:
    """Share of positive rows: the weight of a negative row; positive rows get the rest."""
    return F.avg(label.cast("double"))


def class_weight(df: DataFrame, label: str, name: str) -> DataFrame:
    ratio = with_group_values(df, [], _ratio=balance_ratio(F.col(label)))
    return ratio.withColumn(name, F.when(F.col(label) == 0, F.col("_ratio")).otherwise(1 - F.col("_ratio"))).drop("_ratio")


def sparse_rows(cells: DataFrame, key: str, slot: str, value: str, size: int) -> DataFrame:
    """Each key's (slot, value) cells as sorted ``slot:value`` text, at most ``size`` cells per row."""
    text = F.concat_ws(":", F.col(slot), F.col(value))
    lists = chunked_lists(cells, [key], [slot], text, size, "_cells")
    return lists.select(key, "chunk", F.array_join("_cells", " ").alias("cells"))


__all__ = [
    "apply", "balance_ratio", "chi_square", "class_weight", "dictionary", "multi_hot", "quantile_buckets", "quantile_splits",
    "sparse_rows", "target_mean", "top_features", "vector",
]
