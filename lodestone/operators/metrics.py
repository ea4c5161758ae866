"""Evaluation metrics as DataFrame algebra.

Curves are computed on one row per distinct score, scanned in order without a single
partition, so they work for any number of scored rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.operators.ordered import with_group_values, with_neighbours, with_running
from lodestone.session import stored


def score_counts(df: DataFrame, score: str, label: str, keys: list[str] | None = None) -> DataFrame:
    """Positive and negative rows per distinct score."""
    positive = F.col(label) == 1
    return df.groupBy(*(keys or []), F.col(score).alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )


def area_under_roc(df: DataFrame, score: str, label: str, keys: list[str] | None = None) -> DataFrame:
    """Probability that a positive row outscores a negative one; ties count half."""
    return auc_of_counts(score_counts(df, score, label, keys), keys or [])


def auc_of_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Area under ROC from (score, pos, neg) rows, one per score and key."""
    counts = with_running(stored(counts, "scores"), keys, ["score"], {"_neg": ("sum", F.col("neg"))})
    wins = F.col("pos") * (F.col("_neg") - F.col("neg") + F.col("neg") / 2)
    return counts.groupBy(*keys).agg(F.try_divide(F.sum(wins), F.sum("pos") * F.sum("neg")).alias("auc"))


def threshold_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """Cumulative true and false positives per threshold, from the highest score down."""
    counts = stored(score_counts(df, score, label), "scores")
    totals = with_group_values(counts, [], positives=F.sum("pos"), negatives=F.sum("neg"))
    return with_running(totals, [], [F.col("score").desc()], {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))})


def roc_points(df: DataFrame, score: str, label: str) -> DataFrame:
    points = threshold_points(df, score, label)
    return points.select(
        F.col("score").alias("threshold"), F.try_divide("fp", "negatives").alias("fpr"), F.try_divide("tp", "positives").alias("tpr")
    )


def area_under_pr(df: DataFrame, score: str, label: str) -> DataFrame:
    """Trapezoid area under (recall, precision); the first precision is carried to recall 0."""
    points = threshold_points(df, score, label).select(
        "score", (F.col("tp") / F.col("positives")).alias("recall"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision")
    )
    joined = with_neighbours(points, [], [F.col("score").desc()], {"_recall": ("recall", 1, 0.0), "_precision": ("precision", 1, None)})
    height = (F.col("precision") + F.coalesce("_precision", "precision")) / 2
    return joined.agg(F.sum((F.col("recall") - F.col("_recall")) * height).alias("area"))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    right = F.avg((F.col(label) == F.col(prediction)).cast("double"))
    return df.agg(right.alias("accuracy"), (1 - right).alias("error"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def class_report(cells: DataFrame) -> DataFrame:
    """Precision, recall and F per class, and the F weighted by class size, from the confusion cells."""
    # One row per cell and side; the table has as many rows as the confusion matrix.
    sides = cells.select("label", F.lit(0).alias("predicted"), "n", (F.col("label") == F.col("prediction")).alias("hit")).unionByName(
        cells.select(F.col("prediction").alias("label"), F.lit(1).alias("predicted"), "n", (F.col("label") == F.col("prediction")).alias("hit"))
    )
    counts = sides.groupBy("label").agg(
        F.sum(F.when((F.col("predicted") == 0) & F.col("hit"), F.col("n")).otherwise(0)).alias("hits"),
        F.sum(F.when(F.col("predicted") == 0, F.col("n")).otherwise(0)).alias("actual"),
        F.sum(F.when(F.col("predicted") == 1, F.col("n")).otherwise(0)).alias("predicted"),
    )
    p = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    r = F.coalesce(F.try_divide("hits", "actual"), F.lit(0.0))
    scored = counts.select("label", "actual", p.alias("precision"), r.alias("recall"))
    f = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    scored = scored.withColumn("f1", f)
    return with_group_values(scored, [], weighted_f1=F.sum(F.col("f1") * F.col("actual")) / F.sum("actual"))


def squared_error(df: DataFrame, actual: Column, predicted: Column) -> DataFrame:
    mse = F.avg((actual - predicted) * (actual - predicted))
    return df.agg(mse.alias("mse"), F.sqrt(mse).alias("rmse"))


def average_precision(actual: DataFrame, predicted: DataFrame, user: str, item: str, place: str, k: int, cut: bool = True) -> DataFrame:
    """Average precision of each user's first ``k`` predictions, by place.

    Hits are found by an equi-join, at most ``k`` per user. With ``cut`` the divisor is
    least(actual items, k), and a user without actual items scores 1; without it the divisor
    is the number of actual items, and such a user scores 0.
    """
    first = predicted.where(F.col(place) <= k)
    seen = actual.select(user, item).distinct()
    sizes = seen.groupBy(user).agg(F.count(F.lit(1)).alias("_actual"))
    order = Window.partitionBy(user).orderBy(place)  # at most k rows per user
    hits = first.join(seen, [user, item]).withColumn("_hit", F.row_number().over(order))
    scores = hits.groupBy(user).agg(F.sum(F.col("_hit") / F.col(place)).alias("_score"))
    users = predicted.select(user).distinct().join(sizes, user, "left").join(scores, user, "left")
    divisor = F.least(F.col("_actual"), F.lit(k)) if cut else F.col("_actual")
    value = F.when(F.col("_actual").isNull(), F.lit(1.0 if cut else 0.0)).otherwise(F.coalesce("_score", F.lit(0.0)) / divisor)
    return users.select(user, value.alias("ap"))
