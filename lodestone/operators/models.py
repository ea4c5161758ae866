"""Model training helpers around pyspark.ml: reports, sweeps, cluster reports, weight tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import columns as fn
from lodestone.operators.metrics import auc_of_counts
from lodestone.operators.ordered import top_per_group, with_running
from lodestone.session import stored


def binary_report(models: Mapping[str, object], df: DataFrame, label: str) -> DataFrame:
    """Accuracy, area under ROC and area under PR of several fitted models, one row each.

    Rows are ordered by the probability of the label, where a model gives one, else by the margin. All models' distinct scores
    are counted in one aggregation and scanned once, from the highest down; both areas come from the running counts.
    """
    scored = None
    for name, model in models.items():
        rows = model.transform(df)
        column = next((c for c in ("probability", "rawPrediction") if c in rows.columns), None)
        score = vector_to_array(column)[1] if column else F.col("prediction")
        rows = rows.select(F.lit(name).alias("model"), score.alias("score"), (F.col(label) == 1).alias("_yes"), (F.col(label) == F.col("prediction")).alias("_right"))
        scored = rows if scored is None else scored.unionByName(rows)
    counts = scored.groupBy("model", "score").agg(F.count_if("_yes").alias("pos"), F.count_if(~F.col("_yes")).alias("neg"), F.count_if("_right").alias("right"))
    points = with_running(stored(counts, "scores"), ["model"], [F.col("score").desc()], {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))})
    before = F.col("tp") - F.col("pos") + F.col("fp") - F.col("neg")  # rows with a higher score
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    earlier = F.when(before > 0, (F.col("tp") - F.col("pos")) / before).otherwise(precision)
    found = points.groupBy("model").agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.sum("right").alias("right"),
        F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2)).alias("wins"), F.sum(F.col("pos") * (precision + earlier) / 2).alias("area"),
    )
    return found.select("model", (F.col("right") / (F.col("p") + F.col("n"))).alias("accuracy"), F.try_divide("wins", F.col("p") * F.col("n")).alias("roc"), F.try_divide("area", F.col("p")).alias("pr"))


def grid_search(estimator: Estimator, grid: Mapping[str, Sequence], df: DataFrame, label: str, train_share: float, seed: int) -> DataFrame:
    """Fit every parameter combination, score it on the held-out share, and mark the best."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    points = builder.build()
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    split = TrainValidationSplit(
        estimator=estimator, estimatorParamMaps=points, evaluator=evaluator, trainRatio=train_share, seed=seed
    )
    scores = split.fit(df).validationMetrics
    rows = [(", ".join(f"{p.name}={point[p]}" for p in sorted(point, key=lambda p: p.name)), float(s)) for point, s in zip(points, scores)]
    best = max(s for _, s in rows)
    first = next(i for i, (_, s) in enumerate(rows) if s == best)
    return df.sparkSession.createDataFrame(
        [(name, s, i == first) for i, (name, s) in enumerate(rows)], "point string, area double, best boolean"
    )


def kmeans_sweep(train: DataFrame, test: DataFrame, column: str, ks: Sequence[int], seed: int) -> DataFrame:
    """Within-cluster sum of squares on held-out rows for each number of clusters."""
    out = None
    for k in ks:
        model = KMeans(k=k, seed=seed, maxIter=10, featuresCol=column).fit(train)
        centres = F.array(*[F.array(*[F.lit(float(x)) for x in centre]) for centre in model.clusterCenters()])
        point = vector_to_array(column)
        cost = fn.squared_distance(point, F.element_at(centres, F.col("prediction") + 1))
        row = model.transform(test).agg(F.lit(k).alias("k"), F.sum(cost).alias("wcss"), F.count(F.lit(1)).alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


def cluster_report(df: DataFrame, key: str, vector: str, cluster: str, centres: DataFrame, centre: str, n: int) -> DataFrame:
    """The n members nearest to each cluster's centre, with their squared distance."""
    joined = df.join(centres, cluster).withColumn("distance", F.round(fn.squared_distance(F.col(vector), F.col(centre)), 6))
    best = top_per_group(joined.select(cluster, key, "distance"), [cluster], [F.col("distance"), F.col(key)], n, "place")
    return best.select(cluster, key, "distance", "place")


def mean_vectors(df: DataFrame, vector: str, group: str, name: str) -> DataFrame:
    """Mean vector per group."""
    cells = df.select(group, F.posexplode(vector).alias("slot", "x")).groupBy(group, "slot").agg(F.avg("x").alias("x"))
    slots = F.array_sort(F.collect_list(F.struct("slot", "x")))  # as many entries as the vector has slots
    return cells.groupBy(group).agg(F.transform(slots, lambda s: s["x"]).alias(name))


def weight_table(spark: SparkSession, coefficients: Sequence[float], words: DataFrame, feature: str) -> DataFrame:
    """One weight per dictionary entry; there are as many rows as the model has coefficients."""
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(coefficients)], "idx bigint, weight double")
    return words.join(weights, "idx").select(feature, "weight")


def model_summary(spark: SparkSession, model) -> DataFrame:
    """What a fitted model holds, as (name, value) rows."""
    rows = []
    for name in ("intercept", "numNodes", "depth", "numFeatures", "numClasses"):
        if hasattr(model, name):
            rows.append((name, str(getattr(model, name))))
    if hasattr(model, "coefficients"):
        rows += [(f"coefficient {i}", str(float(w))) for i, w in enumerate(model.coefficients)]
    if hasattr(model, "toDebugString"):
        rows.append(("tree", model.toDebugString))
    return spark.createDataFrame(rows, "name string, value string")


def single_feature_auc(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Area under ROC of each categorical feature, its values scored by their positive rate.

    All features are counted in one pass; the curves work on one row per (feature, rate).
    """
    long = df.unpivot([label], list(features), "feature", "value")
    rates = long.groupBy("feature", "value").agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    scores = rates.groupBy("feature", (F.col("pos") / (F.col("pos") + F.col("neg"))).alias("score")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return auc_of_counts(scores, ["feature"])
