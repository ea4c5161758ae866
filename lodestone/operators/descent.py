"""Linear models by mini-batch gradient descent; all points of a sweep share each pass over the rows.

A pass multiplies blocks of rows with the weights of every point at once, adds up the gradients in its task and hands on one
row per task. Which rows belong to the batch of an iteration depends on a hash of their key, so that a recomputed task sees the
same batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.session import stored

LOSSES = ("logistic", "hinge", "squared")


@dataclass(frozen=True)
class Point:
    """One setting of a sweep: first step size, weights of the L1 and the L2 penalty."""

    step: float
    l2: float = 0.0
    l1: float = 0.0


@dataclass(frozen=True)
class Progress:
    """What one iteration saw: rows of the batch and, per point, the penalised mean loss before the step."""

    iteration: int
    rows: int
    losses: tuple[float, ...]


def in_batch(key: Column, iteration: int, fraction: float) -> Column:
    """Whether the row with this key belongs to the batch of an iteration."""
    if fraction >= 1:
        return F.lit(True)
    return F.substring(F.md5(F.concat_ws("-", key, F.lit(iteration))), 1, 8) < f"{int(fraction * (1 << 32)):08x}"


def slopes(loss: str, margins: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Losses and their derivatives by the margin; labels are 0 or 1, for the squared loss any number."""
    y = labels[:, None]
    if loss == "squared":
        return (margins - y) ** 2 / 2, margins - y
    signed = (2 * y - 1) * margins
    if loss == "hinge":
        return np.maximum(0, 1 - signed), np.where(signed < 1, 1 - 2 * y, 0.0)
    return np.logaddexp(0, -signed), np.exp(-np.logaddexp(0, -margins)) - y


def _gradients(batch: DataFrame, weights: np.ndarray, loss: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, summed losses (points) and summed gradients (points x features) of (label, features)."""
    points, width = weights.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, np.zeros(points * (width + 1))
        for part in batches:
            if not part.num_rows:
                continue
            x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            losses, errors = slopes(loss, x @ weights.T, part.column(0).to_numpy(zero_copy_only=False))
            rows += len(x)
            total[:points] += losses.sum(axis=0)
            total[points:] += (errors.T @ x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([total], pa.list_(pa.float64()))], names=["rows", "sums"])

    parts = batch.select(F.col("label").cast("double"), "features").mapInArrow(run, "rows bigint, sums array<double>")
    slots = parts.select("rows", F.posexplode("sums").alias("slot", "x")).groupBy("slot").agg(F.sum("rows").alias("rows"), F.sum("x").alias("x"))
    found = slots.orderBy("slot").toPandas()  # as many rows as the models have weights
    if found.empty:
        return 0, np.zeros(points), np.zeros(weights.shape)
    sums = found["x"].to_numpy()
    return int(found["rows"][0]), sums[:points], sums[points:].reshape(points, width)


def descend(
    df: DataFrame, key: Column, label: Column, features: Column, points: Sequence[Point],
    iterations: int, loss: str = "logistic", fraction: float = 1.0, tolerance: float = 0.0,
) -> tuple[np.ndarray, list[Progress]]:
    """Weights of every point (points x features), and the progress of all iterations.

    Iteration t takes the mean gradient g of its batch and steps by step / sqrt(t): with the L2 penalty
    w <- (1 - eta l2) w - eta g, then every weight is drawn towards 0 by eta l1. A point whose weights move by less than
    `tolerance` times their length (1 at least) stays as it is. All feature arrays have one length; put a 1 among them for an
    intercept. Rows with a NULL label or NULL features are left out; an empty batch moves nothing.
    """
    if loss not in LOSSES:
        raise ValueError(f"loss is one of {LOSSES}")
    rows = df.select(key.cast("string").alias("key"), label.cast("double").alias("label"), features.cast("array<double>").alias("features"))
    rows = stored(rows.where("label IS NOT NULL AND features IS NOT NULL"), "training")
    first = rows.select(F.size("features")).first()
    if first is None:
        return np.zeros((len(points), 0)), []
    weights, moving, progress = np.zeros((len(points), first[0])), np.ones(len(points), bool), []
    steps, l1, l2 = (np.array([getattr(p, name) for p in points])[:, None] for name in ("step", "l1", "l2"))
    for t in range(1, iterations + 1):
        n, losses, sums = _gradients(rows.where(in_batch(F.col("key"), t, fraction)), weights, loss)
        if not n:
            progress.append(Progress(t, 0, (float("nan"),) * len(points)))
            continue
        penalty = l2[:, 0] / 2 * (weights**2).sum(axis=1) + l1[:, 0] * np.abs(weights).sum(axis=1)
        progress.append(Progress(t, n, tuple(losses / n + penalty)))
        eta = steps / np.sqrt(t)
        moved = (1 - eta * l2) * weights - eta * sums / n
        moved = np.sign(moved) * np.maximum(0, np.abs(moved) - eta * l1)
        moved = np.where(moving[:, None], moved, weights)
        if tolerance:
            moving &= np.linalg.norm(moved - weights, axis=1) >= tolerance * np.maximum(1, np.linalg.norm(moved, axis=1))
        weights = moved
        if not moving.any():
            break
    return weights, progress


def margin(features: Column, weights: Sequence[float]) -> Column:
    """The weighted sum of a feature array."""
    given = F.array(*[F.lit(float(w)) for w in weights])
    return F.aggregate(F.zip_with(features.cast("array<double>"), given, lambda x, w: x * w), F.lit(0.0), lambda total, x: total + x)
