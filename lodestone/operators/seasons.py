"""Season scores: z-scores per season, weighted rate statistics, normalised scores, careers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.ordered import with_group_values, with_neighbours


@dataclass(frozen=True)
class Stat:
    """One scored statistic. A rate names its attempts column; a loss counts against the score."""

    name: str
    attempts: str | None = None
    loss: bool = False


def _divide(top: Column, bottom: Column) -> Column:
    return top / F.nullif(bottom, F.lit(0.0))


def season_scores(df: DataFrame, season: str, stats: Sequence[Stat]) -> DataFrame:
    """Add z_<stat>, z_total, n_<stat> and n_total.

    A rate is first weighted, (value - season mean) * attempts, and the weighted values are
    standardised again. The normalised score divides by the season's largest magnitude.
    Seasons are few, so both statistics tables are small; Spark decides how to join them.
    """
    means = {}
    for s in stats:
        means[f"_avg_{s.name}"] = F.avg(s.name)
        means[f"_std_{s.name}"] = F.stddev_pop(s.name)
    first = with_group_values(df, [season], **means)
    scored = first.withColumns({f"_w_{s.name}": _first_score(s) for s in stats}).drop(*means)

    spread = {}
    for s in stats:
        if s.attempts:  # only rates are standardised again
            spread[f"_avg_{s.name}"] = F.avg(f"_w_{s.name}")
            spread[f"_std_{s.name}"] = F.stddev_pop(f"_w_{s.name}")
        spread[f"_max_{s.name}"] = F.max(f"_w_{s.name}")
        spread[f"_min_{s.name}"] = F.min(f"_w_{s.name}")
    second = with_group_values(scored, [season], **spread)
    z = {f"z_{s.name}": _final_score(s, F.col(f"_w_{s.name}")) for s in stats}
    n = {}
    for s in stats:
        largest = F.greatest(F.abs(_final_score(s, F.col(f"_max_{s.name}"))), F.abs(_final_score(s, F.col(f"_min_{s.name}"))))
        n[f"n_{s.name}"] = _divide(F.col(f"z_{s.name}"), largest)
    out = second.withColumns(z)
    out = out.withColumns(n)
    out = out.withColumns({"z_total": _sum(z), "n_total": _sum(n)})
    return out.select(*df.columns, *z, "z_total", *n, "n_total")


def _first_score(s: Stat) -> Column:
    distance = F.col(s.name) - F.col(f"_avg_{s.name}")
    if s.attempts:
        return distance * F.col(s.attempts)
    score = _divide(distance, F.col(f"_std_{s.name}"))
    return -score if s.loss else score


def _final_score(s: Stat, value: Column) -> Column:
    if not s.attempts:
        return value
    return _divide(value - F.col(f"_avg_{s.name}"), F.col(f"_std_{s.name}"))


def _sum(names) -> Column:
    total = F.lit(0.0)
    for name in names:
        total = total + F.col(name)
    return total


def careers(df: DataFrame, entity: str, season: str, values: Sequence[str]) -> DataFrame:
    """Add ``exp`` (seasons since the entity's first) and the change of each value since its last season."""
    beside = with_group_values(df, [entity], _first=F.min(season))
    last = with_neighbours(beside, [entity], [season], {f"_last_{v}": (v, 1, None) for v in values})
    deltas = {f"delta_{v}": F.col(v) - F.col(f"_last_{v}") for v in values}
    out = last.withColumns({"exp": F.col(season) - F.col("_first"), **deltas})
    return out.select(*df.columns, "exp", *deltas)


def started_after(df: DataFrame, entity: str, season: str, first_season: int) -> DataFrame:
    """Drop entities seen in the first season of the data, whose careers are only partly known."""
    known = df.where(F.col(season) == first_season).select(entity).distinct()
    return df.join(known, entity, "left_anti")


def curve(df: DataFrame, by: str, values: Sequence[str]) -> DataFrame:
    """Count, mean, population deviation, max and min of each value per age or experience."""
    aggregates = []
    for v in values:
        aggregates += [
            F.count(v).alias(f"{v}_count"), F.avg(v).alias(f"{v}_mean"), F.stddev_pop(v).alias(f"{v}_stdev"),
            F.max(v).alias(f"{v}_max"), F.min(v).alias(f"{v}_min"),
        ]
    return df.groupBy(by).agg(*aggregates)
