"""Column expressions: time, text, arrays and vectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone is."""
    seconds = F.unix_date(F.to_date(ts)).cast("bigint") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def from_epoch_micros(micros: Column) -> Column:
    """The zone-less timestamp that lies so many microseconds after 1970."""
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return start + F.make_dt_interval(secs=(micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)"))


def instant(ts: Column) -> Column:
    """A zone-less timestamp read as UTC, as an instant that watermarks accept."""
    return F.timestamp_micros(epoch_micros(ts))


def zoneless(ts: Column) -> Column:
    """An instant written as a zone-less UTC timestamp."""
    return from_epoch_micros(F.unix_micros(ts))


def calendar(ts: Column) -> dict[str, Column]:
    """Calendar parts of a date: weekday counts from 0 = Sunday, period is the third of the month."""
    day = F.dayofmonth(ts)
    parts = {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": day,
        "weekday": F.dayofweek(ts) - 1,
        "week": F.weekofyear(ts),
        "quarter": F.quarter(ts),
        "period": F.when(day <= 10, 1).when(day <= 20, 2).otherwise(3),
        "halfmonth": F.when(day <= 15, 1).otherwise(2),
    }
    return {name: value.cast("bigint") for name, value in parts.items()}


def after_marker(text: Column, marker: str) -> Column:
    """The trimmed text between the first marker and the next, or the whole text without one."""
    pieces = F.split_part(text, F.lit(marker), F.lit(2))
    return F.when(F.contains(text, F.lit(marker)), F.trim(pieces)).otherwise(text)


def blank_to_zero(text: Column) -> Column:
    """An empty field counts as 0."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit("0"))


def lookup_literal(key: Column, names: Mapping) -> Column:
    """Look a key up in a small literal dictionary; a missing key gives NULL."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def flags_to_names(flags: Column, names: Sequence[str]) -> Column:
    """Names of the set flags, in order."""
    marked = F.transform(flags, lambda flag, i: F.when(flag, F.element_at(F.array(*[F.lit(n) for n in names]), i + 1)))
    return F.array_compact(marked)


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Sum of the element-wise products, added from the first slot to the last."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; NULL when a vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def hadamard(a: Column, weights: Column) -> Column:
    return F.zip_with(a, weights, lambda x, y: x * y)


def equal_up_to_sign(a: Column, b: Column, tolerance: float) -> Column:
    """Whether all slots have the same magnitude within a tolerance."""
    return F.forall(F.zip_with(a, b, lambda x, y: F.abs(F.abs(x) - F.abs(y)) <= tolerance), lambda same: same)


def sigmoid_score(features: Sequence[Column], weights: Sequence[float], intercept: float) -> Column:
    """Logistic score of a row under given weights."""
    total = F.lit(float(intercept))
    for feature, weight in zip(features, weights):
        total = total + feature * F.lit(float(weight))
    return 1 / (1 + F.exp(-total))


def rounded(vector: Column, digits: int) -> Column:
    """Round every slot; adding 0.0 turns a negative zero into zero."""
    return F.transform(vector, lambda x: F.round(x, digits) + F.lit(0.0))
