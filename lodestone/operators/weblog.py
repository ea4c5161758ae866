"""Access-log parsing and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.session import stored

# Four numbers that stand alone; whether each fits a byte is checked by value.
QUAD = r"(?<![\d.])(\d{1,3}(?:\.\d{1,3}){3})(?!\.?\d)"
# The parts of an access-log line that the reports read.
VIDEO_PATTERN = r"([0-9]+\.mp4)"
SERVED_PATTERN = r"\s(200|206|304)\s([0-9]+)\s"


def hour_pattern(year: int) -> str:
    return rf"{year}:([0-9]{{2}}):[0-9]{{2}}:[0-9]{{2}}"


def _in_range(address: Column) -> Column:
    return F.forall(F.split(address, "\\."), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)) <= 255)


def ip_of(line: Column) -> Column:
    """The first dotted address of a line; '' if there is none or a number exceeds 255."""
    found = F.regexp_extract(line, QUAD, 1)
    return F.when(_in_range(found), found).otherwise("")


def top_ips(lines: DataFrame, k: int) -> DataFrame:
    """The ``k`` addresses with most hits, beside the number of distinct addresses; each line is parsed once."""
    hits = lines.select(F.regexp_extract("value", QUAD, 1).alias("ip")).groupBy("ip").agg(F.count(F.lit(1)).alias("hits"))
    hits = stored(hits.where((F.col("ip") != "") & _in_range(F.col("ip"))), "hits")  # the check takes one row per address
    total = hits.agg(F.count(F.lit(1)).alias("n_ips"))  # one row
    return hits.orderBy(F.col("hits").desc(), "ip").limit(k).join(F.broadcast(total))


def video_audience(lines: DataFrame, k: int) -> DataFrame:
    """The ``k`` videos seen from most distinct addresses; a line without a valid one counts for none."""
    video = F.regexp_extract("value", VIDEO_PATTERN, 1)
    seen = lines.select(video.alias("video"), F.nullif(ip_of(F.col("value")), F.lit("")).alias("ip")).where("video <> ''")
    return seen.groupBy("video").agg(F.countDistinct("ip").alias("n_ips")).orderBy(F.col("n_ips").desc(), "video").limit(k)


def hourly_traffic(lines: DataFrame, year: int) -> DataFrame:
    """Bytes served per hour of the day, counting only successful replies."""
    parsed = lines.where(F.col("value").rlike(SERVED_PATTERN) & F.col("value").rlike(hour_pattern(year))).select(
        F.regexp_extract("value", hour_pattern(year), 1).alias("hour"),
        F.regexp_extract("value", SERVED_PATTERN, 2).cast("bigint").alias("size"),
    )
    served = parsed.groupBy("hour").agg(F.sum("size").alias("bytes"))
    return served.withColumn("gigabytes", F.round(F.col("bytes") / (1 << 30), 6))
