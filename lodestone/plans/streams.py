"""Streaming plans: the events table read as a file stream."""

from pyspark.sql import functions as F

from lodestone.functions import columns as fn
from lodestone.operators import ordered
from lodestone.plans.registry import query
from lodestone.session import scratch_path, stored
from lodestone.streaming import jobs, panes


def _events(t):
    # The pattern matches the table whether it is one file or a folder of files.
    return jobs.read_stream(t.spark, "parquet", t.events.schema, path=t.path("events") + "*")


@query("st_batch_count", "select event_type, count(*) n from events group by event_type")
def batch_count(t):
    """Counts of each batch by itself; their sum over the batches is the table's count."""

    def summary(batch):
        return batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))

    return jobs.per_batch(_events(t), summary, "batch-count").groupBy("event_type").agg(F.sum("n").alias("n"))


@query("st_running_count", "select event_type, count(*) n from events group by event_type")
def running_count(t):
    counts = _events(t).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return jobs.running_totals(counts, ["event_type"], "running-count")


@query("st_state_fn", "select user_id, count(*) seen, arg_max(value, ts) as last from events group by user_id")
def state_fn(t):
    rows = _events(t).withColumn("at", fn.epoch_micros(F.col("ts")))
    states = jobs.last_value_state(rows, "user_id", "at", "value", F.col("event_id"), 8)
    newest = jobs.running_totals(states, ["key", "salt"], "state-fn")
    return jobs.merge_last_values(newest).withColumnRenamed("key", "user_id")


_SLIDING_SQL = """
with p as (select event_type, ts, time_bucket(interval 6 hours, ts, timestamp '1970-01-01') b from events),
     w as (select b as start, event_type from p union all select b - interval 6 hours, event_type from p)"""


@query("st_sliding", _SLIDING_SQL + """
select start, start + interval 12 hours as "end", event_type, count(*) n from w group by 1, 2, 3""")
def sliding(t):
    counts = jobs.windowed_count(_events(t), "ts", ["event_type"], "12 hours", "6 hours", lateness=None)  # a replay
    return jobs.running_totals(counts, ["start", "end", "event_type"], "sliding")


@query("st_tumbling", """
select date_trunc('hour', ts) as start, date_trunc('hour', ts) + interval 1 hour as "end", event_type, count(*) n from events group by 1, 2, 3""")
def tumbling(t):
    counts = jobs.windowed_count(_events(t), "ts", ["event_type"], "1 hour", lateness=None)  # a replay
    return jobs.running_totals(counts, ["start", "end", "event_type"], "tumbling")


@query("st_user_clicks", """
select user_id as uid, cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) click_count from events group by 1""")
def user_clicks(t):
    """JSON messages to click totals per user, kept in a keyed table."""
    message = F.to_json(F.struct(
        F.col("user_id").cast("string").alias("uid"), F.col("event_type").alias("os_type"),
        F.get_json_object("props", "$.k").cast("bigint").alias("click_count"),
    ))
    parsed = _events(t).select(F.from_json(message, "uid STRING, os_type STRING, click_count BIGINT").alias("m"))
    totals = parsed.groupBy(F.col("m.uid").cast("bigint").alias("uid")).agg(F.sum("m.click_count").alias("click_count"))
    return jobs.running_totals(totals, ["uid"], "user-clicks")


@query("st_passthrough", "select event_id, 'ABC:' || event_type as line from events")
def passthrough(t):
    lines = _events(t).select("event_id", F.concat(F.lit("ABC:"), "event_type").alias("line"))
    return jobs.drain_to_files(lines, scratch_path(t.spark, "pass-state"), scratch_path(t.spark, "pass-table"))


@query("st_resume", "select event_id, user_id, event_type from events")
def resume(t):
    """Started twice from one checkpoint: the second start continues and writes nothing twice."""
    checkpoint, path = scratch_path(t.spark, "resume-state"), scratch_path(t.spark, "resume-table")
    rows = _events(t).select("event_id", "user_id", "event_type")
    jobs.drain_to_files(rows, checkpoint, path)
    return jobs.drain_to_files(rows, checkpoint, path)


@query("st_mod_count", "select user_id % 10 as digit, count(*) n from events group by 1")
def mod_count(t):
    def summary(batch):
        return batch.groupBy(F.pmod("user_id", F.lit(10)).alias("digit")).agg(F.count(F.lit(1)).alias("n"))

    return jobs.per_batch(_events(t), summary, "mod-count").groupBy("digit").agg(F.sum("n").alias("n"))


@query("st_static_join", """
select user_id, c_mktsegment, count(*) n from events join customer on user_id = c_custkey group by 1, 2""")
def static_join(t):
    customers = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    counts = jobs.lookup_join(_events(t), customers, "user_id").groupBy("user_id", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return jobs.running_totals(counts, ["user_id", "c_mktsegment"], "static-join")


@query("st_quality_counters", """
select case when event_type = 'error' then 'failed' else 'parsed' end status, count(*) n from events group by 1""")
def quality_counters(t):
    """Counts of messages that parse and that do not; error events carry a broken message."""
    message = F.when(F.col("event_type") == "error", F.concat(F.lit("#"), "props")).otherwise(F.col("props"))
    parsed = _events(t).select(F.from_json(message, "k BIGINT")["k"].alias("k"))
    status = F.when(F.col("k").isNull(), "failed").otherwise("parsed").alias("status")
    return jobs.running_totals(parsed.groupBy(status).agg(F.count(F.lit(1)).alias("n")), ["status"], "quality")


@query("st_click_trend", """
select strftime(ts, '%Y-%m-%d') as date, strftime(ts, '%H') as hour, strftime(ts, '%M') as minute, event_type ad, count(*) clicks
from events group by 1, 2, 3, 4""")
def click_trend(t):
    counts = jobs.windowed_count(_events(t), "ts", ["event_type"], "1 minute", lateness=None)  # a replay
    rows = jobs.running_totals(counts, ["start", "end", "event_type"], "click-trend")
    return rows.select(
        F.date_format("start", "yyyy-MM-dd").alias("date"), F.date_format("start", "HH").alias("hour"),
        F.date_format("start", "mm").alias("minute"), F.col("event_type").alias("ad"), F.col("n").alias("clicks"),
    )


@query("st_watermark_append", _SLIDING_SQL + """
select start, start + interval 12 hours as "end", event_type, count(*) n from w
where start + interval 12 hours <= (select max(ts) - interval 1 hour from events) group by 1, 2, 3""")
def watermark_append(t):
    """Only windows that closed before the lateness bound are written."""
    rows = _events(t).withColumn("at", fn.instant(F.col("ts")))
    counts = jobs.windowed_count(rows, "at", ["event_type"], "12 hours", "6 hours", lateness="1 hour")
    out = jobs.drain_to_files(counts, scratch_path(t.spark, "late-state"), scratch_path(t.spark, "late-table"))
    return out.withColumns({"start": fn.zoneless(F.col("start")), "end": fn.zoneless(F.col("end"))})


@query("st_pane_windows", _SLIDING_SQL + """
select start, start + interval 12 hours as "end", event_type, count(*) n from w
where start + interval 12 hours <= (select max(ts) - interval 1 hour from events) group by 1, 2, 3""")
def pane_windows(t):
    """Closed sliding windows from panes: the newest pane is added to the running total, the oldest subtracted."""
    rows = _events(t).withColumn("at", fn.instant(F.col("ts")))
    windows = panes.sliding_counts(rows, "at", "event_type", F.col("event_id"), pane_seconds=6 * 3600, per_window=2, lateness="1 hour")
    out = panes.drained(windows, scratch_path(t.spark, "pane-state"), scratch_path(t.spark, "pane-table"))
    merged = panes.merged(out)
    return merged.select(*[fn.zoneless(F.col(c)).alias(c) for c in ("start", "end")], F.col("key").alias("event_type"), "n")


@query("st_user_recommendations", """
with i as (select p_size item, p_partkey, row_number() over (partition by p_size order by p_retailprice desc, p_partkey) place from part qualify place <= 5),
     l as (select item, list(p_partkey order by place) parts from i group by 1),
     e as (select user_id, ts, event_id, parts from events join l on item = json_extract_string(props, '$.k')::int)
select user_id, arg_max(array_to_string(parts, ','), row(ts, event_id)) parts from e group by 1""")
def user_recommendations(t):
    """Each user's list is that of the item clicked last; items without a list change nothing."""
    best = ordered.top_per_group(t.part.select(F.col("p_size").alias("item"), "p_partkey", "p_retailprice"), ["item"], [F.col("p_retailprice").desc(), F.col("p_partkey")], 5, "place")
    lists = best.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("place", "p_partkey"))).alias("parts"))  # five at most
    lists = lists.select("item", F.array_join(F.transform("parts", lambda p: p["p_partkey"].cast("string")), ",").alias("parts"))
    clicks = _events(t).select("user_id", "ts", "event_id", F.get_json_object("props", "$.k").cast("int").alias("item"))
    return jobs.follow_last_item(clicks, stored(lists, "lists"), "user_id", "item", ["ts", "event_id"], "user-recommendations").select("user_id", "parts")
