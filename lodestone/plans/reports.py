"""Reports: access log, sales, season scores, advertising."""

from pyspark.sql import functions as F

from lodestone.operators import ordered, seasons, weblog
from lodestone.operators.seasons import Stat
from lodestone.plans.registry import query
from lodestone.session import stored

# --- access log -------------------------------------------------------------------------


def _log_lines(t):
    """Access-log lines formatted from the events; user n has the n-th address from 192.168.0.0 on, so 65536 has 192.169.0.0."""
    number = F.pmod(F.col("user_id") + (192 << 24 | 168 << 16), F.lit(1 << 32))
    ip = F.concat_ws(".", *[F.shiftright(number, bits).bitwiseAND(255).cast("string") for bits in (24, 16, 8, 0)])
    status = (
        F.when(F.col("event_type") == "view", "200").when(F.col("event_type") == "click", "206")
        .when(F.col("event_type") == "purchase", "304").when(F.col("event_type") == "signup", "404").otherwise("500")
    )
    size = F.round(F.col("value") * 100000).cast("bigint").cast("string")
    video = F.get_json_object("props", "$.k")
    time = F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    line = F.concat(ip, F.lit(" HIT 13 ["), time, F.lit(' +0800] "GET http://cdn/'), video, F.lit('.mp4 HTTP/1.1" '), status, F.lit(" "), size, F.lit(' "-"'))
    return t.events.select(line.alias("value"))


_IP_SQL = "'192.168.' || (user_id // 256) || '.' || (user_id % 256)"


@query("rp_ip_top", f"""
with h as (select {_IP_SQL} ip, count(*) hits from events group by 1)
select ip, hits, (select count(*) from h) n_ips from h order by hits desc, ip limit 10""")
def ip_top(t):
    return weblog.top_ips(_log_lines(t), 10)


@query("rp_video_ips", f"""
select json_extract_string(props, '$.k') || '.mp4' video, count(distinct {_IP_SQL}) n_ips from events group by 1
order by n_ips desc, video limit 10""")
def video_ips(t):
    return weblog.video_audience(_log_lines(t), 10)


@query("rp_hourly_flow", """
select strftime(ts, '%H') as hour, cast(sum(cast(round(value * 100000) as bigint)) as bigint) as bytes,
  round(sum(cast(round(value * 100000) as bigint)) / 1073741824, 6) gigabytes
from events where event_type in ('view', 'click', 'purchase') group by 1""")
def hourly_flow(t):
    return weblog.hourly_traffic(_log_lines(t), 2024)


# --- sales ------------------------------------------------------------------------------


@query("rp_yearly_sales", """
select year(o_orderdate) as year, count(distinct o_orderkey) n_orders, round(sum(l_extendedprice * (1 - l_discount)), 2) amount
from orders join lineitem on o_orderkey = l_orderkey group by 1""")
def yearly_sales(t):
    # One row per order before the join: the order count needs no distinct afterwards.
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"))
    return (
        t.orders.select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("year"))
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("year").agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("amount"), 2).alias("amount"))
    )


# --- season scores: a customer's year stands for a player's season ------------------------

STATS = [
    Stat("fg", attempts="fga"), Stat("ft", attempts="fta"), Stat("tp"), Stat("trb"), Stat("ast"),
    Stat("stl"), Stat("blk"), Stat("tov", loss=True), Stat("pts"),
]

_SEASON_SQL = """
with s as (select o_custkey as player, year(o_orderdate) as year, avg(l_discount) fg, cast(count(*) as double) fga, avg(l_tax) ft,
    cast(count(distinct l_orderkey) as double) fta, avg(l_quantity) tp, sum(l_quantity) trb, max(l_extendedprice) ast, min(l_extendedprice) stl,
    cast(count(*) filter (where l_returnflag = 'R') as double) blk, cast(count(*) filter (where l_linestatus = 'O') as double) tov,
    sum(l_extendedprice) pts from orders join lineitem on o_orderkey = l_orderkey group by 1, 2),
a as (select year, """ + ", ".join(f"avg({x}) {x}_a, stddev_pop({x}) {x}_s" for x in "fg ft tp trb ast stl blk tov pts".split()) + """ from s group by year),
w as (select s.*, (fg - fg_a) * fga wfg, (ft - ft_a) * fta wft, """ + ", ".join(
    f"{'-' if x == 'tov' else ''}(s.{x} - {x}_a) / nullif({x}_s, 0) w{x}" for x in "tp trb ast stl blk tov pts".split()) + """ from s join a on s.year = a.year),
b as (select year, """ + ", ".join(f"avg(w{x}) {x}_a, stddev_pop(w{x}) {x}_s, max(w{x}) {x}_x, min(w{x}) {x}_n" for x in "fg ft tp trb ast stl blk tov pts".split()) + """ from w group by year),
z as (select player, w.year, """ + ", ".join(
    [f"(w{x} - {x}_a) / nullif({x}_s, 0) z_{x}, greatest(abs(({x}_x - {x}_a) / nullif({x}_s, 0)), abs(({x}_n - {x}_a) / nullif({x}_s, 0))) l_{x}" for x in ("fg", "ft")]
    + [f"w{x} z_{x}, greatest(abs({x}_x), abs({x}_n)) l_{x}" for x in "tp trb ast stl blk tov pts".split()]) + """ from w join b on w.year = b.year),
v as (select *, """ + " + ".join(f"z_{x}" for x in "fg ft tp trb ast stl blk tov pts".split()) + " z_total, " + " + ".join(
    f"z_{x} / nullif(l_{x}, 0)" for x in "fg ft tp trb ast stl blk tov pts".split()) + " n_total from z)"


def _season_lines(t):
    """Statistics per customer and year; order-level partial sums avoid a distinct count."""
    flag = lambda c, v: F.sum((F.col(c) == v).cast("double"))
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.sum("l_discount").alias("discount"), F.count(F.lit(1)).alias("n"), F.sum("l_tax").alias("tax"), F.sum("l_quantity").alias("quantity"),
        F.max("l_extendedprice").alias("top"), F.min("l_extendedprice").alias("low"), flag("l_returnflag", "R").alias("returned"),
        flag("l_linestatus", "O").alias("open"), F.sum("l_extendedprice").alias("price"),
    )
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("player"), F.year("o_orderdate").cast("bigint").alias("year"))
    rows = F.sum("n")
    return orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("player", "year").agg(
        (F.sum("discount") / rows).alias("fg"), rows.cast("double").alias("fga"), (F.sum("tax") / rows).alias("ft"),
        F.count(F.lit(1)).cast("double").alias("fta"), (F.sum("quantity") / rows).alias("tp"), F.sum("quantity").alias("trb"),
        F.max("top").alias("ast"), F.min("low").alias("stl"), F.sum("returned").alias("blk"), F.sum("open").alias("tov"), F.sum("price").alias("pts"),
    )


def _scored(t):
    # Stored once: the two statistics passes and the scoring pass read the small season table.
    return seasons.season_scores(stored(_season_lines(t), "seasons"), "year", STATS)


def _round_all(df, keys, digits=6):
    return df.select(*keys, *[(F.round(c, digits) + 0.0).alias(c) for c in df.columns if c not in keys])


@query("rp_zscore", _SEASON_SQL + "select player, year, " + ", ".join(
    f"round(z_{s.name}, 6) + 0.0 z_{s.name}" for s in STATS) + ", round(z_total, 6) + 0.0 z_total from v")
def zscore(t):
    out = _scored(t).select("player", "year", *[f"z_{s.name}" for s in STATS], "z_total")
    return _round_all(out, ["player", "year"])


@query("rp_normscore", _SEASON_SQL + "select player, year, " + ", ".join(
    f"round(z_{s.name} / nullif(l_{s.name}, 0), 6) + 0.0 n_{s.name}" for s in STATS) + ", round(n_total, 6) + 0.0 n_total from v")
def normscore(t):
    out = _scored(t).select("player", "year", *[f"n_{s.name}" for s in STATS], "n_total")
    return _round_all(out, ["player", "year"])


_CURVE_VALUES = ["z_total", "n_total", "delta_z_total", "delta_n_total"]
_CURVE_SQL = ", ".join(
    f"count({v}) {v}_count, round(avg({v}), 4) + 0.0 {v}_mean, round(stddev_pop({v}), 4) + 0.0 {v}_stdev, round(max({v}), 4) + 0.0 {v}_max, round(min({v}), 4) + 0.0 {v}_min"
    for v in _CURVE_VALUES)
_CAREER_SQL = _SEASON_SQL + """, c as (select player, year, z_total, n_total, year - min(year) over (partition by player) exp,
  z_total - lag(z_total) over (partition by player order by year) delta_z_total,
  n_total - lag(n_total) over (partition by player order by year) delta_n_total from v)"""


def _careers(t):
    totals = stored(_scored(t).select("player", "year", "z_total", "n_total"), "totals")
    return seasons.careers(totals, "player", "year", ["z_total", "n_total"])


def _curve(df, by):
    out = seasons.curve(df, by, _CURVE_VALUES)
    return out.select(by, *[F.col(c) if c.endswith("_count") else (F.round(c, 4) + 0.0).alias(c) for c in out.columns if c != by])


@query("rp_by_experience", _CAREER_SQL + f"""
select exp, {_CURVE_SQL} from c where player not in (select player from c where year = 1995) group by exp""")
def by_experience(t):
    return _curve(seasons.started_after(stored(_careers(t), "careers"), "player", "year", 1995), "exp")


@query("rp_by_age", _CAREER_SQL + f"""
select year - 1960 - c_nationkey as age, {_CURVE_SQL} from c join customer on player = c_custkey group by 1""")
def by_age(t):
    births = t.customer.select(F.col("c_custkey").alias("player"), "c_nationkey")
    aged = _careers(t).join(births, "player").withColumn("age", F.col("year") - 1960 - F.col("c_nationkey"))
    return _curve(aged, "age")


# --- advertising: event type is the ad, region the province, nation the city ---------------


def _clicks(t):
    """Clicks per day, user and ad; counting first keeps hot users out of the later joins."""
    return t.events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date"), "user_id", F.col("event_type").alias("ad")).agg(
        F.count(F.lit(1)).alias("clicks")
    )


def _placed_clicks(t):
    places = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("user_id"), F.col("r_name").alias("province"), F.col("n_name").alias("city"))
    )
    return _clicks(t).join(places, "user_id")


_PLACED_SQL = """from events join customer on user_id = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""


@query("rp_ad_stat", f"""
select strftime(ts, '%Y-%m-%d') as date, r_name province, n_name city, event_type ad, count(*) clicks {_PLACED_SQL} group by 1, 2, 3, 4""")
def ad_stat(t):
    return _placed_clicks(t).groupBy("date", "province", "city", "ad").agg(F.sum("clicks").alias("clicks"))


@query("rp_ad_top3", f"""
with c as (select strftime(ts, '%Y-%m-%d') as date, r_name province, event_type ad, count(*) clicks {_PLACED_SQL} group by 1, 2, 3)
select *, row_number() over (partition by date, province order by clicks desc, ad) place from c qualify place <= 3""")
def ad_top3(t):
    counts = _placed_clicks(t).groupBy("date", "province", "ad").agg(F.sum("clicks").alias("clicks"))
    return ordered.top_per_group(counts, ["date", "province"], [F.col("clicks").desc(), F.col("ad")], 3, "place")


@query("rp_ad_user_clicks", """
select strftime(ts, '%Y-%m-%d') as date, user_id, event_type ad, count(*) clicks from events group by 1, 2, 3""")
def ad_user_clicks(t):
    return _clicks(t)


@query("rp_ad_blacklist", """
select user_id, max(clicks) top_clicks from (select strftime(ts, '%Y-%m-%d') as date, user_id, event_type ad, count(*) clicks from events group by 1, 2, 3)
where clicks > 3 group by user_id""")
def ad_blacklist(t, limit=3):
    return _clicks(t).where(F.col("clicks") > limit).groupBy("user_id").agg(F.max("clicks").alias("top_clicks"))
