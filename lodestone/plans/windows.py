"""Ranking, running and neighbour plans; a group of more rows than `spark.lodestone.maxGroupRows` is spread over tasks."""

from pyspark.sql import functions as F

from lodestone.operators import ordered
from lodestone.plans.registry import query
from lodestone.session import stored

BY_DATE = ["o_orderdate", "o_orderkey"]


def _orders(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


def _yearly(t):
    return t.orders.groupBy("o_custkey", F.year("o_orderdate").cast("bigint").alias("year")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("spent")
    )


@query("wn_rank", "select p_partkey, p_brand, rank() over (partition by p_brand order by p_size desc) r from part")
def rank(t):
    return ordered.with_rank(t.part.select("p_partkey", "p_brand", "p_size"), ["p_brand"], "p_size", "r", descending=True).drop("p_size")


@query("wn_top1_ties", """
select p_partkey, p_brand, p_size from part qualify rank() over (partition by p_brand order by p_size desc) = 1""")
def top1_ties(t):
    beside = ordered.with_group_values(t.part.select("p_partkey", "p_brand", "p_size"), ["p_brand"], top=F.max("p_size"))
    return beside.where(F.col("p_size") == F.col("top")).drop("top")


@query("wn_row_number", """
select o_orderkey, o_custkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) rn from orders""")
def row_number(t):
    return ordered.with_row_number(_orders(t), ["o_custkey"], BY_DATE, "rn").select("o_orderkey", "o_custkey", "rn")


@query("wn_dense_rank", "select p_partkey, p_brand, dense_rank() over (partition by p_brand order by p_size) r from part")
def dense_rank(t):
    return ordered.with_rank(t.part.select("p_partkey", "p_brand", "p_size"), ["p_brand"], "p_size", "r", dense=True).drop("p_size")


@query("wn_count", """
select o_orderkey, count(*) over () n_all, count(*) over (partition by o_custkey) n_customer from orders""")
def count(t):
    per_customer = ordered.with_group_values(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], n_customer=F.count(F.lit(1)))
    return ordered.with_group_values(per_customer, [], n_all=F.count(F.lit(1))).select("o_orderkey", "n_all", "n_customer")


@query("wn_running_minmax", """
select o_orderkey, max(o_totalprice) over w max_so_far, min(o_totalprice) over w min_so_far from orders
window w as (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding)""")
def running_minmax(t):
    price = F.col("o_totalprice")
    out = ordered.with_running(_orders(t), ["o_custkey"], BY_DATE, {"max_so_far": ("max", price), "min_so_far": ("min", price)})
    return out.select("o_orderkey", "max_so_far", "min_so_far")


@query("wn_running_sum_avg", """
select o_orderkey, round(sum(o_totalprice) over w, 2) sum_so_far, round(sum(o_totalprice) over w / count(*) over w, 6) avg_so_far
from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey rows unbounded preceding)""")
def running_sum_avg(t):
    price = F.col("o_totalprice")
    out = ordered.with_running(_orders(t), ["o_custkey"], BY_DATE, {"total": ("sum", price), "n": ("count", price)})
    return out.select("o_orderkey", F.round("total", 2).alias("sum_so_far"), F.round(F.col("total") / F.col("n"), 6).alias("avg_so_far"))


@query("wn_first_last", """
select o_orderkey, first_value(o_totalprice) over w first_price, last_value(o_totalprice) over w last_price from orders
window w as (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and unbounded following)""")
def first_last(t):
    when = F.struct(*BY_DATE)
    out = ordered.with_group_values(
        _orders(t), ["o_custkey"], first_price=F.min_by("o_totalprice", when), last_price=F.max_by("o_totalprice", when)
    )
    return out.select("o_orderkey", "first_price", "last_price")


@query("wn_lag_lead", """
select o_orderkey, lag(o_totalprice, 1, 0.0) over w previous, lead(o_totalprice, 2, -1.0) over w second_next from orders
window w as (partition by o_custkey order by o_orderdate, o_orderkey)""")
def lag_lead(t):
    out = ordered.with_neighbours(
        _orders(t), ["o_custkey"], BY_DATE,
        {"previous": ("o_totalprice", 1, 0.0), "second_next": ("o_totalprice", -2, -1.0)},
    )
    return out.select("o_orderkey", "previous", "second_next")


@query("wn_agg_over", """
select p_partkey, p_retailprice, round(avg(p_retailprice) over (partition by p_brand), 4) brand_avg from part""")
def agg_over(t):
    beside = ordered.with_group_values(t.part, ["p_brand"], brand_avg=F.round(F.avg("p_retailprice"), 4))
    return beside.select("p_partkey", "p_retailprice", "brand_avg")


@query("wn_equal_freq_bins", """
with r as (select o_totalprice, row_number() over (order by o_totalprice, o_orderkey) rank_id, count(*) over () all_count from orders)
select cast(ceil(rank_id / (all_count / 5)) as bigint) bin_id, round(avg(o_totalprice), 6) avg_price, min(o_totalprice) min_price,
       max(o_totalprice) max_price, count(*) bin_count from r group by 1""")
def equal_freq_bins(t):
    numbered = ordered.with_row_number(t.orders.select("o_totalprice", "o_orderkey"), [], ["o_totalprice", "o_orderkey"], "rank_id")
    total = t.orders.agg(F.count(F.lit(1)).alias("all_count"))  # one row
    bins = numbered.join(F.broadcast(total)).withColumn("bin_id", F.ceil(F.col("rank_id") / (F.col("all_count") / 5)))
    return bins.groupBy("bin_id").agg(
        F.round(F.avg("o_totalprice"), 6).alias("avg_price"), F.min("o_totalprice").alias("min_price"),
        F.max("o_totalprice").alias("max_price"), F.count(F.lit(1)).alias("bin_count"),
    )


@query("wn_top3_group", """
with c as (select s_nationkey, l_partkey, count(*) n from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2)
select s_nationkey, l_partkey, n, row_number() over (partition by s_nationkey order by n desc, l_partkey) place from c qualify place <= 3""")
def top3_group(t):
    counts = (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    )
    return ordered.top_per_group(counts, ["s_nationkey"], [F.col("n").desc(), F.col("l_partkey")], 3, "place")


@query("wn_top3_hour", """
with c as (select event_type, strftime(ts, '%Y-%m-%d %H') as hour, user_id, count(*) n from events group by 1, 2, 3)
select event_type, hour, user_id, n, row_number() over (partition by event_type, hour order by n desc, user_id) place from c qualify place <= 3""")
def top3_hour(t):
    hour = F.date_format("ts", "yyyy-MM-dd HH").alias("hour")
    counts = t.events.groupBy("event_type", hour, "user_id").agg(F.count(F.lit(1)).alias("n"))
    return ordered.top_per_group(counts, ["event_type", "hour"], [F.col("n").desc(), F.col("user_id")], 3, "place")


@query("wn_zip_index", """
select p_partkey, row_number() over (order by p_retailprice desc, p_partkey) - 1 as idx from part""")
def zip_index(t):
    rows = t.part.select("p_partkey", "p_retailprice")
    out = ordered.with_row_number(rows, [], [F.col("p_retailprice").desc(), F.col("p_partkey")], "n")
    return out.select("p_partkey", (F.col("n") - 1).alias("idx"))


@query("wn_delta", """
with y as (select o_custkey, year(o_orderdate) as year, round(sum(o_totalprice), 2) spent from orders group by 1, 2)
select o_custkey, year, spent, round(spent - lag(spent) over (partition by o_custkey order by year), 2) delta from y""")
def delta(t):
    out = ordered.with_neighbours(stored(_yearly(t), "yearly"), ["o_custkey"], ["year"], {"last": ("spent", 1, None)})
    return out.select("o_custkey", "year", "spent", F.round(F.col("spent") - F.col("last"), 2).alias("delta"))


@query("wn_experience", """
with y as (select o_custkey, year(o_orderdate) as year, count(*) n from orders group by 1, 2)
select o_custkey, year, year - min(year) over (partition by o_custkey) exp from y""")
def experience(t):
    years = t.orders.select("o_custkey", F.year("o_orderdate").cast("bigint").alias("year")).distinct()
    beside = ordered.with_group_values(stored(years, "years"), ["o_custkey"], first=F.min("year"))
    return beside.select("o_custkey", "year", (F.col("year") - F.col("first")).alias("exp"))
