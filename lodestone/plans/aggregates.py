"""Aggregation plans."""

from pyspark.sql import functions as F

from lodestone.operators import ordered, profile
from lodestone.plans.registry import query
from lodestone.session import stored

AMOUNT = "l_extendedprice * (1 - l_discount)"


@query("ag_wordcount", r"""
select word, count(*) n from (select unnest(string_split_regex(text, '\s+')) word from documents) where length(word) >= 4 group by word""")
def wordcount(t):
    words = t.documents.select(F.explode(F.split("text", r"\s+")).alias("word"))
    return words.where(F.length("word") >= 4).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("ag_group_count", """
select c_mktsegment, n_name, count(*) n from customer join nation on c_nationkey = n_nationkey group by 1, 2""")
def group_count(t):
    counts = t.customer.groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_mktsegment", "n_name", "n")


@query("ag_avg", "select l_suppkey, round(avg(l_quantity), 4) avg_quantity from lineitem group by l_suppkey")
def avg(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.round(F.avg("l_quantity"), 4).alias("avg_quantity"))


@query("ag_sum", """
select date_trunc('hour', ts) as hour, round(sum(value), 2) total from events group by 1""")
def total(t):
    return t.events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.round(F.sum("value"), 2).alias("total"))


@query("ag_count_distinct", "select l_suppkey, count(distinct l_partkey) n_parts from lineitem group by l_suppkey")
def count_distinct(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("n_parts"))


@query("ag_global_distinct", "select count(distinct o_custkey) n_customers from orders")
def global_distinct(t):
    return t.orders.agg(F.countDistinct("o_custkey").alias("n_customers"))


@query("ag_stat_block", """
select o_orderpriority, count(*) n, round(avg(o_totalprice), 4) avg_price, min(o_totalprice) min_price, max(o_totalprice) max_price
from orders group by o_orderpriority""")
def stat_block(t):
    return t.orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("avg_price"),
        F.min("o_totalprice").alias("min_price"), F.max("o_totalprice").alias("max_price"),
    )


def _yearly_counter(t):
    rows = t.lineitem.select(
        F.year("l_shipdate").cast("bigint").alias("year"),
        F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("discount"),
    )
    return profile.stat_counter(rows, ["year"], ["quantity", "discount"])


_COUNTER_SQL = """
select year(l_shipdate) as year,
  count(l_quantity) quantity_count, round(avg(l_quantity), 4) quantity_avg, round(stddev_pop(l_quantity), 4) quantity_stdev,
  max(l_quantity) quantity_max, min(l_quantity) quantity_min, 0::bigint quantity_missing,
  count(nullif(l_discount, 0)) discount_count, round(avg(nullif(l_discount, 0)), 4) discount_avg,
  round(stddev_pop(nullif(l_discount, 0)), 4) discount_stdev, max(nullif(l_discount, 0)) discount_max,
  min(nullif(l_discount, 0)) discount_min, count(*) - count(nullif(l_discount, 0)) discount_missing
from lineitem group by 1"""


@query("ag_statcounter", _COUNTER_SQL)
def statcounter(t):
    out = _yearly_counter(t)
    return out.select(*[F.round(c, 4).alias(c) if c.endswith(("_avg", "_stdev")) else F.col(c) for c in out.columns])


@query("ag_stats_long", f"""
with wide as ({_COUNTER_SQL})
select year, stat, value from (unpivot (select year, cast(columns(* exclude (year)) as double) from wide)
on columns(* exclude (year)) into name stat value value)""")
def stats_long(t):
    long = profile.to_long(_yearly_counter(t), ["year"], "stat", "value")
    return long.withColumn("value", F.round("value", 4))


@query("ag_hist_wide", "select " + ", ".join(
    f"count(*) filter (where o_totalprice >= {i * 25000} and o_totalprice < {i * 25000 + 25000}) as count{i * 25000}_{i * 25000 + 25000}"
    for i in range(20)) + ", count(*) filter (where o_totalprice >= 500000) as count500000max from orders")
def hist_wide(t):
    return profile.histogram_wide(t.orders, "o_totalprice", 25000, 20)


@query("ag_hist_long", """
select cast(least(floor(o_totalprice / 25000.0), 20) as bigint) as bin, count(*) n from orders group by 1""")
def hist_long(t):
    return profile.histogram_long(t.orders, "o_totalprice", 25000, 20)


@query("ag_max_of_sum", """
select year(o_orderdate) as year, round(max(amount), 2) top_amount
from orders join (select l_orderkey, sum(l_extendedprice * (1 - l_discount)) amount from lineitem group by l_orderkey)
on o_orderkey = l_orderkey group by 1""")
def max_of_sum(t):
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.expr(AMOUNT)).alias("amount"))
    return (
        t.orders.select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("year"))
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("year").agg(F.round(F.max("amount"), 2).alias("top_amount"))
    )


@query("ag_groupwise_max", """
select p.p_partkey, p.p_brand, p.p_size from part p join (select p_brand, max(p_size) m from part group by p_brand) g
on p.p_brand = g.p_brand and p.p_size = g.m""")
def groupwise_max(t):
    beside = ordered.with_group_values(t.part.select("p_partkey", "p_brand", "p_size"), ["p_brand"], largest=F.max("p_size"))
    return beside.where(F.col("p_size") == F.col("largest")).drop("largest")


@query("ag_bestseller", """
with s as (select year(o_orderdate) as year, l_partkey, round(sum(l_quantity), 2) quantity
           from orders join lineitem on o_orderkey = l_orderkey group by 1, 2)
select year, l_partkey, quantity from s where (year, quantity) in (select (year, max(quantity)) from s group by year)""")
def bestseller(t):
    sold = (
        t.orders.select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("year"))
        .join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("year", "l_partkey").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"))
    )
    best = ordered.with_group_values(stored(sold, "sold"), ["year"], best=F.max("quantity"))
    return best.where(F.col("quantity") == F.col("best")).drop("best")


@query("ag_median", """
select o_orderpriority as priority, round(median(o_totalprice), 4) median_price from orders group by 1
union all select 'all', round(median(o_totalprice), 4) from orders""")
def median(t):
    grouped = ordered.exact_median(t.orders, ["o_orderpriority"], "o_totalprice", "median_price")
    whole = ordered.exact_median(t.orders, [], "o_totalprice", "median_price")
    rows = grouped.withColumnRenamed("o_orderpriority", "priority").unionByName(whole.withColumn("priority", F.lit("all")))
    return rows.withColumn("median_price", F.round("median_price", 4))


@query("ag_mode", """
with c as (select p_size, count(*) n from part group by p_size) select p_size, n from c where n = (select max(n) from c)""")
def mode(t):
    return profile.mode(t.part, "p_size")


@query("ag_global_mean", "select round(avg(o_totalprice), 4) mean_price from orders")
def global_mean(t):
    return t.orders.agg(F.round(F.avg("o_totalprice"), 4).alias("mean_price"))


@query("ag_value_counts", """
select l_partkey, count(*) n from lineitem group by l_partkey order by n desc, l_partkey limit 50""")
def value_counts(t):
    counts = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), "l_partkey").limit(50)


@query("ag_min_max", "select min(l_extendedprice) min_price, max(l_extendedprice) max_price, max(l_partkey) max_part from lineitem")
def min_max(t):
    return t.lineitem.agg(
        F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"), F.max("l_partkey").alias("max_part")
    )


@query("ag_collect_list", """
with n as (select o_custkey, o_orderkey, (row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1) // 8 as chunk,
                  o_orderdate from orders)
select o_custkey, chunk, list(o_orderkey order by o_orderdate, o_orderkey) order_keys from n group by 1, 2""")
def collect_list(t):
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    return ordered.chunked_lists(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_orderkey"), 8, "order_keys")


@query("ag_value_hist", "select event_type, count(*) n from events group by event_type")
def value_hist(t):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("ag_class_ratio", """
select round(avg(quality), 6) quality_ratio, round(avg(toxic), 6) toxic_ratio, count(*) n from labels""")
def class_ratio(t):
    return t.labels.agg(
        F.round(F.avg("quality"), 6).alias("quality_ratio"), F.round(F.avg("toxic"), 6).alias("toxic_ratio"), F.count(F.lit(1)).alias("n")
    )


@query("ag_vector_stats", """
select slot, count(*) n, round(avg(x), 6) mean, round(var_samp(x), 6) variance, min(x) min, max(x) max,
       count(*) filter (where x <> 0) non_zero
from (select unnest(range(len(embedding))) slot, unnest(embedding)::double x from embeddings) group by slot""")
def vector_stats(t):
    out = profile.vector_stats(t.embeddings, "embedding")
    return out.withColumns({"slot": F.col("slot").cast("bigint"), "mean": F.round("mean", 6), "variance": F.round("variance", 6)})


@query("ag_item_audience", """
select c_mktsegment, c_nationkey, count(*) n from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
where l_partkey = 42 group by 1, 2""")
def item_audience(t):
    buyers = t.lineitem.where(F.col("l_partkey") == 42).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return (
        buyers.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment", "c_nationkey").agg(F.sum("n").alias("n"))
    )


@query("ag_sum_from", "select cast(4 + sum(p_size + 1) as bigint) total, count(*) n from part")
def sum_from(t):
    return t.part.agg((F.sum(F.col("p_size") + 1) + 4).alias("total"), F.count(F.lit(1)).alias("n"))
