"""Plans that go through user-defined functions."""

import pandas as pd
from pyspark.sql import functions as F

from lodestone.functions import udfs
from lodestone.operators import ordered
from lodestone.plans.registry import query


@query("udf_scalar", """
select doc_id, round(case when toxic = 0 then r else 1 - r end, 6) weight from labels, (select avg(toxic) r from labels)""")
def scalar(t):
    @F.pandas_udf("double")
    def weight(label: pd.Series, ratio: pd.Series) -> pd.Series:
        return ratio.where(label == 0, 1.0 - ratio)

    rows = ordered.with_group_values(t.labels, [], ratio=F.avg("toxic"))
    return rows.select("doc_id", F.round(weight("toxic", "ratio"), 6).alias("weight"))


@query("udf_udaf_group", "select c_mktsegment, round(avg(c_acctbal), 4) avg_balance from customer group by 1")
def udaf_group(t):
    udfs.register_average(t.spark)
    return t.spark.sql(
        "SELECT c_mktsegment, round(u_avg(total, n), 4) AS avg_balance FROM {partial} GROUP BY c_mktsegment",
        partial=udfs.partial_sums(t.customer, ["c_mktsegment"], "c_acctbal"),
    )


@query("udf_udaf_global", "select round(avg(c_acctbal), 4) avg_balance from customer")
def udaf_global(t):
    udfs.register_average(t.spark)
    return t.spark.sql(
        "SELECT round(u_avg(total, n), 4) AS avg_balance FROM {partial}", partial=udfs.partial_sums(t.customer, [], "c_acctbal")
    )


@query("udf_aggregator", "select c_nationkey, round(avg(c_acctbal), 4) avg_balance from customer group by 1")
def aggregator(t):
    return udfs.aggregate(t.customer, ["c_nationkey"], "c_acctbal", "avg_balance").withColumn("avg_balance", F.round("avg_balance", 4))


@query("udf_map_partitions", "select count(*) n, round(sum(l_quantity * 2 + 1), 2) total from lineitem")
def map_partitions(t):
    def summed(frame):
        return pd.DataFrame({"n": [len(frame)], "total": [(frame["l_quantity"] * 2 + 1).sum()]})

    parts = udfs.map_partitions(t.lineitem.select("l_quantity"), summed, "n bigint, total double")
    return parts.agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query("udf_group_map", """
with y as (select o_custkey, year(o_orderdate) as year, round(sum(o_totalprice), 2) spent from orders group by 1, 2)
select o_custkey, year, round(spent - lag(spent) over (partition by o_custkey order by year), 2) delta from y""")
def group_map(t):
    """Yearly rows are aggregated first, so a group holds one row per year."""
    yearly = t.orders.groupBy("o_custkey", F.year("o_orderdate").cast("bigint").alias("year")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("spent")
    )

    def history(frame):
        frame = frame.sort_values(["o_custkey", "year"])
        return frame.assign(delta=frame.groupby("o_custkey")["spent"].diff())[["o_custkey", "year", "delta"]]

    deltas = udfs.group_map(yearly, ["o_custkey"], history, "o_custkey bigint, year bigint, delta double")
    return deltas.withColumn("delta", F.round(F.nanvl("delta", F.lit(None).cast("double")), 2))


@query("udf_sql_transformer", """
select p_partkey, p_size, p_size + p_retailprice v3, round(p_size * p_retailprice, 4) v4 from part""")
def sql_transformer(t):
    return udfs.sql_transform(
        t.part, "SELECT p_partkey, p_size, p_size + p_retailprice AS v3, round(p_size * p_retailprice, 4) AS v4 FROM __THIS__"
    )
