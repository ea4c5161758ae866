"""Join plans."""

from pyspark.sql import functions as F

from lodestone.operators import ordered, relational
from lodestone.plans.registry import query


@query("jn_inner_using", """
select o_orderkey, o_custkey, c_name, c_mktsegment from orders join customer on o_custkey = c_custkey""")
def inner_using(t):
    customers = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    return t.orders.join(customers, "o_custkey").select("o_orderkey", "o_custkey", "c_name", "c_mktsegment")


@query("jn_inner_sql", """
select c_mktsegment, l_returnflag, count(*) n, round(sum(l_quantity), 2) quantity
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
where o_orderstatus = 'F' group by c_mktsegment, l_returnflag""")
def inner_sql(t):
    return t.spark.sql(
        """SELECT c_mktsegment, l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity
           FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
           WHERE o_orderstatus = 'F' GROUP BY c_mktsegment, l_returnflag""",
        lineitem=t.lineitem, orders=t.orders, customer=t.customer,
    )


@query("jn_star", """
with dates as (select distinct o_orderdate as dateid, year(o_orderdate) y, quarter(o_orderdate) q from orders)
select y as year, q as quarter, l_returnflag, round(sum(l_extendedprice), 2) amount, count(*) n
from orders join lineitem on o_orderkey = l_orderkey join dates on o_orderdate = dateid group by 1, 2, 3""")
def star(t):
    dates = t.orders.select(F.col("o_orderdate").alias("dateid")).distinct().select(
        "dateid", F.year("dateid").cast("bigint").alias("year"), F.quarter("dateid").cast("bigint").alias("quarter")
    )
    joined = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    # Sum by date first, so that only one row per date and flag meets the date dimension.
    daily = joined.groupBy("o_orderdate", "l_returnflag").agg(F.sum("l_extendedprice").alias("amount"), F.count(F.lit(1)).alias("n"))
    return (
        daily.join(dates, F.col("o_orderdate") == F.col("dateid"))
        .groupBy("year", "quarter", "l_returnflag")
        .agg(F.round(F.sum("amount"), 2).alias("amount"), F.sum("n").alias("n"))
    )


@query("jn_implicit", """
select p_partkey, p.p_brand, p_retailprice from part p, (select p_brand, max(p_retailprice) top from part group by p_brand) m
where p.p_brand = m.p_brand and p.p_retailprice = m.top""")
def implicit(t):
    return t.spark.sql(
        """SELECT p_partkey, p.p_brand, p_retailprice
           FROM {part} p, (SELECT p_brand, max(p_retailprice) AS top FROM {part} GROUP BY p_brand) m
           WHERE p.p_brand = m.p_brand AND p.p_retailprice = m.top""",
        part=t.part,
    )


@query("jn_self_agg", """
select o.o_orderkey, o.o_custkey, year(o_orderdate) - first_year as exp
from orders o join (select o_custkey, min(year(o_orderdate)) first_year from orders group by o_custkey) f
on o.o_custkey = f.o_custkey""")
def self_agg(t):
    orders = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("bigint").alias("year"))
    first = orders.groupBy(F.col("o_custkey").alias("owner")).agg(F.min("year").alias("first_year"))
    return orders.join(first, F.col("o_custkey") == F.col("owner")).select(
        "o_orderkey", "o_custkey", (F.col("year") - F.col("first_year")).alias("exp")
    )


@query("jn_left_default", """
select c_custkey, coalesce(n, 0) n_orders from customer
left join (select o_custkey, count(*) n from orders where o_orderstatus = 'P' group by o_custkey) on c_custkey = o_custkey""")
def left_default(t):
    counts = t.orders.where(F.col("o_orderstatus") == "P").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    joined = t.customer.select("c_custkey").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("jn_broadcast", """
select c_custkey, n_name from customer join nation on c_nationkey = n_nationkey""")
def broadcast(t):
    nations = relational.broadcast_if_small(t.nation.select("n_nationkey", "n_name"))
    return t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


@query("jn_semi", """
select o_orderkey, o_custkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')""")
def semi(t):
    wanted = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return t.orders.select("o_orderkey", "o_custkey").join(wanted, F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@query("jn_lookup_null", """
select l_orderkey, l_linenumber, l_partkey, p_name from lineitem
left join (select p_partkey, p_name from part where p_type = 'ECONOMY') on l_partkey = p_partkey""")
def lookup_null(t):
    dictionary = t.part.where(F.col("p_type") == "ECONOMY")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return relational.lookup(rows, "l_partkey", dictionary, "p_partkey", "p_name")


@query("jn_composite", """
select a.l_partkey, a.l_suppkey, bought, returned
from (select l_partkey, l_suppkey, round(sum(l_quantity), 2) bought from lineitem group by 1, 2) a
join (select l_partkey, l_suppkey, round(sum(l_quantity), 2) returned from lineitem where l_returnflag = 'R' group by 1, 2) b
on a.l_partkey = b.l_partkey and a.l_suppkey = b.l_suppkey""")
def composite(t):
    pair = ["l_partkey", "l_suppkey"]
    bought = t.lineitem.groupBy(*pair).agg(F.round(F.sum("l_quantity"), 2).alias("bought"))
    returned = t.lineitem.where(F.col("l_returnflag") == "R").groupBy(*pair).agg(F.round(F.sum("l_quantity"), 2).alias("returned"))
    return bought.join(returned, pair)


@query("jn_anti", "select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def anti(t):
    return t.orders.select("o_orderkey", "o_custkey").join(
        t.lineitem.select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"
    )


@query("jn_zip_by_id", "select d.doc_id, source, quality, toxic from documents d join labels l on d.doc_id = l.doc_id")
def zip_by_id(t):
    return t.documents.select("doc_id", "source").join(t.labels, "doc_id")


@query("jn_edge_index", """
with nodes as (select distinct node from (select 'N' || c_nationkey node from customer union all select c_mktsegment from customer)),
     idx as (select node, row_number() over (order by node) - 1 as id from nodes)
select s.id as src, d.id as dst, count(*) n from customer join idx s on s.node = 'N' || c_nationkey join idx d on d.node = c_mktsegment
group by 1, 2""")
def edge_index(t):
    edges = t.customer.select(F.concat(F.lit("N"), F.col("c_nationkey")).alias("a"), F.col("c_mktsegment").alias("b"))
    # Parallel edges are counted before the dictionary is joined: a hot pair becomes one row.
    pairs = edges.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    index = ordered.with_row_number(nodes, [], ["node"], "id").withColumn("id", F.col("id") - 1)
    return (
        pairs.join(index.select(F.col("node").alias("a"), F.col("id").alias("src")), "a")
        .join(index.select(F.col("node").alias("b"), F.col("id").alias("dst")), "b")
        .select("src", "dst", "n")
    )
