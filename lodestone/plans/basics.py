"""Schemas, projections, filters, sorting and set operations."""

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from lodestone.operators import ordered, profile, relational
from lodestone.plans.registry import query
from lodestone.sources import schemas

# --- schemas, views, inspection ---------------------------------------------------------


@query("sch_declared_cast", """
select o_orderkey, cast(o_custkey as integer) o_custkey, o_orderstatus,
       cast(o_totalprice as double) o_totalprice, cast(o_orderpriority as varchar) o_orderpriority
from orders""")
def declared_cast(t):
    schema = StructType([
        StructField("o_orderkey", LongType()), StructField("o_custkey", IntegerType()),
        StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType()),
        StructField("o_orderpriority", StringType()),
    ])
    return schemas.conform(t.orders, schema)


@query("sch_all_string", """
select cast(c_custkey as varchar) c_custkey, c_name, cast(c_nationkey as varchar) c_nationkey, c_mktsegment from customer""")
def all_string(t):
    return schemas.conform(t.customer, schemas.string_schema("c_custkey c_name c_nationkey c_mktsegment"))


@query("sch_typed_json", """select event_id, cast(json_extract_string(props, '$.k') as bigint) k from events""")
def typed_json(t):
    return t.events.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@query("sch_view_sql", "select c_custkey, c_name from customer where c_acctbal > 21")
def view_sql(t):
    t.customer.createOrReplaceTempView("customer_view")
    return t.spark.sql("SELECT c_custkey, c_name FROM customer_view WHERE c_acctbal > 21")


@query("sch_row_to_map", """
select n_nationkey, '{"n_name":"' || n_name || '","n_regionkey":"' || n_regionkey || '"}' as fields from nation""")
def row_to_map(t):
    names = ["n_name", "n_regionkey"]
    pairs = [x for n in names for x in (F.lit(n), F.col(n).cast("string"))]
    return t.nation.select("n_nationkey", F.to_json(F.create_map(*pairs)).alias("fields"))


@query("sch_prefix_field", "select c_custkey, 'Name: ' || c_name as line from customer")
def prefix_field(t):
    return t.customer.select("c_custkey", F.concat(F.lit("Name: "), F.col("c_name")).alias("line"))


@query("sch_describe", """
select 'o_totalprice' as "column", count(o_totalprice) n, round(avg(o_totalprice), 4) mean,
       round(stddev_samp(o_totalprice), 4) stddev, min(o_totalprice) min, max(o_totalprice) max from orders
union all
select 'o_custkey', count(o_custkey), round(avg(o_custkey), 4), round(stddev_samp(o_custkey), 4),
       cast(min(o_custkey) as double), cast(max(o_custkey) as double) from orders""")
def describe(t):
    out = profile.describe(t.orders, ["o_totalprice", "o_custkey"])
    return out.withColumn("mean", F.round("mean", 4)).withColumn("stddev", F.round("stddev", 4))


@query("sch_head", "select r_regionkey, r_name from region order by r_regionkey limit 3")
def head(t):
    return t.region.orderBy("r_regionkey").limit(3)


# --- projections, filters, predicates ---------------------------------------------------


@query("prj_filter_gt", "select c_custkey, c_acctbal from customer where c_acctbal > 5000")
def filter_gt(t):
    return t.customer.where(F.col("c_acctbal") > 5000).select("c_custkey", "c_acctbal")


@query("prj_between", "select p_partkey, p_size from part where p_size between 13 and 19")
def between(t):
    return t.part.where(F.col("p_size").between(13, 19)).select("p_partkey", "p_size")


@query("prj_filter_expr", """
select l_orderkey, l_linenumber, l_quantity from lineitem where l_partkey = 42 and l_returnflag = 'R'""")
def filter_expr(t):
    return t.lineitem.where("l_partkey = 42 and l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_quantity")


@query("prj_audience", """
select n_name, count(*) n from customer join nation on c_nationkey = n_nationkey
where c_mktsegment like '%U%' and c_name not like '%9' and c_acctbal < 8000 and c_acctbal > 100 and (n_regionkey <> 2)
group by n_name""")
def audience(t):
    wanted = (
        F.col("c_mktsegment").like("%U%") & ~F.col("c_name").like("%9")
        & (F.col("c_acctbal") < 8000) & (F.col("c_acctbal") > 100)
    )
    counts = t.customer.where(wanted).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    nations = t.nation.where(F.col("n_regionkey") != 2)
    return (
        counts.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name").agg(F.sum("n").alias("n"))
    )


@query("prj_rlike", r"""
select page_id, url from pages where regexp_matches(url, '^https://[a-z.]+/(en|de)/[0-9]+')""")
def url_rlike(t):
    return t.pages.where(F.col("url").rlike("^https://[a-z.]+/(en|de)/[0-9]+")).select("page_id", "url")


@query("prj_drop_junk", r"""
select doc_id, count(*) n_lines, sum(length(line))::bigint n_chars
from (select doc_id, unnest(string_split(text, chr(10))) line from documents)
where not contains(line, '***') and contains(line, ',') group by doc_id""")
def drop_junk(t):
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    kept = lines.where(~F.col("line").contains("***") & F.col("line").contains(","))
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


@query("prj_array_slice", """
select vec_id, list_transform(embedding[2:len(embedding)-2], lambda x: cast(x as double)) middle from embeddings""")
def array_slice(t):
    middle = F.slice("embedding", F.lit(2), F.size("embedding") - 3)
    return t.embeddings.select("vec_id", middle.cast("array<double>").alias("middle"))


@query("prj_computed", """
select cast(p_partkey as varchar) part_key, p_size + 1 as size_next, cast(trunc(p_retailprice) as bigint) price_whole from part""")
def computed(t):
    return t.part.select(
        F.col("p_partkey").cast("string").alias("part_key"),
        (F.col("p_size") + 1).alias("size_next"),
        F.col("p_retailprice").cast("bigint").alias("price_whole"),
    )


@query("prj_case", """
select o_orderkey, case when o_totalprice >= 100000 and o_totalprice < 300000 then o_totalprice else null end mid_price from orders""")
def case(t):
    price = F.col("o_totalprice")
    return t.orders.select("o_orderkey", F.when((price >= 100000) & (price < 300000), price).alias("mid_price"))


@query("prj_impute_clamp", """
select c_custkey, greatest(0.0, case when c_mktsegment = 'MACHINERY' then 0.0 else c_acctbal end) balance from customer""")
def impute_clamp(t):
    text = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("?")).otherwise(F.col("c_acctbal").cast("string"))
    number = F.when(text == "?", F.lit(0.0)).otherwise(text.try_cast("double"))
    return t.customer.select("c_custkey", F.greatest(F.lit(0.0), number).alias("balance"))


@query("prj_lookup", "select * exclude (o_orderdate) from orders where o_orderkey = 789")
def point_lookup(t):
    return t.orders.where(F.col("o_orderkey") == 789).drop("o_orderdate")


@query("prj_valid_reject", r"""
with tokens as (select case when event_type = 'error' then user_id || 'e' else cast(user_id as varchar) end token from events)
select 'reject' kind, token, count(*) n, cast(null as bigint) total from tokens
where not regexp_matches(token, '^-?[0-9]+$') group by token
union all
select 'valid', null, count(*), cast(sum(cast(token as bigint)) as bigint) from tokens where regexp_matches(token, '^-?[0-9]+$')""")
def valid_reject(t):
    user = F.col("user_id").cast("string")
    tokens = t.events.select(F.when(F.col("event_type") == "error", F.concat(user, F.lit("e"))).otherwise(user).alias("token"))
    valid, rejected = relational.split_valid(tokens, "token", "^-?[0-9]+$")
    total = valid.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("token").try_cast("bigint")).alias("total"))
    return rejected.select(F.lit("reject").alias("kind"), "token", "n", F.lit(None).cast("bigint").alias("total")).unionByName(
        total.select(F.lit("valid").alias("kind"), F.lit(None).cast("string").alias("token"), "n", "total")
    )


@query("prj_select_distinct", "select distinct p_brand, p_type from part")
def select_distinct(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("prj_sample")
def sample(t):
    """Seeded sampling without and with replacement; sampling is the operator."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    once = rows.sample(withReplacement=False, fraction=0.2, seed=42).withColumn("way", F.lit("without replacement"))
    again = rows.sample(withReplacement=True, fraction=0.2, seed=42).withColumn("way", F.lit("with replacement"))
    return once.unionByName(again)


@query("prj_random_split")
def random_split(t):
    """A seeded 60/40 split; the parts are disjoint and cover the table."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return relational.random_split(rows, rows.columns, {"train": 0.6, "test": 0.4}, seed=123)


@query("prj_digit_split", """
select o_orderkey, case when o_orderkey % 10 < 6 then 'training' when o_orderkey % 10 < 8 then 'validation' else 'test' end part
from orders""")
def digit_split(t):
    part = relational.digit_split(F.col("o_orderkey"), {"training": 6, "validation": 8}, "test")
    return t.orders.select("o_orderkey", part.alias("part"))


# --- sorting, limits, partitioning ------------------------------------------------------


@query("so_order", """
select n_nationkey, n_name, row_number() over (order by n_regionkey desc, n_name) as position from nation""")
def order(t):
    out = ordered.with_row_number(t.nation, [], [F.col("n_regionkey").desc(), F.col("n_name")], "position")
    return out.select("n_nationkey", "n_name", "position").orderBy("position")


@query("so_topk_avg", """
select l_partkey, round(avg(l_quantity), 4) avg_quantity from lineitem group by l_partkey
order by avg_quantity desc, l_partkey limit 10""")
def topk_avg(t):
    averages = t.lineitem.groupBy("l_partkey").agg(F.round(F.avg("l_quantity"), 4).alias("avg_quantity"))
    return averages.orderBy(F.col("avg_quantity").desc(), "l_partkey").limit(10)


@query("so_topk_count", """
select o_custkey, count(*) n from orders group by o_custkey order by n desc, o_custkey limit 10""")
def topk_count(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), "o_custkey").limit(10)


@query("so_bottomk", r"""
select token, count(*) n from (select unnest(string_split(lower(text), ' ')) token from documents)
group by token order by n, token desc limit 20""")
def bottomk(t):
    tokens = t.documents.select(F.explode(F.split(F.lower("text"), " ")).alias("token"))
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).orderBy("n", F.col("token").desc()).limit(20)


@query("so_offset", "select p_partkey, p_retailprice from part order by p_retailprice desc, p_partkey limit 10 offset 1")
def offset(t):
    ranked = t.part.select("p_partkey", "p_retailprice").orderBy(F.col("p_retailprice").desc(), "p_partkey")
    return ranked.offset(1).limit(10)


@query("so_custom_partition", """
select cast(right(c_name, 1) as integer) % 5 as part, count(*) n from customer group by 1""")
def custom_partition(t):
    placed = relational.by_key_rule(t.customer, relational.last_digit_rule(F.col("c_name"), 5), 5)
    return placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


# --- set operations ---------------------------------------------------------------------


@query("set_union_all", """
select c_name as name, c_nationkey as nationkey from customer union all select s_name, s_nationkey from supplier""")
def union_all(t):
    customers = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"))
    return customers.unionByName(t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey")))


@query("set_union_distinct", """
select distinct node from (select 'N' || c_nationkey as node from customer union all select c_mktsegment from customer)""")
def union_distinct(t):
    nations = t.customer.select(F.concat(F.lit("N"), F.col("c_nationkey")).alias("node"))
    return nations.union(t.customer.select("c_mktsegment")).distinct()


@query("set_difference", """
select o_orderkey from orders except select l_orderkey from lineitem where l_returnflag = 'R'""")
def difference(t):
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.select("o_orderkey").subtract(returned)


@query("set_distinct", "select distinct l_partkey, l_suppkey from lineitem")
def distinct(t):
    return t.lineitem.select("l_partkey", "l_suppkey").dropDuplicates()
