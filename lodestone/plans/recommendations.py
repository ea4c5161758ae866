"""Recommendation and graph plans."""

from pyspark.sql import functions as F

from lodestone.operators import graph, matrix, ordered, recommend, similarity
from lodestone.plans.registry import query
from lodestone.session import stored

# --- items: brands rated by customers through their mean quantity ---------------------------

_RATINGS = """
with r as (select o_custkey u, p_brand item, avg(l_quantity) v from orders join lineitem on o_orderkey = l_orderkey
           join part on p_partkey = l_partkey group by 1, 2),
     m as (select item, sqrt(sum(v * v)) norm from r group by 1),
     s as (select a.item, b.item as other, round(sum(a.v * b.v) / (max(x.norm) * max(y.norm)), 6) similarity
           from r a join r b on a.u = b.u and a.item <> b.item join m x on x.item = a.item join m y on y.item = b.item group by 1, 2
           having sum(a.v * b.v) / (max(x.norm) * max(y.norm)) >= 0.1),
     t as (select item, other, similarity, row_number() over (partition by item order by similarity desc, other) place from s qualify place <= 20)"""


def _lines(t):
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))


def _ratings(t):
    return _lines(t).groupBy(F.col("o_custkey").alias("u"), F.col("p_brand").alias("item")).agg(F.avg("l_quantity").alias("v"))


def _similar(ratings):
    pairs = recommend.item_cosine(ratings, "u", "item", "v", 0.1)
    return pairs.withColumn("similarity", F.round("similarity", 6))


@query("rc_item_cosine", _RATINGS + "select item, other, similarity from s")
def item_cosine(t):
    return _similar(stored(_ratings(t), "ratings"))


@query("rc_item_sampled", _RATINGS + "select item, other, similarity from s")
def item_sampled(t):
    """The same pairs from sampled co-ratings, verified exactly."""
    pairs = similarity.similar_columns(_ratings(t), "u", "item", "v", 0.1)
    return pairs.withColumn("similarity", F.round("similarity", 6))


@query("rc_part_sampled", """
with r as (select o_custkey u, l_partkey item, sum(l_quantity)::double v from orders join lineitem on o_orderkey = l_orderkey group by 1, 2),
     m as (select item, sqrt(sum(v * v)) norm from r group by 1)
select a.item, b.item as other, round(sum(a.v * b.v) / (max(x.norm) * max(y.norm)), 6) similarity
from r a join r b on a.u = b.u and a.item <> b.item join m x on x.item = a.item join m y on y.item = b.item group by 1, 2
having sum(a.v * b.v) / (max(x.norm) * max(y.norm)) >= 0.2""")
def part_sampled(t):
    """Parts bought by the same customers in like quantities: many items, few of whose pairs are similar."""
    bought = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_custkey").alias("u"), F.col("l_partkey").alias("item"))
    pairs = similarity.similar_columns(bought.agg(F.sum("l_quantity").alias("v")), "u", "item", "v", 0.2)
    return pairs.withColumn("similarity", F.round("similarity", 6))


@query("rc_item_top20", _RATINGS + "select item, other, similarity, place from t")
def item_top20(t):
    return recommend.most_similar(_similar(stored(_ratings(t), "ratings")), 20)


@query("rc_user_items", """
with p as (select distinct o_custkey, l_partkey from orders join lineitem on o_orderkey = l_orderkey),
     n as (select *, (row_number() over (partition by o_custkey order by l_partkey) - 1) // 16 as chunk from p)
select o_custkey, chunk, list(l_partkey order by l_partkey) items from n group by 1, 2""")
def user_items(t):
    pairs = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", "l_partkey").distinct()
    return ordered.chunked_lists(stored(pairs, "pairs"), ["o_custkey"], ["l_partkey"], F.col("l_partkey"), 16, "items")


@query("rc_item_based", _RATINGS + """
, c as (select u, other as item, max(similarity) score from r join t using (item) group by 1, 2)
select u, item, score, row_number() over (partition by u order by score desc, item) place from c
where (u, item) not in (select (u, item) from r) qualify place <= 10""")
def item_based(t):
    ratings = stored(_ratings(t), "ratings")
    similar = stored(recommend.most_similar(_similar(ratings), 20), "similar")
    return recommend.item_based(ratings, similar, "u", "item", 10)


@query("rc_vector_topk", """
with v as (select vec_id, list_transform(embedding, lambda x: x::double) a from embeddings)
select p.vec_id, round(list_cosine_similarity(p.a, q.a), 6) similarity from v p, v q where q.vec_id = 0
order by list_cosine_similarity(p.a, q.a) desc, p.vec_id limit 10 offset 1""")
def vector_topk(t):
    given = t.embeddings.where(F.col("vec_id") == 0).select("embedding").first()[0]  # one vector
    out = recommend.nearest_to(t.embeddings, "vec_id", "embedding", given, 10, skip=1)
    return out.withColumn("similarity", F.round("similarity", 6))


@query("rc_score_all", """
with v as (select vec_id, list_transform(embedding, lambda x: x::double) a from embeddings),
     s as (select p.vec_id as user, q.vec_id as item, list_dot_product(p.a, q.a) score from v p join v q on p.vec_id <> q.vec_id where p.vec_id % 50 = 0)
select user, item, round(score, 6) score, row_number() over (partition by user order by round(s.score, 9) desc, item) place from s qualify place <= 10""")
def score_all(t):
    """Every fiftieth vector as a user against all vectors as items."""
    out = recommend.score_all(t.embeddings.where(F.col("vec_id") % 50 == 0), t.embeddings, "vec_id", "vec_id", "embedding", 10)
    return out.withColumn("score", F.round("score", 6))


@query("rc_user_history", """
with b as (select o_custkey, l_partkey, round(sum(l_quantity), 2) quantity from orders join lineitem on o_orderkey = l_orderkey group by 1, 2)
select o_custkey, l_partkey, p_name, quantity, row_number() over (partition by o_custkey order by quantity desc, l_partkey) place
from b join part on p_partkey = l_partkey qualify place <= 10""")
def user_history(t):
    bought = (
        t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey", "l_partkey").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"))
    )
    best = ordered.top_per_group(bought, ["o_custkey"], [F.col("quantity").desc(), F.col("l_partkey")], 10, "place")
    titles = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return best.join(titles, "l_partkey").select("o_custkey", "l_partkey", "p_name", "quantity", "place")


@query("rc_segment_popular", """
with c as (select l_partkey, count(*) n from lineitem where l_orderkey in (select o_orderkey from orders
             where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')) group by 1 order by n desc, l_partkey limit 10)
select l_partkey, n, p_name from c left join part on p_partkey = l_partkey""")
def segment_popular(t):
    users = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    orders = t.orders.join(users, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")
    counts = (
        t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
        .groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    )
    top = counts.orderBy(F.col("n").desc(), "l_partkey").limit(10)
    titles = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return top.join(titles, "l_partkey", "left")


# --- graphs -----------------------------------------------------------------------------


def _supply(t):
    """Distinct supplier - part edges with the number of line items on each."""
    edges = graph.count_edges(t.lineitem, "l_suppkey", "l_partkey")  # by numbers, which take less memory than names
    return edges.select(F.concat(F.lit("S"), "src").alias("src"), F.concat(F.lit("P"), "dst").alias("dst"), "n")


def _supply_nodes(t):
    suppliers = t.supplier.select(F.concat(F.lit("S"), "s_suppkey").alias("node"), F.col("s_name").alias("name"))
    return suppliers.unionByName(t.part.select(F.concat(F.lit("P"), "p_partkey").alias("node"), F.col("p_name").alias("name")))


@query("gr_degrees", """
with nodes as (select 'S' || s_suppkey node from supplier union all select 'P' || p_partkey from part)
select node, coalesce(o.n, 0) out_degree, coalesce(i.n, 0) in_degree from nodes
left join (select 'S' || l_suppkey node, count(*) n from lineitem group by 1) o using (node)
left join (select 'P' || l_partkey node, count(*) n from lineitem group by 1) i using (node)""")
def degrees(t):
    return graph.degrees(_supply_nodes(t).select("node"), _supply(t), "node")


@query("gr_triplets", """
select 'S' || l_suppkey src, 'P' || l_partkey dst, count(*) n, any_value(s_name) src_name, any_value(p_name) dst_name
from lineitem join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey group by 1, 2""")
def triplets(t):
    return graph.triplets(_supply(t), _supply_nodes(t), "node", "name")


def _market(t):
    """Nation - segment edges, one per customer."""
    named = t.customer.select(F.concat(F.lit("N"), "c_nationkey").alias("a"), F.col("c_mktsegment").alias("b"))
    return graph.count_edges(named, "a", "b")


@query("gr_build", """
with e as (select 'N' || c_nationkey a, c_mktsegment b, count(*) n from customer group by 1, 2),
     v as (select node, row_number() over (order by node) - 1 id from (select a node from e union select b from e))
select 'vertex' as kind, id, null::bigint as other, node as name, null::bigint as n from v
union all select 'edge', s.id, d.id, null, n from e join v s on s.node = a join v d on d.node = b""")
def build(t):
    edges = _market(t)
    nodes = graph.vertices(edges)
    none = F.lit(None)
    return nodes.select(
        F.lit("vertex").alias("kind"), "id", none.cast("bigint").alias("other"), F.col("node").alias("name"), none.cast("bigint").alias("n")
    ).unionByName(
        graph.index_edges(edges, nodes).select(
            F.lit("edge").alias("kind"), F.col("src_id").alias("id"), F.col("dst_id").alias("other"), none.cast("string").alias("name"), "n"
        )
    )


_SIMRANK = """
with e as (select 'N' || c_nationkey a, c_mktsegment b, count(*) n from customer group by 1, 2),
     t as (select b i, a j, n / sum(n) over (partition by a) v from e union all select a, b, n / sum(n) over (partition by b) from e),
     nodes as (select a node from e union select b from e),
     s0 as (select node i, node j, 0.4::double v from nodes)""" + "".join(f""",
     l{k} as (select t.j i, s.j j, sum(t.v * s.v) v from t join s{k - 1} s on s.i = t.i group by 1, 2),
     s{k} as (select i, j, sum(v) v from (select l.i i, t.j j, 0.6 * sum(l.v * t.v) v from l{k} l join t on t.i = l.j group by 1, 2
              union all select i, j, v from s0) group by 1, 2)""" for k in range(1, 6))


@query("rc_simrank", _SIMRANK + " select i, j, round(v, 6) as value from s5")
def simrank(t):
    """Similarity of every nation and segment to all nodes."""
    market = stored(_market(t), "market")
    nodes = market.select(F.col("src").alias("node")).union(market.select("dst")).distinct()
    return graph.simrank(market, nodes, "node", 0.6, 5).withColumn("value", F.round("value", 6))


@query("rc_simrank_items", _SIMRANK + " select i, j, round(v, 6) as value from s5 where i <> j and i in (select b from e)")
def simrank_items(t):
    market = stored(_market(t), "market")
    return graph.without_self(graph.simrank(market, t.customer.select("c_mktsegment").distinct(), "c_mktsegment", 0.6, 5))


@query("rc_matrix_ops", """
with a as (select 'N' || c_nationkey i, c_mktsegment j, count(*)::double v from customer group by 1, 2),
     p as (select x.i i, y.i j, sum(x.v * y.v) v from a x join a y on x.j = y.j group by 1, 2),
     d as (select distinct i, i j, 1.0::double v from a)
select i, j, round(sum(v), 4) as value from (select i, j, v * 0.5 v from p union all select i, j, v from d) group by 1, 2""")
def matrix_ops(t):
    """0.5 * A A' + I for the nation - segment counts A."""
    a = _market(t).select(F.col("src").alias("i"), F.col("dst").alias("j"), F.col("n").cast("double").alias("value"))
    product = matrix.multiply(a, matrix.transpose(a))
    total = matrix.add(matrix.scale(product, 0.5), matrix.identity(a.select("i").distinct(), "i"))
    return total.withColumn("value", F.round("value", 4))
