"""Feature engineering plans."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    DCT, PCA, Binarizer, Bucketizer, ElementwiseProduct, IndexToString, MaxAbsScaler, MinMaxScaler, Normalizer, OneHotEncoder,
    PolynomialExpansion, RFormula, StandardScaler, StringIndexer, VectorAssembler, VectorIndexer, VectorSlicer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lodestone.functions import columns as fn
from lodestone.operators import features as fe
from lodestone.operators import quantiles, spectral
from lodestone.plans.registry import query
from lodestone.session import stored

LINE = ["l_orderkey", "l_linenumber", "l_partkey"]


def _embeddings(t):
    return t.embeddings.select("vec_id", array_to_vector(fn.doubles(F.col("embedding"))).alias("x"))


@query("fe_binarizer", "select l_orderkey, l_linenumber, l_partkey, case when l_discount > 0.05 then 1.0 else 0.0 end::double flag from lineitem")
def binarizer(t):
    return Binarizer(threshold=0.05, inputCol="l_discount", outputCol="flag").transform(t.lineitem.select(*LINE, "l_discount")).select(*LINE, "flag")


@query("fe_bucketizer", """
select p_partkey, case when p_retailprice < 950 then 0.0 when p_retailprice < 1000 then 1.0 else 2.0 end::double bucket from part""")
def bucketizer(t):
    stage = Bucketizer(splits=[float("-inf"), 950.0, 1000.0, float("inf")], inputCol="p_retailprice", outputCol="bucket")
    return stage.transform(t.part.select("p_partkey", "p_retailprice")).select("p_partkey", "bucket")


@query("fe_quantile", """
with r as (select o_totalprice x, row_number() over (order by o_totalprice) rn, count(*) over () n from orders),
     q as (select min(x) filter (where rn = (n * 1 + 4) // 5) a, min(x) filter (where rn = (n * 2 + 4) // 5) b,
                  min(x) filter (where rn = (n * 3 + 4) // 5) c, min(x) filter (where rn = (n * 4 + 4) // 5) d from r)
select o_orderkey, ((o_totalprice >= a)::int + (o_totalprice >= b)::int + (o_totalprice >= c)::int + (o_totalprice >= d)::int)::double bucket
from orders, q""")
def quantile(t):
    return fe.quantile_buckets(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 5, "bucket").select("o_orderkey", "bucket")


@query("fe_dct", """
with v as (select vec_id, list_transform(embedding, lambda x: x::double) a from embeddings)
select vec_id, list_transform(range(len(a)), lambda k: round(case when k = 0 then sqrt(1.0 / len(a)) else sqrt(2.0 / len(a)) end *
  list_sum(list_transform(range(len(a)), lambda i: a[i + 1] * cos(pi() * (i + 0.5) * k / len(a)))), 6) + 0.0) dct from v""")
def dct(t):
    return fe.apply(_embeddings(t), DCT(inverse=False, inputCol="x", outputCol="dct"), "dct").select("vec_id", "dct")


@query("fe_hadamard", """
select vec_id, list_transform(range(len(embedding)), lambda i: round(embedding[i + 1]::double * i, 6) + 0.0) product from embeddings""")
def hadamard(t):
    stage = ElementwiseProduct(scalingVec=Vectors.dense([float(i) for i in range(64)]), inputCol="x", outputCol="product")
    return fe.apply(_embeddings(t), stage, "product").select("vec_id", "product")


_PRIORITY_INDEX = """(select o_orderpriority p, (row_number() over (order by count(*) desc, o_orderpriority) - 1)::double idx from orders group by 1)"""


def _indexer():
    return StringIndexer(inputCol="o_orderpriority", outputCol="idx", handleInvalid="error", stringOrderType="frequencyDesc")


@query("fe_string_indexer", f"select o_orderkey, idx from orders join {_PRIORITY_INDEX} on p = o_orderpriority")
def string_indexer(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    return _indexer().fit(rows).transform(rows).select("o_orderkey", "idx")


@query("fe_index_to_string", f"select o_orderkey, idx, p as original from orders join {_PRIORITY_INDEX} on p = o_orderpriority")
def index_to_string(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    model = _indexer().fit(rows)
    back = IndexToString(inputCol="idx", outputCol="original", labels=model.labels)
    return back.transform(model.transform(rows)).select("o_orderkey", "idx", "original")


@query("fe_one_hot", f"""
select o_orderkey, list_transform(range((select count(distinct o_orderpriority) - 1 from orders)), lambda i: (i = idx)::int::double) hot
from orders join {_PRIORITY_INDEX} on p = o_orderpriority""")
def one_hot(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    model = Pipeline(stages=[_indexer(), OneHotEncoder(inputCol="idx", outputCol="hot", dropLast=True)]).fit(rows)
    return model.transform(rows).select("o_orderkey", vector_to_array("hot").alias("hot"))


@query("fe_one_of_k", """
with b as (select p_brand, (row_number() over (order by count(*) desc, p_brand) - 1) idx, count(*) over () k from part group by 1)
select p_partkey, list_concat(list_transform(range(k), lambda i: (i = idx)::int::double), [p_size::double, p_retailprice]) features
from part join b using (p_brand)""")
def one_of_k(t):
    stages = [
        StringIndexer(inputCol="p_brand", outputCol="brand_idx"), OneHotEncoder(inputCol="brand_idx", outputCol="brand", dropLast=False),
        VectorAssembler(inputCols=["brand", "p_size", "p_retailprice"], outputCol="features"),
    ]
    model = Pipeline(stages=stages).fit(t.part)
    return model.transform(t.part).select("p_partkey", vector_to_array("features").alias("features"))


@query("fe_maxabs", """
select c_custkey, [round(c_acctbal / a, 6) + 0.0, round(c_nationkey / b, 6) + 0.0] scaled
from customer, (select max(abs(c_acctbal)) a, max(abs(c_nationkey)) b from customer)""")
def maxabs(t):
    rows = t.customer.select("c_custkey", fe.vector("c_acctbal", "c_nationkey").alias("x"))
    return fe.apply(rows, MaxAbsScaler(inputCol="x", outputCol="scaled"), "scaled").select("c_custkey", "scaled")


@query("fe_minmax", """
select p_partkey, [round((p_size - a) / (b - a), 6), round((p_retailprice - c) / (d - c), 6), 0.5::double] scaled
from part, (select min(p_size) a, max(p_size) b, min(p_retailprice) c, max(p_retailprice) d from part)""")
def minmax(t):
    rows = t.part.withColumn("same", F.lit(7.0)).select("p_partkey", fe.vector("p_size", "p_retailprice", "same").alias("x"))
    return fe.apply(rows, MinMaxScaler(inputCol="x", outputCol="scaled"), "scaled").select("p_partkey", "scaled")


@query("fe_normalizer", """
with v as (select vec_id, list_transform(embedding, lambda x: x::double) a from embeddings)
select vec_id, list_transform(a, lambda x: round(x / list_sum(list_transform(a, lambda y: abs(y))), 6) + 0.0) l1,
  list_transform(a, lambda x: round(x / sqrt(list_dot_product(a, a)), 6) + 0.0) l2,
  list_transform(a, lambda x: round(x / list_max(list_transform(a, lambda y: abs(y))), 6) + 0.0) linf from v""")
def normalizer(t):
    out = _embeddings(t)
    for p, name in ((1.0, "l1"), (2.0, "l2"), (float("inf"), "linf")):
        out = fe.apply(out, Normalizer(p=p, inputCol="x", outputCol=name), name)
    return out.select("vec_id", "l1", "l2", "linf")


@query("fe_standard", """
select l_orderkey, l_linenumber, l_partkey, [round((l_quantity - a) / b, 6) + 0.0, round((l_extendedprice - c) / d, 6) + 0.0] scaled
from lineitem, (select avg(l_quantity) a, stddev_samp(l_quantity) b, avg(l_extendedprice) c, stddev_samp(l_extendedprice) d from lineitem)""")
def standard(t):
    rows = t.lineitem.select(*LINE, fe.vector("l_quantity", "l_extendedprice").alias("x"))
    return fe.apply(rows, StandardScaler(withMean=True, withStd=True, inputCol="x", outputCol="scaled"), "scaled").select(*LINE, "scaled")


@query("fe_poly", """
select l_orderkey, l_linenumber, l_partkey, [l_quantity, round(l_quantity * l_quantity, 6), l_discount, round(l_quantity * l_discount, 6),
  round(l_discount * l_discount, 6)] expanded from lineitem""")
def poly(t):
    rows = t.lineitem.select(*LINE, fe.vector("l_quantity", "l_discount").alias("x"))
    return fe.apply(rows, PolynomialExpansion(degree=2, inputCol="x", outputCol="expanded"), "expanded").select(*LINE, "expanded")


@query("fe_assembler", "select p_partkey, [p_size::double, p_retailprice, p_size * 2.0::double, 1.0::double] features from part")
def assembler(t):
    pair = array_to_vector(F.array(F.col("p_size") * F.lit(2.0), F.lit(1.0)))
    rows = t.part.select("p_partkey", "p_size", "p_retailprice", pair.alias("pair"))
    stage = VectorAssembler(inputCols=["p_size", "p_retailprice", "pair"], outputCol="features")
    return stage.transform(rows).select("p_partkey", vector_to_array("features").alias("features"))


@query("fe_vector_indexer", """
select l_orderkey, l_linenumber, l_partkey, [idx::double, l_quantity] indexed from lineitem
join (select l_linenumber n, row_number() over (order by l_linenumber) - 1 idx from lineitem group by 1) on n = l_linenumber""")
def vector_indexer(t):
    rows = t.lineitem.select(*LINE, fe.vector("l_linenumber", "l_quantity").alias("x"))
    return fe.apply(rows, VectorIndexer(maxCategories=10, inputCol="x", outputCol="indexed"), "indexed").select(*LINE, "indexed")


@query("fe_vector_slicer", "select vec_id, [embedding[2]::double, embedding[6]::double] part from embeddings")
def vector_slicer(t):
    stage = VectorSlicer(inputCol="x", outputCol="part", indices=[1, 5])
    return stage.transform(_embeddings(t)).select("vec_id", vector_to_array("part").alias("part"))


@query("fe_rformula", """
with s as (select o_orderstatus, row_number() over (order by count(*) desc, o_orderstatus) - 1 idx, count(*) over () k from orders group by 1)
select o_orderkey, [o_totalprice] || list_transform(range(k - 1), lambda i: (i = idx)::int::double) features,
  left(o_orderpriority, 1)::double as label from orders join s using (o_orderstatus)""")
def rformula(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", F.left("o_orderpriority", F.lit(1)).cast("double").alias("level"))
    model = RFormula(formula="level ~ o_totalprice + o_orderstatus", featuresCol="features", labelCol="label").fit(rows)
    return model.transform(rows).select("o_orderkey", vector_to_array("features").alias("features"), "label")


_CHI_FEATURES = ["l_linestatus", "l_linenumber", "discount", "tax"]


@query("fe_chisq", """
with long as (unpivot (select l_returnflag as label, l_linestatus, cast(l_linenumber as varchar) l_linenumber,
    cast(cast(round(l_discount * 100) as bigint) as varchar) discount, cast(cast(round(l_tax * 100) as bigint) as varchar) tax from lineitem)
    on l_linestatus, l_linenumber, discount, tax into name feature value value),
  c as (select feature, value, label, count(*) n from long group by 1, 2, 3),
  j as (select *, sum(n) over (partition by feature, value) r, sum(n) over (partition by feature, label) k, sum(n) over (partition by feature) t from c)
select feature, round(max(t) * (sum(n * n / (r * k)) - 1), 4) statistic, (count(distinct value) - 1) * (count(distinct label) - 1) freedom
from j group by feature order by statistic desc, feature limit 2""")
def chisq(t):
    rows = t.lineitem.select(
        "l_returnflag", "l_linestatus", "l_linenumber", F.round(F.col("l_discount") * 100).cast("bigint").alias("discount"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("tax"),
    )
    statistics = fe.chi_square(rows, "l_returnflag", _CHI_FEATURES)
    return fe.top_features(statistics.withColumn("statistic", F.round("statistic", 4)), 2)


@query("fe_pca")
def pca(t):
    """Projection of every vector on the first five principal components."""
    rows = spectral.centred(t.embeddings.select("vec_id", "embedding"), "embedding")
    rows = rows.select("vec_id", array_to_vector("embedding").alias("x"))
    return fe.apply(rows, PCA(k=5, inputCol="x", outputCol="projected"), "projected").select("vec_id", "projected")


@query("fe_svd")
def svd(t):
    """U * S of the centred vectors: the principal projection up to sign."""
    rows = spectral.centred(t.embeddings.select("vec_id", "embedding"), "embedding")
    _, directions = spectral.singular(rows, "embedding", 5)
    return spectral.project(rows, "embedding", directions, "projected").select("vec_id", fn.rounded(F.col("projected"), 6).alias("projected"))


@query("fe_target_mean", """
select l_orderkey, l_linenumber, l_partkey, round(avg((l_returnflag = 'R')::int) over (partition by l_suppkey), 6) rate from lineitem""")
def target_mean(t):
    rows = t.lineitem.select(*LINE, "l_suppkey", "l_returnflag")
    out = fe.target_mean(rows, "l_suppkey", F.col("l_returnflag") == "R", "rate")
    return out.select(*LINE, F.round("rate", 6).alias("rate"))


@query("fe_multi_hot", """
with d as (select p_brand, row_number() over (order by p_brand) - 1 idx from part group by 1)
select o_orderkey, case when o_orderstatus = 'F' then 1 else 0 end as label, list(distinct idx order by idx) slots
from orders join lineitem on o_orderkey = l_orderkey join part on l_partkey = p_partkey join d using (p_brand) group by 1, 2""")
def multi_hot(t):
    items = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("o_orderkey"), "p_brand")
    raw = F.when(F.col("o_orderstatus") == "F", 1).otherwise(-1)
    labels = t.orders.select("o_orderkey", F.when(raw == -1, 0).otherwise(raw).alias("label"))
    return labels.join(fe.multi_hot(items, "o_orderkey", "p_brand", fe.dictionary(t.part, "p_brand")), "o_orderkey")


@query("fe_class_weight", """
select doc_id, toxic, round(case when toxic = 0 then r else 1 - r end, 6) weight from labels, (select avg(toxic) r from labels)""")
def class_weight(t):
    return fe.class_weight(t.labels.select("doc_id", "toxic"), "toxic", "weight").withColumn("weight", F.round("weight", 6))


@query("fe_sparse_rows", """
with c as (select o_custkey, l_partkey, cast(sum(l_quantity) as bigint) q from orders join lineitem on o_orderkey = l_orderkey group by 1, 2),
     n as (select *, (row_number() over (partition by o_custkey order by l_partkey) - 1) // 16 as chunk from c)
select o_custkey, chunk, string_agg(l_partkey || ':' || q, ' ' order by l_partkey) cells from n group by 1, 2""")
def sparse_rows(t):
    rows = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    cells = rows.groupBy("o_custkey", "l_partkey").agg(F.sum("l_quantity").cast("bigint").alias("q"))
    return fe.sparse_rows(stored(cells, "cells"), "o_custkey", "l_partkey", "q", 16)


@query("fe_kll_borders", "select i::int as border, (select count(*) from lineitem) n, true as within from range(1, 10) r(i)")
def kll_borders(t):
    """Ten parts of the prices from sketches of each return flag, merged; exact ranks tell whether each border is within twice the error."""
    parts = stored(quantiles.sketched(t.lineitem, ["l_returnflag"], F.col("l_extendedprice")), "sketches")
    whole = quantiles.merged(parts).select(F.kll_sketch_get_n_double("sketch").alias("n"), quantiles.borders(F.col("sketch"), 10).alias("cuts"))
    whole = stored(whole, "borders")  # one row
    price = F.col("l_extendedprice").cast("double")
    below, upto = F.size(F.filter("cuts", lambda c: c < price)), F.size(F.filter("cuts", lambda c: c <= price))
    ranks = t.lineitem.join(F.broadcast(whole)).groupBy(below.alias("below"), upto.alias("upto")).agg(F.count(F.lit(1)).alias("rows"))  # a row per place
    cuts = whole.select("n", F.posexplode("cuts").alias("k", "cut")).join(F.broadcast(stored(ranks, "ranks")))
    # a value lies under border k if fewer than k + 1 borders are at most it
    counted = cuts.groupBy("n", "k").agg(F.sum(F.when(F.col("upto") <= F.col("k"), F.col("rows")).otherwise(0)).alias("lower"), F.sum(F.when(F.col("below") <= F.col("k"), F.col("rows")).otherwise(0)).alias("higher"))
    share, error = (F.col("k") + 1) / 10, 2 * quantiles.rank_error()
    within = (F.col("lower") / F.col("n") <= share + error) & (F.col("higher") / F.col("n") >= share - error)
    return counted.select((F.col("k") + 1).alias("border"), "n", within.alias("within"))
