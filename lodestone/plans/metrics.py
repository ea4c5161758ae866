"""Evaluation plans: document length as the score of the quality label."""

from pyspark.sql import functions as F

from lodestone.operators import metrics, ordered
from lodestone.plans.registry import query

_SCORED = "with s as (select l.doc_id, quality as label, n_chars // 100 as score, case when n_chars >= 600 then 1 else 0 end as prediction from labels l join documents d on l.doc_id = d.doc_id)"


def _scored(t):
    joined = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return joined.select(
        "doc_id", F.col("quality").alias("label"), F.expr("n_chars div 100").alias("score"),
        F.when(F.col("n_chars") >= 600, 1).otherwise(0).alias("prediction"),
    )


@query("ev_accuracy", _SCORED + "select round(avg((label = prediction)::int), 6) accuracy, round(1 - avg((label = prediction)::int), 6) error from s")
def accuracy(t):
    out = metrics.accuracy(_scored(t), "label", "prediction")
    return out.select(F.round("accuracy", 6).alias("accuracy"), F.round("error", 6).alias("error"))


@query("ev_auc", _SCORED + """,
r as (select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2 mid from s)
select round((sum(mid) filter (where label = 1) - count(*) filter (where label = 1) * (count(*) filter (where label = 1) + 1) / 2)
  / (count(*) filter (where label = 1) * count(*) filter (where label = 0)), 6) auc from r""")
def auc(t):
    return metrics.area_under_roc(_scored(t), "score", "label").select(F.round("auc", 6).alias("auc"))


_POINTS = _SCORED + """,
c as (select score, count(*) filter (where label = 1) p, count(*) filter (where label = 0) n from s group by score),
q as (select score, sum(p) over (order by score desc) tp, sum(n) over (order by score desc) fp, sum(p) over () pp, sum(n) over () nn from c)"""


@query("ev_pr_auc", _POINTS + """,
e as (select score, tp / pp r, tp / (tp + fp) pr from q),
l as (select r, pr, lag(r, 1, 0) over (order by score desc) r0, lag(pr) over (order by score desc) p0 from e)
select round(sum((r - r0) * (pr + coalesce(p0, pr)) / 2), 6) area from l""")
def pr_auc(t):
    return metrics.area_under_pr(_scored(t), "score", "label").select(F.round("area", 6).alias("area"))


@query("ev_roc_points", _POINTS + "select score as threshold, round(fp / nn, 6) fpr, round(tp / pp, 6) tpr from q")
def roc_points(t):
    out = metrics.roc_points(_scored(t), "score", "label")
    return out.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query("ev_confusion", _SCORED + "select label, prediction, count(*) n from s group by 1, 2")
def confusion(t):
    return metrics.confusion(_scored(t), "label", "prediction")


@query("ev_prf", _SCORED + """,
b as (select k as label, count(*) filter (where label = k) actual, count(*) filter (where prediction = k) predicted,
        count(*) filter (where label = k and prediction = k) hits from s, (select unnest([0, 1]) k) group by k),
f as (select label, actual, coalesce(hits / nullif(predicted, 0), 0) p, coalesce(hits / nullif(actual, 0), 0) r from b),
g as (select *, coalesce(2 * p * r / nullif(p + r, 0), 0) f1 from f)
select label, actual, round(p, 6) "precision", round(r, 6) recall, round(f1, 6) f1, round(sum(f1 * actual) over () / sum(actual) over (), 6) weighted_f1 from g""")
def prf(t):
    out = metrics.class_report(metrics.confusion(_scored(t), "label", "prediction"))
    return out.select("label", "actual", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "weighted_f1")])


@query("ev_rmse", """
with p as (select l_quantity q, avg(l_quantity) over (partition by l_partkey) m from lineitem)
select round(avg((q - m) * (q - m)), 6) mse, round(sqrt(avg((q - m) * (q - m))), 6) rmse from p""")
def rmse(t):
    rows = t.lineitem.select("l_partkey", "l_quantity")
    beside = ordered.with_group_values(rows, ["l_partkey"], predicted=F.avg("l_quantity"))
    out = metrics.squared_error(beside, F.col("l_quantity"), F.col("predicted"))
    return out.select(F.round("mse", 6).alias("mse"), F.round("rmse", 6).alias("rmse"))


_RANKED = """
with u as (select distinct o_custkey as u, p_type as seg, p_brand as item, l_partkey from orders join lineitem on o_orderkey = l_orderkey join part on p_partkey = l_partkey),
pop as (select c_mktsegment seg, item, row_number() over (partition by c_mktsegment order by count(*) desc, item) place
        from (select distinct u, item from u) join customer on c_custkey = u group by 1, 2 qualify place <= 10),
pred as (select c_custkey u, item, place from customer join pop on seg = c_mktsegment),
act as (select distinct o_custkey u, p_brand item from orders join lineitem on o_orderkey = l_orderkey join part on p_partkey = l_partkey where l_returnflag = 'R'),
sz as (select u, count(*) n from act group by u),
hit as (select u, place, row_number() over (partition by u order by place) h from pred join act using (u, item)),
sc as (select u, sum(h / place) s from hit group by u)"""


def _ranked(t):
    """Predictions: the ten brands most bought in the customer's segment. Actual: brands the customer returned."""
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    bought = lines.select(F.col("o_custkey").alias("u"), F.col("p_brand").alias("item"), "l_returnflag")
    segments = t.customer.select(F.col("c_custkey").alias("u"), F.col("c_mktsegment").alias("seg"))
    counts = bought.select("u", "item").distinct().join(segments, "u").groupBy("seg", "item").agg(F.count(F.lit(1)).alias("n"))
    popular = ordered.top_per_group(counts, ["seg"], [F.col("n").desc(), F.col("item")], 10, "place")
    predicted = segments.join(popular.select("seg", "item", "place"), "seg").select("u", "item", "place")
    return bought.where(F.col("l_returnflag") == "R"), predicted


@query("ev_mapk", _RANKED + """
select round(avg(case when n is null then 1.0 else coalesce(s, 0) / least(n, 10) end), 6) mapk, count(*) n_users
from customer left join sz on sz.u = c_custkey left join sc on sc.u = c_custkey""")
def mapk(t):
    actual, predicted = _ranked(t)
    out = metrics.average_precision(actual, predicted, "u", "item", "place", 10)
    return out.agg(F.round(F.avg("ap"), 6).alias("mapk"), F.count(F.lit(1)).alias("n_users"))


@query("ev_map", _RANKED + """
select round(avg(case when n is null then 0.0 else coalesce(s, 0) / n end), 6) "map", count(*) n_users
from customer left join sz on sz.u = c_custkey left join sc on sc.u = c_custkey""")
def mean_average_precision(t):
    actual, predicted = _ranked(t)
    out = metrics.average_precision(actual, predicted, "u", "item", "place", 10, cut=False)
    return out.agg(F.round(F.avg("ap"), 6).alias("map"), F.count(F.lit(1)).alias("n_users"))
