"""Training loops written as passes over the rows, each checked by SQL with its steps unrolled."""

import numpy as np
from pyspark.sql import functions as F

from lodestone.functions import columns as fn
from lodestone.operators import descent, factors, lloyd, moments, trees
from lodestone.plans.registry import query
from lodestone.session import stored

_KEY = "l_orderkey || '-' || l_linenumber || '-' || l_partkey"
_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_SCALED = ", ".join(f"({c}::double - (select avg({c}::double) from lineitem)) / (select stddev_samp({c}::double) from lineitem) x{i}" for i, c in enumerate(_COLUMNS, 1))


def _line_key():
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")


def _scaled_lines(t):
    """Line items with the features 1 and four columns of mean 0 and deviation 1; the label is whether one was returned."""
    lines = t.lineitem
    moments = lines.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in _COLUMNS for f, n in ((F.avg, "m"), (F.stddev_samp, "s"))])  # one row
    scaled = [(F.col(c).cast("double") - F.col(f"m_{c}")) / F.col(f"s_{c}") for c in _COLUMNS]
    label = (F.col("l_returnflag") == "R").cast("double")
    return lines.join(F.broadcast(moments)).select(_line_key().alias("key"), label.alias("label"), F.array(F.lit(1.0), *scaled).alias("features"))


# --- gradient descent --------------------------------------------------------------------------

_POINTS = [descent.Point(step, l2, l1) for step, l2, l1 in ((0.5, 0.0, 0.0), (1.0, 0.0, 0.0), (1.0, 0.1, 0.0), (1.0, 0.0, 0.01))]
_STEPS, _FRACTION = 5, 0.5


def _sgd_sql(loss: str) -> str:
    """CTEs w0 .. wT (weights of every point) and g1 .. gT (mean gradients and losses) of one loss."""
    margin = "(w0 + " + " + ".join(f"w{i} * x{i}" for i in range(1, 5)) + ")"
    slope, value = {
        "logistic": (f"1 / (1 + exp(-{margin})) - y", f"ln(1 + exp(-(2 * y - 1) * {margin}))"),
        "hinge": (f"case when (2 * y - 1) * {margin} < 1 then 1 - 2 * y else 0 end", f"greatest(0, 1 - (2 * y - 1) * {margin})"),
    }[loss]
    start = " union all ".join(f"select {p.step} step, {p.l2} l2, {p.l1} l1, 0.0::double w0, 0.0::double w1, 0.0::double w2, 0.0::double w3, 0.0::double w4" for p in _POINTS)
    parts = [f"{loss}0 as ({start})"]
    for t in range(1, _STEPS + 1):
        sums = ", ".join(f"avg(e * x{i}) g{i}" for i in range(5))
        penalty = "any_value(l2 / 2 * (" + " + ".join(f"w{i} * w{i}" for i in range(5)) + ") + l1 * (" + " + ".join(f"abs(w{i})" for i in range(5)) + "))"
        parts.append(f"""{loss}_g{t} as (
    select step, l2, l1, count(*) n, avg(v) + {penalty} loss, {sums}
    from (select *, {slope} e, {value} v from rows, {loss}{t - 1} where substr(md5(key || '-{t}'), 1, 8) < '{int(_FRACTION * (1 << 32)):08x}') group by all)""")
        eta = f"(step / sqrt({t}))"
        moved = ", ".join(f"(1 - {eta} * l2) * w{i} - {eta} * g{i} v{i}" for i in range(5))
        drawn = ", ".join(f"sign(v{i}) * greatest(0, abs(v{i}) - {eta} * l1) w{i}" for i in range(5))
        parts.append(f"{loss}{t} as (select step, l2, l1, {drawn} from (select step, l2, l1, {moved} from {loss}{t - 1} join {loss}_g{t} using (step, l2, l1)))")
    return ", ".join(parts)


_SGD = f"with rows as (select {_KEY} as key, (l_returnflag = 'R')::int y, 1.0::double x0, {_SCALED} from lineitem), " + _sgd_sql("logistic") + ", " + _sgd_sql("hinge")


def _swept(t, loss):
    return descent.descend(_scaled_lines(t), F.col("key"), F.col("label"), F.col("features"), _POINTS, _STEPS, loss, _FRACTION)


@query("ml_sgd_sweep", _SGD + " " + " union all ".join(
    f"select '{loss}' as model, step::double step, l2::double l2, l1::double l1, {t} as iteration, n as batch_rows, round(loss, 6) loss from {loss}_g{t}"
    for loss in ("logistic", "hinge") for t in range(1, _STEPS + 1)))
def sgd_sweep(t):
    """Loss of every iteration over step sizes and penalties, for logistic regression and a linear support vector machine."""
    rows = []
    for loss in ("logistic", "hinge"):
        for done in _swept(t, loss)[1]:
            rows += [(loss, p.step, p.l2, p.l1, done.iteration, done.rows, float(x)) for p, x in zip(_POINTS, done.losses)]
    out = t.spark.createDataFrame(rows, "model string, step double, l2 double, l1 double, iteration int, batch_rows bigint, loss double")
    return out.withColumn("loss", F.round("loss", 6))


@query("ml_sgd_models", _SGD + " " + " union all ".join(
    f"""select '{loss}' as model, step::double step, l2::double l2, l1::double l1, round(w0, 6) + 0.0 w0, round(w1, 6) + 0.0 w1, round(w2, 6) + 0.0 w2, round(w3, 6) + 0.0 w3, round(w4, 6) + 0.0 w4,
    round(avg(((w0 + w1 * x1 + w2 * x2 + w3 * x3 + w4 * x4 > 0)::int = y)::int), 6) accuracy
  from rows, {loss}{_STEPS} group by all""" for loss in ("logistic", "hinge")))
def sgd_models(t):
    """Weights after the last iteration, and the share of all rows that each model labels rightly."""
    lines, out = _scaled_lines(t), None
    for loss in ("logistic", "hinge"):
        weights, _ = _swept(t, loss)
        right = [F.avg(((descent.margin(F.col("features"), w) > 0).cast("double") == F.col("label")).cast("int")).alias(f"a{i}") for i, w in enumerate(weights)]
        models = [
            F.struct(F.lit(loss).alias("model"), *[F.lit(getattr(p, c)).alias(c) for c in ("step", "l2", "l1")], *[(F.round(F.lit(float(x)), 6) + 0.0).alias(f"w{k}") for k, x in enumerate(w)], F.round(f"a{i}", 6).alias("accuracy"))
            for i, (p, w) in enumerate(zip(_POINTS, weights))
        ]
        rows = lines.agg(*right).select(F.inline(F.array(*models)))
        out = rows if out is None else out.unionByName(rows)
    return out


# --- trees -------------------------------------------------------------------------------------

_BINS = 16
_BINNED = "[" + ", ".join(
    f"least({_BINS - 1}, greatest(0, floor(({c}::double - (select min({c}::double) from lineitem)) / ((select max({c}::double) from lineitem) - (select min({c}::double) from lineitem)) * {_BINS})))::int"
    for c in _COLUMNS) + "]"


def _tree_sql(depth: int, kind: str, least_rows: int, weights: list[str], features: int | None = None) -> str:
    """CTEs at0 .. atD (node of every row and tree) and nodes0 .. nodesD."""
    measure = {
        "gini": lambda pos, n: f"2 * ({pos} / {n}) * (1 - {pos} / {n})",
        "entropy": lambda pos, n: "(" + " + ".join(f"case when {p} > 0 then -({p}) * log2({p}) else 0 end" for p in (f"{pos} / {n}", f"1 - {pos} / {n}")) + ")",
    }[kind]
    drawn = " union all ".join(f"select {i} tree, key, y, bins, {w} w from binned" for i, w in enumerate(weights))
    parts = [f"binned as (select row_number() over () rid, {_KEY} as key, (l_returnflag = 'R')::int y, {_BINNED} bins from lineitem)", f"at0 as (select *, 0 node from ({drawn}) where w > 0)"]
    for level in range(depth + 1):
        few = "" if features is None else f"qualify row_number() over (partition by tree, node order by md5(tree || '-' || node || '-' || feature)) <= {features}"
        parts.append(f"""cuts{level} as (
    select *, case when ln >= {least_rows} and n - ln >= {least_rows} then round({measure('pos', 'n')} - (ln * {measure('lp', 'ln')} + (n - ln) * {measure('(pos - lp)', '(n - ln)')}) / n, 9) end gain
    from (select tree, node, feature, bin, sum(n) over upto ln, sum(pos) over upto lp, sum(n) over total n, sum(pos) over total pos
          from (select tree, node, f feature, bins[f + 1] bin, sum(w) n, sum(w * y) pos from at{level}, unnest(range(4)) r(f) where node >= {(1 << level) - 1} group by all)
          window upto as (partition by tree, node, feature order by bin), total as (partition by tree, node, feature)))""")
        parts.append(f"few{level} as (select * from (select distinct tree, node, feature from cuts{level}) {few})")
        parts.append(f"best{level} as (select tree, node, feature, bin border, gain from cuts{level} join few{level} using (tree, node, feature) where gain > 0 {'and false' if level == depth else ''} qualify row_number() over (partition by tree, node order by gain desc, feature, bin) = 1)")
        parts.append(f"nodes{level} as (select tree, node, n::bigint n, pos::bigint pos, feature, border, gain from (select tree, node, max(n) n, max(pos) pos from cuts{level} group by all) left join best{level} using (tree, node))")
        parts.append(f"at{level + 1} as (select tree, key, y, bins, w, case when feature is null then node else 2 * node + 1 + (bins[feature + 1] > border)::int end node from at{level} left join best{level} using (tree, node))")
    return ",\n".join(parts)


def _node_rows(depth: int) -> str:
    return " union all ".join(f"select * from nodes{level}" for level in range(depth + 1))


def _binned(t):
    """(key, label, bins): four columns of line items in 16 bins of equal width each."""
    lines = t.lineitem
    borders = lines.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in _COLUMNS for f, n in ((F.min, "low"), (F.max, "high"))])  # one row
    bins = [trees.equal_width_bins(F.col(c).cast("double"), F.col(f"low_{c}"), F.col(f"high_{c}"), _BINS) for c in _COLUMNS]
    return lines.join(F.broadcast(borders)).select(_line_key().alias("key"), (F.col("l_returnflag") == "R").cast("int").alias("label"), F.array(*bins).alias("bins"))


@query("ml_tree_levels", " union all ".join(
    f"select '{kind}' as impurity, node, n, pos, feature, border, gain from (with {_tree_sql(3, kind, 20, ['1'])} {_node_rows(3)})" for kind in ("gini", "entropy")))
def tree_levels(t):
    """All nodes of a tree of depth 3 over line items, by Gini impurity and by entropy."""
    rows, out = stored(_binned(t), "binned"), None
    for kind in ("gini", "entropy"):
        nodes = trees.leaves(trees.grow(rows, 3, kind, least_rows=20))
        nodes = nodes.select(F.lit(kind).alias("impurity"), "node", "n", "pos", F.col("feature").cast("bigint").alias("feature"), "border", "gain")
        out = nodes if out is None else out.unionByName(nodes)
    return out


_TREES = 4
_DRAWN = [" + ".join(f"(substr(md5(key || '-{i}'), 1, 8) >= '{int(p * (1 << 32)):08x}')::int" for p in trees._POISSON) for i in range(_TREES)]
_FOREST = f"with {_tree_sql(3, 'gini', 20, _DRAWN, 2)}"


def _drawn_lines(t):
    """(label, bins, drawn): binned line items, and how often each tree draws them, which every level asks for."""
    drawn = F.array(*[trees.bootstrap_weight(F.col("key"), i) for i in range(_TREES)])
    return stored(_binned(t).select("label", "bins", drawn.alias("drawn")), "drawn")


def _forest(rows):
    return trees.grow(rows, 3, "gini", 20, [F.col("drawn")[i] for i in range(_TREES)], features=2)


@query("ml_forest_nodes", f"{_FOREST} select tree, node, n, pos, feature, border, gain from ({_node_rows(3)})")
def forest_nodes(t):
    """All nodes of a forest: rows drawn by a Poisson bootstrap, two features to choose from at every node."""
    return trees.leaves(_forest(_drawn_lines(t))).withColumn("feature", F.col("feature").cast("bigint"))


@query("ml_forest_oob", f"""{_FOREST},
says as (select tree, node, 2 * pos > n yes from ({_node_rows(3)})),
walk0 as (select tree, rid, y, bins, 0 node from (select i tree, rid, y, bins, [{', '.join(_DRAWN)}] w from binned, unnest(range({_TREES})) r(i)) where w[tree + 1] = 0),
""" + ", ".join(f"walk{k + 1} as (select tree, rid, y, bins, case when feature is null then node else 2 * node + 1 + (bins[feature + 1] > border)::int end node from walk{k} left join best{k} using (tree, node))" for k in range(3)) + """,
voted as (select rid, any_value(y) y, count(*) asked, count(*) filter (yes) said from walk3 left join says using (tree, node) group by rid)
select asked, count(*) as "rows", count(*) filter ((2 * said > asked) <> (y = 1)) wrong, round(avg(((2 * said > asked) <> (y = 1))::int), 6) error from voted group by asked""")
def forest_oob(t):
    """Error of the votes of those trees that did not draw a row, by the number of such trees."""
    rows = _drawn_lines(t)
    outside = [F.col("drawn")[i] == 0 for i in range(_TREES)]
    share = trees.votes(rows, _forest(rows), outside)
    asked = sum(o.cast("int") for o in outside).cast("bigint")
    voted = rows.select("label", asked.alias("asked"), share.alias("share")).where("asked > 0")
    wrong = (F.col("share") > 0.5) != (F.col("label") == 1)
    return voted.groupBy("asked").agg(F.count(F.lit(1)).alias("rows"), F.count_if(wrong).alias("wrong"), F.round(F.avg(wrong.cast("int")), 6).alias("error"))


# --- clusters and moments ----------------------------------------------------------------------

_K, _ROUNDS = 5, 4
_LLOYD = f"""with v as (select vec_id, list_transform(embedding, lambda x: x::double) x from embeddings),
c0 as (select row_number() over (order by md5(vec_id::varchar), vec_id::varchar) - 1 cluster, x centre from v qualify cluster < {_K})""" + "".join(f""",
a{t} as (select vec_id, x, cluster, list_distance(x, centre) ** 2 d from v, c{t - 1} qualify row_number() over (partition by vec_id order by list_distance(x, centre) ** 2, cluster) = 1),
m{t} as (select cluster, slot, avg(v) v from (select cluster, unnest(range(len(x))) slot, unnest(x) v from a{t}) group by all),
c{t} as (select cluster, coalesce(centre_now, centre) centre from c{t - 1} left join (select cluster, list(v order by slot) centre_now from m{t} group by 1) using (cluster))""" for t in range(1, _ROUNDS + 1))


def _clustered(t):
    rows = t.embeddings.select("vec_id", fn.doubles(F.col("embedding")).alias("x"))
    return rows, *lloyd.fit(rows, F.col("x"), lloyd.hash_chosen(rows, F.col("vec_id"), F.col("x"), _K), _ROUNDS)


@query("ml_lloyd_cost", _LLOYD + " " + " union all ".join(
    f"select {t} as iteration, c.cluster, count(vec_id) n, round(coalesce(sum(d), 0), 4) cost from c0 c left join a{t} a on a.cluster = c.cluster group by 2" for t in range(1, _ROUNDS + 1)))
def lloyd_cost(t):
    """Rows and squared distances of every cluster in every iteration, from centres chosen by hash."""
    _, _, passes = _clustered(t)
    rows = [(p.iteration, k, n, cost) for p in passes for k, (n, cost) in enumerate(zip(p.sizes, p.costs))]
    return t.spark.createDataFrame(rows, "iteration int, cluster bigint, n bigint, cost double").withColumn("cost", F.round("cost", 4))


@query("ml_lloyd_members", _LLOYD + f""" select vec_id, cluster, round(list_distance(x, centre) ** 2, 5) distance from v, c{_ROUNDS}
qualify row_number() over (partition by vec_id order by list_distance(x, centre) ** 2, cluster) = 1""")
def lloyd_members(t):
    """The cluster of every vector after the last iteration."""
    rows, centres, _ = _clustered(t)
    out = lloyd.assigned(rows, "vec_id", F.col("x"), centres)
    return out.select("vec_id", F.col("cluster").cast("bigint").alias("cluster"), F.round("distance", 5).alias("distance"))


@query("fe_covariance", """
with u as (select vec_id, unnest(range(len(embedding))) i, unnest(embedding)::double v from embeddings)
select a.i, b.i j, round(covar_samp(a.v, b.v), 7) as value from u a join u b on a.vec_id = b.vec_id and a.i <= b.i group by all""")
def covariance(t):
    """Upper triangle of the covariance matrix of the embeddings, from moments merged in one pass."""
    _, _, matrix = moments.covariance(t.embeddings, F.col("embedding"))
    cells = [(int(i), int(j), float(matrix[i, j])) for i, j in zip(*np.triu_indices(len(matrix)))]
    return t.spark.createDataFrame(cells, "i bigint, j bigint, value double").withColumn("value", F.round("value", 7))


@query("fe_explained_variance")
def explained_variance(t):
    """Variance along each of the ten first principal components, by itself and as a running share of the whole."""
    _, _, matrix = moments.covariance(t.embeddings, F.col("embedding"))
    values, _ = moments.principal(matrix, min(10, len(matrix)))
    rows = [(k, float(v), float(s)) for k, (v, s) in enumerate(zip(values, np.cumsum(values) / np.trace(matrix)), 1)]
    out = t.spark.createDataFrame(rows, "component int, variance double, share double")
    return out.select("component", F.round("variance", 7).alias("variance"), F.round("share", 6).alias("share"))


# --- factors -----------------------------------------------------------------------------------

_REG, _HALF_STEPS = 0.1, 4


def _als_sql() -> str:
    """CTEs of four half-steps of rank 2, whose normal equations are solved by Cramer's rule, and of the loss after each."""
    start = ", ".join(f"(('0x' || substr(md5(i::varchar || '-{k}'), 1, 8))::ubigint)::double / 4294967296 {c}" for k, c in enumerate("ab"))
    parts = [f"""r as (select o_custkey u, l_partkey i, avg(l_quantity)::double v from orders join lineitem on o_orderkey = l_orderkey group by all),
i0 as (select i, {start} from (select distinct i from r))"""]
    last = {"u": None, "i": "i0"}
    for step in range(1, _HALF_STEPS + 1):
        own, other = ("u", "i") if step % 2 else ("i", "u")
        name = f"{own}{step}"
        parts.append(f"""{name} as (
    select {own}, (bb * ra - ab * rb) / (aa * bb - ab * ab) a, (aa * rb - ab * ra) / (aa * bb - ab * ab) b
    from (select {own}, sum(a * a) + {_REG} * count(*) aa, sum(a * b) ab, sum(b * b) + {_REG} * count(*) bb, sum(a * v) ra, sum(b * v) rb from r join {last[other]} using ({other}) group by all))""")
        last[own] = name
        parts.append(f"""loss{step} as (
    select {step} as half_step, count(*) n, sqrt(avg((v - x.a * y.a - x.b * y.b) ** 2)) rmse,
        (sum((v - x.a * y.a - x.b * y.b) ** 2) + {_REG} * sum(x.a * x.a + x.b * x.b + y.a * y.a + y.b * y.b)) / count(*) objective
    from r join {last['u']} x using (u) join {last['i']} y using (i))""")
    return "with " + ", ".join(parts)


def _bought(t):
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_custkey").alias("u"), F.col("l_partkey").alias("i")).agg(F.avg("l_quantity").alias("v"))


@query("ml_als_steps", _als_sql() + " " + " union all ".join(f"select half_step, n, round(rmse, 5) rmse, round(objective, 5) objective from loss{k}" for k in range(1, _HALF_STEPS + 1)))
def als_steps(t):
    """Errors and penalised objective after every half-step of a factorization of rank 2."""
    out = None
    for step, loss, _, _ in factors.alternate(stored(_bought(t), "bought"), "u", "i", "v", 2, _REG, _HALF_STEPS // 2):
        objective = (F.col("squared") + F.col("penalty")) / F.col("n")
        row = loss.select(F.lit(step).alias("half_step"), "n", F.round(F.sqrt(F.col("squared") / F.col("n")), 5).alias("rmse"), F.round(objective, 5).alias("objective"))
        out = row if out is None else out.unionByName(row)
    return out


@query("ml_als_factors", _als_sql() + f""" select 'user' as side, u as key, round(a, 4) + 0.0 f0, round(b, 4) + 0.0 f1 from u{_HALF_STEPS - 1}
union all select 'item', i, round(a, 4) + 0.0, round(b, 4) + 0.0 from i{_HALF_STEPS}""")
def als_factors(t):
    """Factors of all customers and parts after the last half-step."""
    *_, (_, _, users, items) = factors.alternate(stored(_bought(t), "bought"), "u", "i", "v", 2, _REG, _HALF_STEPS // 2)
    sides = [side.select(F.lit(name).alias("side"), "key", *[(F.round(F.col("f")[k], 4) + 0.0).alias(f"f{k}") for k in (0, 1)]) for name, side in (("user", users), ("item", items))]
    return sides[0].unionByName(sides[1])
