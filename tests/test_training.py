"""Gradient descent, trees, clusters, moments, sampled similarities and incremental windows against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import descent, factors, lloyd, moments, quantiles, similarity, text, topics, trees
from lodestone.plans import QUERIES
from lodestone.streaming import jobs, panes

# ------------------------------------------------------------------ gradient descent


def labelled(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.c_[np.ones(n), rng.normal(size=(n, 3))]
    y = (x @ [0.3, 2.0, -1.0, 0.0] + rng.normal(size=n) > 0).astype(float)
    rows = [(i, float(label), [float(v) for v in f]) for i, (label, f) in enumerate(zip(y, x))]
    return x, y, spark.createDataFrame(rows, "id long, label double, x array<double>").repartition(3)


@pytest.mark.parametrize("loss", descent.LOSSES)
def test_steps_equal_a_plain_loop(spark, loss):
    x, y, df = labelled(spark)
    points = [descent.Point(0.5), descent.Point(0.1, l2=0.2), descent.Point(0.3, l1=0.05)]
    weights, progress = descent.descend(df, F.col("id"), F.col("label"), F.col("x"), points, 6, loss, fraction=0.5)
    rows = {(t, r["id"]) for t in range(1, 7) for r in df.where(descent.in_batch(F.col("id").cast("string"), t, 0.5)).select("id").collect()}
    for k, p in enumerate(points):
        w = np.zeros(4)
        for t in range(1, 7):
            own = [i for i in range(len(y)) if (t, i) in rows]
            assert progress[t - 1].rows == len(own)
            values, slopes = descent.slopes(loss, (x[own] @ w)[:, None], y[own])
            assert progress[t - 1].losses[k] == pytest.approx(values.mean() + p.l2 / 2 * w @ w + p.l1 * abs(w).sum())
            eta = p.step / math.sqrt(t)
            w = (1 - eta * p.l2) * w - eta * x[own].T @ slopes[:, 0] / len(own)
            w = np.sign(w) * np.maximum(0, abs(w) - eta * p.l1)
        assert weights[k] == pytest.approx(w)


@pytest.mark.parametrize("loss", descent.LOSSES)
def test_slopes_are_derivatives(loss):
    margins, y, h = np.linspace(-3, 3, 61)[:, None] + 0.013, np.arange(61) % 2, 1e-6
    up, down = descent.slopes(loss, margins + h, y)[0], descent.slopes(loss, margins - h, y)[0]
    assert descent.slopes(loss, margins, y)[1] == pytest.approx((up - down) / (2 * h), abs=1e-5)


def test_descent_learns_and_stops(spark):
    x, y, df = labelled(spark)
    weights, progress = descent.descend(df, F.col("id"), F.col("label"), F.col("x"), [descent.Point(1.0), descent.Point(1e-9)], 60, tolerance=1e-2)
    assert len(progress) < 60 and progress[-1].losses[0] < 0.6 * progress[0].losses[0]
    assert ((x @ weights[0] > 0) == (y == 1)).mean() > 0.8  # of the labels, a seventh are noise
    assert progress[0].rows == len(y) and abs(weights[1]).max() < 1e-8


def test_descent_of_odd_rows(spark):
    df = spark.createDataFrame([(1, 1.0, [1.0]), (2, None, [1.0]), (3, 0.0, None), (1, 1.0, [1.0]), (None, 0.0, [2.0])], "id long, label double, x array<double>")
    weights, progress = descent.descend(df, F.col("id"), F.col("label"), F.col("x"), [descent.Point(0.1)], 2)
    assert [p.rows for p in progress] == [3, 3] and weights.shape == (1, 1)
    assert descent.descend(df.limit(0), F.col("id"), F.col("label"), F.col("x"), [descent.Point(0.1)], 2)[1] == []


# ------------------------------------------------------------------ trees


def brute_tree(rows, depth, kind, least):
    """{node: (n, pos, feature, border, gain)} of rows (label, bins, weight)."""
    def measure(pos, n):
        p = pos / n
        return 2 * p * (1 - p) if kind == "gini" else sum(-q * math.log2(q) for q in (p, 1 - p) if q > 0)

    out, open_nodes = {}, {0: rows}
    for level in range(depth + 1):
        below = defaultdict(list)
        for node, own in open_nodes.items():
            n, pos = sum(w for _, _, w in own), sum(w * y for y, _, w in own)
            best = None
            for f in range(len(own[0][1])):
                for b in sorted({bins[f] for _, bins, _ in own}):
                    ln, lp = sum(w for _, bins, w in own if bins[f] <= b), sum(w * y for y, bins, w in own if bins[f] <= b)
                    if ln >= least and n - ln >= least:
                        gain = round(measure(pos, n) - (ln * measure(lp, ln) + (n - ln) * measure(pos - lp, n - ln)) / n, 9)
                        if gain > 0 and (best is None or gain > best[2] + 1e-12):
                            best = (f, b, gain)
            if level == depth or best is None:
                out[node] = (n, pos, None, None, None)
                continue
            out[node] = (n, pos, *best)
            for row in own:
                below[2 * node + 1 + (row[1][best[0]] > best[1])].append(row)
        open_nodes = below
    return out


@pytest.mark.parametrize("kind", ["gini", "entropy"])
def test_tree_equals_a_plain_one(spark, kind):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        bins = [rng.randrange(8), rng.randrange(5), rng.randrange(3)]
        rows.append((int((bins[0] > 4) ^ (bins[1] > 2) if rng.random() < 0.9 else rng.random() < 0.5), bins, rng.randrange(0, 3)))
    df = spark.createDataFrame(rows, "label int, bins array<int>, w int").repartition(3)
    forest = trees.grow(df, 3, kind, 5, [F.col("w")])
    got = {r["node"]: (r["n"], r["pos"], r["feature"], r["border"], r["gain"]) for r in trees.leaves(forest).collect()}
    want = brute_tree([r for r in rows if r[2]], 3, kind, 5)
    assert {k: v[:4] for k, v in got.items()} == {k: v[:4] for k, v in want.items()}
    reached = Counter({r["at"]: r["n"] for r in df.groupBy(forest.node(F.col("bins"), 0).alias("at")).agg(F.sum("w").alias("n")).collect()})
    assert all(want[node][0] == n for node, n in reached.items() if n)


def test_bootstrap_weight_hashes_once(spark):
    """A row's hash is not made anew for every bound of the Poisson number, nor in every level of the forest's queries."""
    rows = spark.range(50).select(F.col("id").cast("string").alias("key"))
    drawn = rows.select("key", trees.bootstrap_weight(F.col("key"), 3).alias("w"))
    assert drawn._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    for row in drawn.collect():
        digest = hashlib.md5(f"{row['key']}-3".encode()).hexdigest()[:8]
        assert row["w"] == sum(digest >= f"{int(p * (1 << 32)):08x}" for p in trees._POISSON)
    plan = QUERIES["ml_forest_oob"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "md5(" not in plan


def test_forest_draws_and_votes(spark):
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        bins = [rng.randrange(6) for _ in range(4)]
        rows.append((str(i), int(bins[0] + bins[1] > 5), bins))
    df = spark.createDataFrame(rows, "key string, label int, bins array<int>").repartition(4)
    drawn = [trees.bootstrap_weight(F.col("key"), k) for k in range(6)]
    counts = [df.agg(F.avg(w), F.avg((w == 0).cast("int")), F.var_samp(w)).first() for w in drawn]
    assert all(abs(m - 1) < 0.1 and abs(z - math.exp(-1)) < 0.05 and abs(v - 1) < 0.2 for m, z, v in counts)
    forest = trees.grow(df, 4, "gini", 5, drawn, features=2)
    again = trees.grow(df.repartition(2), 4, "gini", 5, drawn, features=2)
    assert forest.splits == again.splits
    assert len({s[0] for t in forest.splits for s in t.values()}) > 2  # not always the same features
    share = trees.votes(df, forest, [w == 0 for w in drawn])
    asked = df.select("label", share.alias("share"), sum((w == 0).cast("int") for w in drawn).alias("asked"))
    assert asked.where("(asked = 0) <> (share IS NULL)").count() == 0
    assert asked.where("share IS NOT NULL").agg(F.avg(((F.col("share") > 0.5) == (F.col("label") == 1)).cast("int"))).first()[0] > 0.85


def test_tree_of_odd_rows(spark):
    df = spark.createDataFrame([(1, [1]), (1, [2]), (None, [1]), (0, None)], "label int, bins array<int>")
    assert [(r["n"], r["pos"], r["feature"]) for r in trees.leaves(trees.grow(df, 2)).collect()] == [(2, 2, None)]
    assert trees.leaves(trees.grow(df.limit(0), 2)).count() == 0


# ------------------------------------------------------------------ clusters and moments


def test_lloyd_equals_a_plain_loop(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 1, (80, 5)) for c in (0, 4, 9)])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(999, None)], "id long, x array<double>").repartition(4)
    start = np.vstack([lloyd.hash_chosen(df, F.col("id"), F.col("x"), 3), np.full(5, 1e6)])  # the last is nobody's centre
    centres, passes = lloyd.fit(df, F.col("x"), start, 12)
    now = start.copy()
    for p in passes:
        found, squared = lloyd.nearest(x, now)
        assert p.sizes == tuple(np.bincount(found, minlength=4)) and sum(p.costs) == pytest.approx(squared.sum())
        now = np.array([x[found == k].mean(axis=0) if (found == k).any() else now[k] for k in range(4)])
    assert centres == pytest.approx(now) and centres[3] == pytest.approx(1e6)
    costs = [sum(p.costs) for p in passes]
    assert all(b <= a + 1e-6 for a, b in zip(costs, costs[1:]))
    rows = {r["id"]: r for r in lloyd.assigned(df, "id", F.col("x"), centres).collect()}
    assert len(rows) == 241 and rows[999]["cluster"] is None
    assert [rows[i]["cluster"] for i in range(240)] == lloyd.nearest(x, centres)[0].tolist()


def test_moments_and_components(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 6)) @ np.diag([5, 3, 1, 1, 0.5, 0.1]) @ rng.normal(size=(6, 6)) + 1e6
    df = spark.createDataFrame([([float(v) for v in r],) for r in x] + [(None,)], "x array<double>").repartition(5)
    n, means, matrix = moments.covariance(df, F.col("x"))
    assert n == 500 and means == pytest.approx(x.mean(axis=0)) and matrix == pytest.approx(np.cov(x.T), rel=1e-8)
    values, vectors = moments.principal(matrix, 3)
    want, directions = np.linalg.eigh(np.cov(x.T))
    assert values == pytest.approx(want[::-1][:3])
    assert abs((vectors * directions[:, ::-1][:, :3]).sum(axis=0)) == pytest.approx(np.ones(3), abs=1e-6)
    parts = [moments.packed_moments(df.where(c), F.col("x")) for c in ("x[0] > 1000000", "NOT x[0] > 1000000")]
    both = parts[0].unionByName(parts[1]).groupBy("slot").agg(F.sum("v").alias("v")).orderBy("slot").toPandas()["v"].to_numpy()
    assert both == pytest.approx(moments.packed_moments(df, F.col("x")).orderBy("slot").toPandas()["v"].to_numpy())
    assert moments.covariance(df.limit(0), F.col("x"))[0] == 0


# ------------------------------------------------------------------ sampled similarities


def ratings(spark, seed=4, users=300, items=120):
    rng = random.Random(seed)
    cells = {}
    for i in range(items):
        group = i % 12
        for _ in range(rng.randrange(3, 30)):
            u = rng.randrange(users) if rng.random() < 0.4 else group * 20 + rng.randrange(20)
            cells[u, i] = rng.choice([0.5, 1.0, 4.0, 25.0])
        cells[9999, i] = 0.2  # a user who rated everything
    cells[5000, 0], cells[5000, 1] = 500.0, 400.0  # all of a similarity in one row
    rows = [(u, i, v) for (u, i), v in cells.items()] + [(None, 1, 2.0), (3000, None, 2.0), (3001, 2, None), (3002, 3, 0.0)]
    return cells, spark.createDataFrame(rows, "u long, i long, v double").repartition(4)


def exact(cells, threshold):
    norm, rows = defaultdict(float), defaultdict(list)
    for (u, i), v in cells.items():
        norm[i] += v * v
        rows[u].append((i, v))
    dots = defaultdict(float)
    for own in rows.values():
        for i, v in own:
            for j, w in own:
                if i != j:
                    dots[i, j] += v * w / math.sqrt(norm[i] * norm[j])
    return {p: s for p, s in dots.items() if s >= threshold}


def test_similar_columns_are_found_and_exact(spark):
    cells, df = ratings(spark)
    want = exact(cells, 0.2)
    got = {(r["item"], r["other"]): r["similarity"] for r in similarity.similar_columns(df, "u", "i", "v", 0.2).collect()}
    assert got.keys() == want.keys() and len(want) > 100
    assert all(got[p] == pytest.approx(s) for p, s in want.items())
    assert similarity.similar_columns(df.limit(0), "u", "i", "v", 0.2).count() == 0


def test_recall_follows_the_bound(spark):
    """With a chance of a miss of 10 % at the threshold, at least 90 % of the pairs are met, and far fewer draws are made."""
    cells, df = ratings(spark, users=200)
    want = {p for p in exact(cells, 0.3) if p[0] < p[1]}
    unit = similarity.unit_columns(df, "u", "i", "v")
    sizes = []
    for miss in (0.1, 1e-6):
        rate = similarity.sampling_rate(0.3, miss)
        met = similarity.sampled_pairs(unit, rate).collect()
        found = {(r["a"], r["b"]) for r in met if r["hits"] >= similarity.LEAST_HITS}
        assert len(found & want) >= (1 - miss) * len(want)
        sizes.append(sum(r["hits"] for r in met))
        everything = exact(cells, 0)
        estimates = [(r["hits"] / rate, everything[r["a"], r["b"]]) for r in met if r["hits"] > 40]
        assert all(abs(e - s) < 6 * math.sqrt(s / rate) + 0.05 for e, s in estimates)
    assert sizes[0] < sizes[1]


def test_draws_do_not_grow_with_the_pairs(spark):
    """A user with 3,000 items has four million pairs; unlike items cost few draws."""
    rows = [(0, i, 1.0) for i in range(3000)] + [(1 + i, i, 40.0) for i in range(3000)]
    unit = similarity.unit_columns(spark.createDataFrame(rows, "u long, i long, v double"), "u", "i", "v")
    met = similarity.sampled_pairs(unit, similarity.sampling_rate(0.3, 1e-6))
    assert met.agg(F.sum("hits")).first()[0] < 300_000  # rate / 2 * (3000 / 40) ** 2
    assert met.where(F.col("hits") >= 3).count() < 40_000


# ------------------------------------------------------------------ streams


def write_events(spark, folder, number, rows):
    spark.createDataFrame(rows, "id long, at timestamp, kind string").coalesce(1).write.mode("append").parquet(f"{folder}/in")


def run_panes(spark, folder, minutes=10, per_window=3):
    stream = jobs.read_stream(spark, "parquet", spark.read.parquet(f"{folder}/in").schema, path=f"{folder}/in", maxFilesPerTrigger="1")
    windows = panes.sliding_counts(stream, "at", "kind", F.col("id"), minutes * 60, per_window, "5 minutes", salts=2)
    return panes.merged(panes.drained(windows, f"{folder}/state", f"{folder}/out"))


def brute_windows(rows, upto, minutes=10, per_window=3):
    pane, out = minutes * 60, Counter()
    for _, at, kind in rows:
        start = int((at - datetime(1970, 1, 1)).total_seconds()) // pane * pane
        for k in range(per_window):
            first = start - k * pane
            if first + per_window * pane <= upto:
                out[kind, first, n_end(first, pane, per_window)] += 1
    return out


def n_end(first, pane, per_window):
    return first + pane * per_window


def test_panes_over_many_batches_and_a_restart(spark, folder):
    """Windows equal a batch count; the state holds a bounded number of panes; a second start goes on from the checkpoint."""
    rng, rows, sizes = random.Random(8), [], []
    begin = datetime(2024, 5, 1)
    for batch in range(6):
        now = [(batch * 1000 + i, begin + timedelta(minutes=60 * batch + rng.randrange(60), seconds=rng.randrange(60)), rng.choice(["a", "b", None])) for i in range(40)]
        if batch == 4:
            now = [r for r in now if r[2] != "b"]  # a gap of one key
        rows += now
        write_events(spark, folder, batch, now)
        out = run_panes(spark, folder).collect()
        store = spark.read.format("statestore").option("stateVarName", "panes").load(f"{folder}/state")
        sizes.append(store.count())
    upto = int((max(r[1] for r in rows) - timedelta(minutes=5) - datetime(1970, 1, 1)).total_seconds())
    got = Counter({(r["key"], int(r["start"].timestamp()), int(r["end"].timestamp())): r["n"] for r in out})
    want = brute_windows(rows, upto)
    assert got == want
    assert max(sizes[2:]) <= 3 * 2 * (3 + 2)  # keys, salts, panes of a window and those still open


def test_each_user_follows_the_item_clicked_last(spark, folder):
    lists = spark.createDataFrame([(1, "a,b"), (2, "c")], "item int, parts string")
    schema = "user long, item int, at long"
    steps = [[(1, 1, 10), (2, 9, 11), (3, 2, 12)], [(1, 2, 20), (3, 9, 21), (None, 1, 22)], [(1, 1, 15), (4, 1, 30), (4, 2, 31)]]
    for rows in steps:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/clicks")
        stream = jobs.read_stream(spark, "parquet", spark.createDataFrame(rows, schema).schema, path=f"{folder}/clicks")
        table = jobs.follow_last_item(stream, lists, "user", "item", ["at"], "recs", f"{folder}/state", f"{folder}/table")
    assert sorted(tuple(r) for r in table.select("user", "parts", "at").collect()) == [(1, "c", 20), (3, "c", 12), (4, "c", 31)]


# ------------------------------------------------------------------ factors


def brute_factors(cells, users, start, rank, reg, steps):
    p, q, losses = {}, dict(start), []
    for step in range(1, steps + 1):
        own, other, at = (p, q, 0) if step % 2 else (q, p, 1)
        by = defaultdict(list)
        for u, i, v in cells:
            by[(u, i)[at]].append(((u, i)[1 - at], v))
        own.clear()
        for key, rows in by.items():
            f, v = np.array([other[k] for k, _ in rows]), np.array([v for _, v in rows])
            own[key] = np.linalg.solve(f.T @ f + reg * len(rows) * np.eye(rank), f.T @ v)
        losses.append(sum((v - p[u] @ q[i]) ** 2 + reg * (p[u] @ p[u] + q[i] @ q[i]) for u, i, v in cells if u in p))
    return p, q, losses


def test_half_steps_equal_normal_equations(spark, monkeypatch):
    """Also when keys are cut into chunks and few keys are solved together; the objective falls with every half-step."""
    monkeypatch.setattr(factors, "CHUNK", 7)
    monkeypatch.setattr(factors, "BLOCK", 16)
    rng = np.random.default_rng(3)
    true = rng.normal(size=(60, 3)), rng.normal(size=(40, 3))
    cells = [(int(u), f"item {i}", float(true[0][u] @ true[1][i] + 0.1 * rng.normal())) for u, i in rng.integers(0, (60, 40), size=(900, 2))]
    cells += [(0, f"item {i}", float(i)) for i in range(40)] * 2  # a user with many ratings, and repeated rows
    df = spark.createDataFrame(cells + [(None, "item 1", 1.0), (1, None, 1.0), (1, "item 1", None)], "u long, i string, v double").repartition(5)
    start = {r["key"]: np.array(r["f"]) for r in factors.hash_factors(df.select("i").distinct().dropna(), "i", 4).collect()}
    p, q, losses = brute_factors(cells, 60, start, 4, 0.05, 6)
    got = []
    for _, loss, users, items in factors.alternate(df, "u", "i", "v", 4, 0.05, 3):
        row = loss.first()
        got.append(row["squared"] + row["penalty"])
        assert row["n"] == len(cells)
    assert got == pytest.approx(losses) and all(b < a for a, b in zip(got, got[1:]))
    assert {r["key"]: r["f"] for r in users.collect()} == {k: pytest.approx(list(v), abs=1e-6) for k, v in p.items()}
    assert {r["key"]: r["f"] for r in items.collect()} == {k: pytest.approx(list(v), abs=1e-6) for k, v in q.items()}
    assert [loss.first()["n"] for _, loss, _, _ in factors.alternate(df.limit(0), "u", "i", "v", 4, 0.05, 1)] == [0, 0]


# ------------------------------------------------------------------ quantiles and topics


def test_sketches_of_parts_merge(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=20_000), rng.exponential(size=20_000) * 100, np.full(5000, 3.0)])
    df = spark.createDataFrame([(i % 7, float(v)) for i, v in enumerate(values)] + [(1, None)], "part int, v double").repartition(6)
    parts = quantiles.sketched(df, ["part"], F.col("v"))
    row = quantiles.merged(parts).select(F.kll_sketch_get_n_double("sketch").alias("n"), F.octet_length("sketch").alias("size"), quantiles.borders(F.col("sketch"), 20).alias("cuts")).first()
    assert row["n"] == len(values) and row["size"] < 60 * quantiles.K
    ordered, error = np.sort(values), 2 * quantiles.rank_error()
    for cut in row["cuts"]:
        near = [k / 20 for k in range(1, 20)]
        low, high = np.searchsorted(ordered, cut, "left") / len(values), np.searchsorted(ordered, cut, "right") / len(values)
        assert any(low - error <= q <= high + error for q in near)
    cuts = F.array(F.lit(1.0), F.lit(2.0))
    got = spark.createDataFrame([(0.5,), (1.0,), (1.5,), (9.0,), (None,)], "v double").select(quantiles.bucket(F.col("v"), cuts).alias("b")).collect()
    assert [r["b"] for r in got] == [0, 1, 1, 2, None]


def topic_docs(spark, n=120):
    rng, rows = random.Random(2), []
    for d in range(n):
        words = [f"a{k}" for k in range(8)] if d % 2 else [f"b{k}" for k in range(8)]
        rows += [(d, rng.choice(words if rng.random() < 0.95 else ["common", "x"]), 1) for _ in range(30)]
    tf = spark.createDataFrame(rows, "doc long, term string, one int").groupBy("doc", "term").agg(F.count("one").alias("tf"))
    words = text.vocabulary(tf, "doc", 50, least_documents=2)
    return topics.documents(tf, "doc", words), words


def test_topics_are_told_apart(spark):
    docs, words = topic_docs(spark)
    size = words.count()
    for batches in (1, 3):
        weights, perplexities = topics.fit(docs, size, 2, 15, batches)
        assert perplexities[-1] < 0.8 * perplexities[0]
        rows = topics.topic_terms(weights, words).collect()
        assert all(sum(r["weight"] for r in rows if r["topic"] == k) == pytest.approx(1) for k in (0, 1))
        heaviest = [{r["term"][0] for r in sorted((r for r in rows if r["topic"] == k), key=lambda r: -r["weight"])[:8]} for k in (0, 1)]
        assert sorted(heaviest, key=sorted) == [{"a"}, {"b"}]
    assert all(b <= a * 1.001 for a, b in zip(topics.fit(docs, size, 2, 8)[1], topics.fit(docs, size, 2, 8)[1][1:]))


def test_a_step_equals_a_plain_one(spark):
    docs, words = topic_docs(spark, 20)
    size = words.count()
    start = np.random.default_rng(7).gamma(100.0, 0.01, (3, size))
    beta = np.exp(topics.digamma(start) - topics.digamma(start.sum(axis=1, keepdims=True)))
    counts = np.zeros((3, size))
    for r in docs.collect():
        gamma, phi = topics.shares(np.array(r["terms"]), np.array(r["counts"]), beta, 1 / 3)
        counts[:, r["terms"]] += phi
        assert gamma.sum() == pytest.approx(1 + sum(r["counts"]), rel=1e-3)
    assert topics.fit(docs, size, 3, 1)[0] == pytest.approx(1 / 3 + counts)
    assert topics.fit(docs.limit(0), size, 3, 2)[1] == []


def test_digamma():
    x = np.array([0.01, 0.5, 1.0, 2.0, 7.3, 1000.0])
    want = [-100.56088545786868, -1.9635100260214235, -0.5772156649015329, 0.42278433509846713, 1.917820335541842, 6.907255195648812]
    assert topics.digamma(x) == pytest.approx(want, rel=1e-6)
    assert topics.digamma(x + 1) - topics.digamma(x) == pytest.approx(1 / x, rel=1e-6)
