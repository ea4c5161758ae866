"""Operators against brute force, stream behaviour over several files, plan checks."""

import math
import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyspark
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes
from pyspark.ml.linalg import Vectors
from pyspark.mllib.evaluation import RankingMetrics
from pyspark.sql import functions as F

from lodestone import plans
from lodestone.operators import matrix, metrics, models, ordered, recommend, relational, spectral
from lodestone.session import Tables, clear_scratch, scratch_path, stored
from lodestone.sources import serving
from lodestone.streaming import jobs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def t(spark):
    return Tables(spark, FOLDER)


# --- matrices and recommendation ----------------------------------------------------------


def cells(spark, a):
    return spark.createDataFrame([(int(i), int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a))], "i bigint, j bigint, value double")


@pytest.mark.parametrize("tile", [512, 7, 4])
def test_product_in_tiles(spark, tile):
    random = np.random.default_rng(3)
    a = random.integers(-3, 4, (23, 17)) * (random.random((23, 17)) < 0.4)
    b = random.integers(-3, 4, (17, 19)) * (random.random((17, 19)) < 0.4)
    a[:, 5], b[5, :] = 1, 1  # one inner index that meets everything
    got = np.zeros((23, 19))
    for row in matrix.multiply(cells(spark, a), cells(spark, b), tile).collect():
        got[row["i"], row["j"]] = row["value"]
    assert np.array_equal(got, a @ b)


def test_matrix_sum_scale_transpose(spark):
    a = np.array([[1.0, 2.0], [0.0, 3.0]])
    out = matrix.add(matrix.scale(matrix.transpose(cells(spark, a)), 2.0), cells(spark, a))
    got = {(r["i"], r["j"]): r["value"] for r in out.collect()}
    assert got == {(0, 0): 3.0, (1, 0): 4.0, (1, 1): 9.0, (0, 1): 2.0}


@pytest.mark.parametrize("block", [2048, 37])
def test_score_all_in_blocks(t, block):
    rows = t.embeddings.collect()
    vectors = np.array([r["embedding"] for r in rows], dtype=float)
    ids = np.array([r["vec_id"] for r in rows])
    out = recommend.score_all(t.embeddings, t.embeddings, "vec_id", "vec_id", "embedding", 3, block)
    got = {}
    for r in out.collect():
        got.setdefault(r["user"], []).append((r["place"], r["item"]))
    scores = np.round(vectors @ vectors.T, 9)
    for n, own in enumerate(ids):
        order = [ids[k] for k in np.lexsort((ids, -scores[n])) if ids[k] != own][:3]
        assert [item for _, item in sorted(got[own])] == order


@pytest.mark.parametrize("block", [(1 << 16, 1 << 18), (40, 130)])
def test_best_items_in_blocks(spark, block):
    """All users against all items; equal vectors tie, short ones come last, and a user of length 0 ties everywhere."""
    random = np.random.default_rng(3)
    users, items = random.normal(size=(150, 4)).astype("f4"), (random.normal(size=(700, 4)) * random.gamma(2, size=(700, 1))).astype("f4")
    users[7], items[600:] = 0, items[:100]
    side = lambda x: spark.createDataFrame([(k * 3, v.tolist()) for k, v in enumerate(x)] + [(None, [1.0] * 4), (1, None)], "id int, features array<float>")
    got = {}
    for r in recommend.best_items(side(users), side(items), "id", "features", 5, block).collect():
        got.setdefault(r["user"], []).append((r["place"], r["item"]))
    scores = users.astype("f8") @ items.astype("f8").T
    assert sorted(got) == [3 * k for k in range(150)]
    for k in range(150):
        assert [item for _, item in sorted(got[3 * k])] == [3 * i for i in np.lexsort((np.arange(700), -np.round(scores[k], 9)))[:5]]
    few = recommend.best_items(side(users), side(items[:3]), "id", "features", 5, block)
    assert few.count() == 150 * 3
    assert recommend.best_items(side(users[:0]), side(items), "id", "features", 5).isEmpty()


@pytest.mark.parametrize("width", [8, 64, 5000])
def test_best_items_step_by_step(width):
    """Whatever the steps, no item is left out too early."""
    random = np.random.default_rng(4)
    users, items = random.normal(size=(90, 3)).astype("f4"), (random.normal(size=(900, 3)) * random.gamma(1, size=(900, 1))).astype("f4")
    ids = random.permutation(900)
    order = np.lexsort((ids, -np.linalg.norm(items, axis=1)))
    items, ids = items[order], ids[order]
    found = [np.concatenate(x) for x in zip(*recommend._best(users, items, ids, 6, rows=32, width=width))]
    scores = users.astype("f8") @ items.astype("f8").T
    for k in range(90):
        assert list(found[1][found[0] == k]) == list(np.lexsort((ids, -scores[k]))[:6])


def test_map_equals_ranking_metrics(spark):
    predicted = {1: [5, 3, 9], 2: [1, 2, 3], 3: [7, 8, 9]}
    actual = {1: [3, 9, 11, 12], 2: [4], 3: [7]}
    p = spark.createDataFrame([(u, x, i + 1) for u, xs in predicted.items() for i, x in enumerate(xs)], "u int, item int, place int")
    a = spark.createDataFrame([(u, x) for u, xs in actual.items() for x in xs], "u int, item int")
    mean = metrics.average_precision(a, p, "u", "item", "place", 3, cut=False).agg(F.avg("ap")).first()[0]
    rdd = spark.sparkContext.parallelize([([float(x) for x in predicted[u]], [float(x) for x in actual[u]]) for u in predicted])
    assert math.isclose(mean, RankingMetrics(rdd).meanAveragePrecision)


def test_average_precision_without_actual_items(spark):
    p = spark.createDataFrame([(1, 5, 1)], "u int, item int, place int")
    a = spark.createDataFrame([(2, 5)], "u int, item int")
    assert metrics.average_precision(a, p, "u", "item", "place", 10).first()["ap"] == 1.0


def test_auc_equals_pair_count(spark):
    random = np.random.default_rng(5)
    rows = [(float(s), int(y)) for s, y in zip(random.integers(0, 6, 60), random.integers(0, 2, 60))]
    df = spark.createDataFrame(rows, "s double, y int")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert math.isclose(metrics.area_under_roc(df, "s", "y").first()["auc"], want)


def test_rare_group_larger_than_bound_is_sliced(spark):
    """One key holds a third of the rows; row numbers stay exact and complete."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.lodestone.maxGroupRows", "100")
    try:
        out = ordered.with_row_number(df, ["k"], ["v"], "n").where("k = 0").orderBy("v").collect()
    finally:
        spark.conf.unset("spark.lodestone.maxGroupRows")
    assert [r["n"] for r in out] == list(range(1, 3001))
    assert [r["v"] for r in out] == list(range(0, 9000, 3))


# --- models -----------------------------------------------------------------------------


def test_pca_orthogonal_descending_and_equal_to_svd(spark):
    p = np.array([r["projected"] for r in plans.QUERIES["fe_pca"](spark, FOLDER).orderBy("vec_id").collect()])
    s = np.array([r["projected"] for r in plans.QUERIES["fe_svd"](spark, FOLDER).orderBy("vec_id").collect()])
    assert np.abs(np.abs(p) - np.abs(s)).max() < 1e-4
    gram = p.T @ p
    assert np.abs(gram - np.diag(np.diag(gram))).max() < 1e-2
    assert (np.diff(np.diag(gram)) <= 0).all()


def test_singular_values_against_numpy(t):
    values, _ = spectral.singular(t.embeddings, "embedding", 4)
    x = np.array([r["embedding"] for r in t.embeddings.collect()], dtype=float)
    assert np.allclose(values, np.linalg.svd(x, compute_uv=False)[:4])


def test_sample_is_seeded(t):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    once = sorted(map(tuple, t.lineitem.sample(fraction=0.2, seed=42).select(*keys).collect()))
    assert once == sorted(map(tuple, t.lineitem.sample(fraction=0.2, seed=42).select(*keys).collect()))
    assert 0.15 < len(once) / t.lineitem.count() < 0.25


def test_split_is_disjoint_covers_and_ignores_partitioning(spark, t):
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    parts = plans.QUERIES["prj_random_split"](spark, FOLDER)
    want = sorted(map(tuple, parts.collect()))
    assert sorted(row[:3] for row in want) == sorted(map(tuple, t.lineitem.select(*keys).collect()))
    assert 0.55 < sum(row[3] == "train" for row in want) / len(want) < 0.65
    moved = relational.random_split(t.lineitem.select(*keys).repartition(7), keys, {"train": 0.6, "test": 0.4}, seed=123)
    assert sorted(map(tuple, moved.collect())) == want


def test_classifiers_score_every_row(spark, t):
    for name in ("ml_logreg", "ml_svm", "ml_decision_tree", "ml_random_forest"):
        out = plans.QUERIES[name](spark, FOLDER)
        assert out.count() == t.lineitem.count()
        assert out.where("prediction not in (0.0, 1.0)").isEmpty()


def test_kmeans_assigns_every_row(spark, t):
    out = plans.QUERIES["ml_kmeans"](spark, FOLDER)
    assert out.count() == t.embeddings.count()
    assert out.select("cluster").distinct().count() == 10


def test_kmeans_sweep_uses_the_number_of_clusters(spark):
    rows = {r["k"]: r["wcss"] for r in plans.QUERIES["ml_kmeans_sweep"](spark, FOLDER).collect()}
    assert sorted(rows) == [2, 3, 4, 5, 10, 20]
    assert rows[20] < rows[2]


def test_als_recommendations(spark):
    out = plans.QUERIES["ml_als_topn"](spark, FOLDER)
    assert out.where("isnan(rating) or rating is null").isEmpty()
    assert out.groupBy("user").count().where("count > 10").isEmpty()


def test_als_recommends_to_every_customer(spark, t):
    out = plans.QUERIES["ml_als_topn"](spark, FOLDER)
    assert out.dtypes == [("user", "bigint"), ("place", "int"), ("item", "bigint"), ("rating", "float")]
    got = {}
    for r in out.collect():
        got.setdefault(r["user"], []).append((r["place"], r["rating"]))
    bought = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey").distinct()
    assert set(got) == {r["o_custkey"] for r in bought.collect()}
    assert all([place for place, _ in sorted(rows)] == list(range(1, 11)) for rows in got.values())
    assert all([x for _, x in sorted(rows)] == sorted((x for _, x in rows), reverse=True) for rows in got.values())


def test_grid_search_has_one_best(spark):
    rows = plans.QUERIES["ml_grid_search"](spark, FOLDER).collect()
    assert len(rows) == 6 and sum(r["best"] for r in rows) == 1
    assert max(r["area"] for r in rows) == next(r["area"] for r in rows if r["best"])


def test_ctr_weights_one_per_feature(spark, t):
    out = plans.QUERIES["ml_ctr_weights"](spark, FOLDER)
    assert out.count() == t.part.select("p_brand").distinct().count() == out.select("feature").distinct().count()


def test_model_reports(spark):
    report = plans.QUERIES["rp_model_compare"](spark, FOLDER).collect()
    assert len(report) == 4 and all(0 <= r["accuracy"] <= 1 and 0 <= r["roc"] <= 1 for r in report)
    fraud = plans.QUERIES["rp_fraud_report"](spark, FOLDER).collect()
    assert {(r["part"], r["label"]) for r in fraud} == {(p, y) for p in ("train", "test") for y in (0.0, 1.0)}


def test_model_areas_against_pairs(spark):
    """Area under ROC is the chance that a positive row is scored above a negative one, by probability."""
    random = np.random.default_rng(5)
    rows = [(float(y), Vectors.dense([abs(y + random.normal()), abs(random.normal())])) for y in random.integers(0, 2, 120)]
    df = spark.createDataFrame(rows, ["label", "features"])
    fitted = {"tree": DecisionTreeClassifier(maxDepth=3, seed=1).fit(df), "bayes": NaiveBayes().fit(df), "logistic": LogisticRegression().fit(df)}
    for row in models.binary_report(fitted, df, "label").collect():
        scored = [(r["label"], float(r["probability"][1])) for r in fitted[row["model"]].transform(df).collect()]
        pairs = [(a > b) + (a == b) / 2 for y, a in scored if y == 1 for z, b in scored if z == 0]
        assert math.isclose(row["roc"], sum(pairs) / len(pairs), abs_tol=1e-9) and row["roc"] >= 0.5


def test_scratch_needs_a_shared_folder():
    class Conf(dict):
        pass

    class Context:
        applicationId, master = "app", "spark://host:7077"

    class Session:
        sparkContext = Context()

        def __init__(self, folder=None):
            self.conf = Conf({"spark.checkpoint.dir": folder} if folder else {})

    with pytest.raises(RuntimeError):
        scratch_path(Session(), "x")
    with pytest.raises(RuntimeError):
        scratch_path(Session("/tmp/x"), "x")
    assert scratch_path(Session("hdfs://n/x"), "y").startswith("hdfs://n/x/lodestone-app/y-")


def test_scratch_on_executors_of_this_machine():
    """A plain path is enough for processes of one machine, whatever their working folders are."""

    class Session:
        class sparkContext:
            applicationId, master = "app", "local-cluster[3,4,10240]"

        conf = {"spark.checkpoint.dir": "/tmp/checkpoints"}

    assert scratch_path(Session(), "x").startswith("file:///tmp/checkpoints/lodestone-app/x-")
    Session.conf = {"spark.checkpoint.dir": "checkpoints"}
    assert scratch_path(Session(), "x").startswith(f"{Path.cwd().as_uri()}/checkpoints/lodestone-app/x-")
    Session.conf = {}
    with pytest.raises(RuntimeError):
        scratch_path(Session(), "x")


STORING = "ag_groupwise_max", "ev_auc", "fe_quantile", "ml_baseline_rmse"
ON_EXECUTORS = """
import sys
from pyspark.sql import SparkSession
import __spark_entry__
settings = {"spark.ui.enabled": "false", "spark.executor.memory": "1g", "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": sys.argv[1], "spark.sql.warehouse.dir": sys.argv[1] + "/warehouse"}
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config(map=settings).getOrCreate()
for name in sys.argv[2:]:
    print("rows of", name, __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001").count(), flush=True)
spark.stop()
"""


def spark_home(folder):
    """A home of Spark in which executors can make their working folders, without the settings of this machine."""
    home, given = Path(folder, "home"), Path(pyspark.__file__).parent
    home.mkdir()
    for path in given.iterdir():
        if path.name not in ("conf", "work"):
            (home / path.name).symlink_to(path)
    return str(home)


def test_stored_tables_on_executors(folder):
    """Queries with stored tables run on executors that are processes of their own, with a plain path as spark.checkpoint.dir."""
    repo = str(Path(__file__).resolve().parents[1])
    env = {**os.environ, "PYTHONPATH": repo, "SPARK_HOME": spark_home(folder)}
    run = subprocess.run([sys.executable, "-c", ON_EXECUTORS, folder, *STORING], cwd=folder, env=env, capture_output=True, text=True, timeout=600)
    ended = [line.split()[2] for line in run.stdout.splitlines() if line.startswith("rows of")]
    assert run.returncode == 0 and ended == list(STORING), run.stderr[-2000:]


def test_stored_tables_without_a_setting(folder):
    """Without spark.checkpoint.dir the tables are stored in the warehouse, where all executors find them."""
    repo = str(Path(__file__).resolve().parents[1])
    env = {**os.environ, "PYTHONPATH": repo, "SPARK_HOME": spark_home(folder)}
    unset = ON_EXECUTORS.replace('"spark.checkpoint.dir": sys.argv[1], ', "")
    run = subprocess.run([sys.executable, "-c", unset, folder, "ev_auc", "fe_quantile"], cwd=folder, env=env, capture_output=True, text=True, timeout=600)
    ended = [line.split()[2] for line in run.stdout.splitlines() if line.startswith("rows of")]
    assert run.returncode == 0 and ended == ["ev_auc", "fe_quantile"], run.stderr[-2000:]
    assert list(Path(folder, "warehouse").glob("lodestone-*/*/*.parquet"))


class Machines:
    """The session as if its executors ran on several machines; of what tasks write for a trial, `lost` rows are not found by the driver."""

    def __init__(self, spark, conf, lost=0, checkpoints=None):
        self.conf, self.read = conf, spark.read
        self.range = lambda start, end, *rest: spark.range(start, end - lost, *rest)
        self.sparkContext = SimpleNamespace(
            master="spark://host:7077", applicationId="app", defaultParallelism=2, getCheckpointDir=lambda: checkpoints,
            _jvm=spark.sparkContext._jvm, _jsc=spark.sparkContext._jsc)


def test_plain_scratch_on_several_machines(spark, folder):
    """A path without a file system is one of fs.defaultFS; a local folder is taken if the driver finds what tasks write there."""
    for number, conf in enumerate(({"spark.checkpoint.dir": folder}, {"spark.sql.warehouse.dir": f"file:{folder}"})):
        assert scratch_path(Machines(spark, conf), "x").startswith(f"file:{folder}/lodestone-app/x-"), number
        with pytest.raises(RuntimeError):
            scratch_path(Machines(spark, conf, lost=1), "x")
    assert scratch_path(Machines(spark, {"spark.sql.warehouse.dir": "/nowhere"}, checkpoints=f"file:{folder}/given"), "x").startswith(f"file:{folder}/given/lodestone-app/x-")
    assert not list(Path(folder).rglob("lodestone-trial-*"))


def test_scratch_is_cleared(spark, t):
    stored(t.nation, "nation")
    clear_scratch(spark)
    assert not Path(scratch_path(spark, "x")).parent.exists()


def test_synonyms_and_topics(spark):
    rows = plans.QUERIES["tx_word2vec"](spark, FOLDER).collect()
    similarities = [r["similarity"] for r in rows]
    assert len(rows) == 20 and similarities == sorted(similarities, reverse=True)
    assert all(-1.0001 <= s <= 1.0001 for s in similarities)
    topics = [sum(row["topics"]) for row in plans.QUERIES["tx_lda"](spark, FOLDER).collect()]
    assert len(topics) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(math.isclose(x, 1.0, abs_tol=1e-6) or x == 0 for x in topics)  # 0 where no word is left


def test_model_summary(spark, t):
    from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression

    rows = plans.models._returns(t)
    tree = models.model_summary(spark, DecisionTreeClassifier(maxDepth=2).fit(rows)).collect()
    assert {"numNodes", "depth", "tree"} <= {r["name"] for r in tree}
    linear = models.model_summary(spark, LogisticRegression(maxIter=2).fit(rows)).collect()
    assert sum(r["name"].startswith("coefficient") for r in linear) == 4


# --- streams ----------------------------------------------------------------------------


@pytest.fixture
def dropped(spark, t, folder):
    """The events in time order as several files, as a stream would receive them."""
    rows = t.events.orderBy("ts").collect()
    size = -(-len(rows) // 4)
    for n in range(4):
        part = spark.createDataFrame(rows[n * size:(n + 1) * size], t.events.schema)
        part.coalesce(1).write.mode("append").parquet(f"{folder}/drop{n}")
    return folder


def stream(spark, t, folder, pattern="drop*"):
    return jobs.read_stream(spark, "parquet", t.events.schema, path=f"{folder}/{pattern}", maxFilesPerTrigger="1")


def test_state_over_several_batches(spark, t, dropped):
    counts = stream(spark, t, dropped).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "many")
    got = {r["event_type"]: r["n"] for r in jobs.running_totals(counts, ["event_type"], "many", path=path).collect()}
    assert got == {r["event_type"]: r["count"] for r in t.events.groupBy("event_type").count().collect()}
    assert serving.all_batches(spark, path, counts.schema).select("batch").distinct().count() == 4


def test_custom_state_over_several_batches(spark, t, dropped):
    from lodestone.functions import columns as fn

    rows = stream(spark, t, dropped).withColumn("at", fn.epoch_micros(F.col("ts")))
    states = jobs.last_value_state(rows, "user_id", "at", "value", F.col("event_id"), 3)
    got = {r["key"]: (r["seen"], r["last"]) for r in jobs.merge_last_values(jobs.running_totals(states, ["key", "salt"], "custom")).collect()}
    want = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("seen"), F.max_by("value", "ts").alias("last")).collect()
    assert got == {r["user_id"]: (r["seen"], r["last"]) for r in want}


def test_per_batch_counts_stay_apart(spark, t, dropped):
    out = jobs.per_batch(stream(spark, t, dropped), lambda b: b.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "apart")
    assert out.select("batch").distinct().count() == 4
    assert out.agg(F.sum("n")).first()[0] == t.events.count()


def test_resume_reads_new_files_once(spark, t, dropped):
    checkpoint, path = scratch_path(spark, "resume"), scratch_path(spark, "resume")
    rows = stream(spark, t, dropped, "drop[01]").select("event_id")
    first = jobs.drain_to_files(rows, checkpoint, path).count()
    more = stream(spark, t, dropped, "drop[01]").select("event_id")
    assert jobs.drain_to_files(more, checkpoint, path).count() == first
    for file in Path(dropped, "drop2").glob("*.parquet"):
        Path(dropped, "drop1", "late-" + file.name).write_bytes(file.read_bytes())
    out = jobs.drain_to_files(stream(spark, t, dropped, "drop[01]").select("event_id"), checkpoint, path)
    assert out.count() == out.distinct().count() > first


def test_late_rows_and_open_windows(spark, t, dropped):
    from lodestone.functions import columns as fn

    rows = stream(spark, t, dropped).withColumn("at", fn.instant(F.col("ts")))
    counts = jobs.windowed_count(rows, "at", ["event_type"], "12 hours", "6 hours", lateness="1 hour")
    out = jobs.drain_to_files(counts, scratch_path(spark, "late"), scratch_path(spark, "late"))
    closed = {(fn_start, kind): n for fn_start, kind, n in (
        (r["s"], r["event_type"], r["n"]) for r in out.select(fn.zoneless(F.col("start")).alias("s"), "event_type", "n").collect())}
    whole = {(r["start"], r["event_type"]): r["n"] for r in plans.QUERIES["st_sliding"](spark, FOLDER).collect()}
    assert 0 < len(closed) < len(whole)
    assert all(whole[key] == n for key, n in closed.items())


# --- plans ------------------------------------------------------------------------------


def explained(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_supply_edges_are_counted_by_numbers(spark, capsys):
    plans.QUERIES["gr_triplets"](spark, FOLDER).explain()
    assert "keys=[l_suppkey" in capsys.readouterr().out


def test_filters_and_columns_reach_the_scan(spark, capsys):
    plan = explained(plans.QUERIES["prj_filter_gt"](spark, FOLDER), capsys)
    assert "GreaterThan(c_acctbal,5000.0)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan


def test_top_k_does_not_sort_everything(spark, capsys):
    assert "TakeOrderedAndProject" in explained(plans.QUERIES["so_topk_count"](spark, FOLDER), capsys)


def test_group_limit_runs_before_the_shuffle(spark, capsys):
    plan = explained(plans.QUERIES["wn_top3_group"](spark, FOLDER), capsys)
    assert plan.count("WindowGroupLimit") >= 2


def test_broadcast_only_below_the_bound(spark, t, capsys):
    orders, customers = t.orders, t.customer
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = orders.join(relational.broadcast_if_small(customers, 10_000), F.col("o_custkey") == F.col("c_custkey"))
        large = orders.join(relational.broadcast_if_small(customers, 10), F.col("o_custkey") == F.col("c_custkey"))
        assert "BroadcastHashJoin" in explained(small, capsys)
        assert "BroadcastHashJoin" not in explained(large, capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
