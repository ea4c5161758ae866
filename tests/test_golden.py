"""Small literal inputs with results worked out by hand."""

import math

import pytest
from pyspark.ml.feature import (
    Binarizer, Bucketizer, ElementwiseProduct, IndexToString, StringIndexer, VectorAssembler, VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lodestone import plans
from lodestone.functions import columns as fn
from lodestone.functions import udfs
from lodestone.operators import features as fe
from lodestone.operators import ordered, profile, relational, seasons, text, weblog

SCORES = [("k", 1, 41), ("l", 1, 63), ("m", 1, 12), ("n", 2, 88), ("o", 2, 35), ("p", 3, 70), ("q", 3, 70), ("r", 3, 9), ("s", 3, 64), ("t", 3, 23)]


@pytest.fixture(params=["2000000", "0"], ids=["plain", "sliced"])
def route(request, spark):
    spark.conf.set("spark.lodestone.maxGroupRows", request.param)
    yield request.param
    spark.conf.unset("spark.lodestone.maxGroupRows")


@pytest.fixture
def scores(spark):
    return spark.createDataFrame(SCORES, "name string, class int, score int")


def test_rank_one_keeps_ties(scores, route):
    ranked = ordered.with_rank(scores, ["class"], "score", "r", descending=True)
    assert {r["name"] for r in ranked.where("r = 1").collect()} == {"l", "n", "p", "q"}


def test_dense_rank(scores, route):
    ranked = {r["name"]: r["r"] for r in ordered.with_rank(scores, ["class"], "score", "r", descending=True, dense=True).collect()}
    assert [ranked[n] for n in "pqstr"] == [1, 1, 2, 3, 4]


def test_running_and_neighbours_with_null_keys(spark, route):
    rows = [(None, 1, 5.0), (None, 2, None), (None, 3, 1.0), ("x", 1, 2.0)]
    df = spark.createDataFrame(rows, "k string, at int, v double")
    run = ordered.with_running(df, ["k"], ["at"], {"s": ("sum", F.col("v")), "m": ("min", F.col("v")), "n": ("count", F.lit(1))})
    got = sorted((r["k"] or "", r["at"], r["s"], r["m"], r["n"]) for r in run.collect())
    assert got == [("", 1, 5.0, 5.0, 1), ("", 2, 5.0, 5.0, 2), ("", 3, 6.0, 1.0, 3), ("x", 1, 2.0, 2.0, 1)]
    near = ordered.with_neighbours(df, ["k"], ["at"], {"p": ("v", 1, -1.0), "q": ("v", -1, None)})
    got = sorted((r["k"] or "", r["at"], r["p"], r["q"]) for r in near.collect())
    assert got == [("", 1, -1.0, None), ("", 2, 5.0, 1.0), ("", 3, None, None), ("x", 1, -1.0, None)]


@pytest.mark.parametrize("values, want", [([3.0, 1.0, 2.0], 2.0), ([4.0, 1.0, 3.0, 2.0], 2.5), ([7.0, 7.0, 7.0, 1.0], 7.0)])
def test_median(spark, route, values, want):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert ordered.exact_median(df, [], "x", "m").first()["m"] == want


def test_mode_keeps_ties(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 2, 3, 3)], "x int")
    assert sorted(r["x"] for r in profile.mode(df, "x").collect()) == [2, 3]


def test_valid_and_reject(spark):
    df = spark.createDataFrame([(x,) for x in "12 x7 -4 9q 30 8- 11".split()], "x string")
    valid, rejected = relational.split_valid(df, "x", r"^-?\d+$")
    assert valid.agg(F.sum(F.col("x").cast("int"))).first()[0] == 49
    assert {r["x"] for r in rejected.collect()} == {"x7", "9q", "8-"}


def test_value_histogram(spark):
    df = spark.createDataFrame([(x,) for x in "qwqzzq"], "x string")
    assert {r["x"]: r["count"] for r in df.groupBy("x").count().collect()} == {"q": 3, "w": 1, "z": 2}


def test_partition_rule(spark):
    df = spark.createDataFrame([(x,) for x in "p.7 q.7 r.1 s.9 t.4".split()], "x string")
    placed = relational.by_key_rule(df, relational.last_digit_rule(F.col("x"), 5), 5)
    assert {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()} == {2: 2, 1: 1, 4: 2}
    assert placed.rdd.getNumPartitions() == 5
    tasks = placed.select("part", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(tasks) == 3  # each rule value lies in one partition


def test_repartition_and_cache_leave_rows(scores):
    for way in (scores.repartition(7), scores.coalesce(1), scores.persist()):
        assert sorted(map(tuple, way.collect())) == sorted(SCORES)
    scores.unpersist()


def vectors(spark, rows):
    return spark.createDataFrame([(Vectors.dense(r),) for r in rows], ["x"])


def arrays(df, column):
    return [list(r[0]) for r in df.select(vector_to_array(column)).collect()]


def test_binarizer_and_bucketizer(spark):
    df = spark.createDataFrame([(0.1,), (0.8,), (0.2,)], "x double")
    assert [r["y"] for r in Binarizer(threshold=0.5, inputCol="x", outputCol="y").transform(df).collect()] == [0.0, 1.0, 0.0]
    df = spark.createDataFrame([(-0.5,), (-0.3,), (0.0,), (0.2,)], "x double")
    stage = Bucketizer(splits=[-math.inf, -0.5, 0.0, 0.5, math.inf], inputCol="x", outputCol="y")
    assert [r["y"] for r in stage.transform(df).collect()] == [1.0, 1.0, 2.0, 2.0]


def test_quantile_buckets(spark, route):
    df = spark.createDataFrame([(x,) for x in (18.0, 19.0, 8.0, 5.0, 2.2)], "hour double")
    got = {r["hour"]: r["b"] for r in fe.quantile_buckets(df, "hour", 3, "b").collect()}
    assert got == {18.0: 2.0, 19.0: 2.0, 8.0: 1.0, 5.0: 1.0, 2.2: 0.0}


def test_quantile_buckets_leave_missing_values_out(spark, route):
    df = spark.createDataFrame([(None,)] * 4 + [(float("nan"),)] + [(float(x),) for x in (1, 2, 3, 4)], "x double")
    assert fe.quantile_splits(df, "x", 2) == [2.0]
    assert fe.quantile_splits(df.where("x IS NULL"), "x", 2) == []


def test_address_is_checked_by_value(spark):
    lines = ["10.0.0.7 - x", "at 300.1.1.1 y", "1.2.3.4.5", "v1.22.33.255.", ""]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert [r[0] for r in df.select(weblog.ip_of(F.col("value"))).collect()] == ["10.0.0.7", "", "", "1.22.33.255", ""]


def test_video_audience_of_many_users(spark, folder):
    """Users past 65,535 have addresses of their own; a line without a valid address adds none."""
    users = [0, 255, 256, 65_535, 65_536, 65_537, 70_000, 1_000_000, None]
    rows = [(i, u, "view", 1.0, '{"k": %d}' % k) for i, u in enumerate(users) for k in (7, 8) if k == 7 or u != 0]
    events = spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, value double, props string")
    events.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp")).write.parquet(f"{folder}/events.parquet")
    assert [tuple(r) for r in plans.QUERIES["rp_video_ips"](spark, folder).collect()] == [("7.mp4", 8), ("8.mp4", 7)]
    top = plans.QUERIES["rp_ip_top"](spark, folder).collect()
    assert {r["n_ips"] for r in top} == {8}
    assert {"192.168.255.255", "192.169.0.0", "192.169.17.112"} <= {r["ip"] for r in top}
    lines = spark.createDataFrame([("1.2.3.4 /5.mp4 ",), ("1.2.3.400 /5.mp4 ",), ("1.2.3.400 /6.mp4 ",)], "value string")
    assert [tuple(r) for r in weblog.video_audience(lines, 10).collect()] == [("5.mp4", 1), ("6.mp4", 0)]


def test_clean_documents_keep_every_document(spark):
    df = spark.createDataFrame([(1, "apple pear apple"), (2, "the 12"), (3, None), (4, ""), (5, "pear once")], "k int, t string")
    assert {r["k"]: r["tokens"] for r in text.clean_documents(df, "k", "t").collect()} == {1: ["apple", "pear", "apple"], 2: [], 3: [], 4: [], 5: ["pear"]}


def test_pairs_without_terms_have_cosine_zero(spark):
    weights = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0)], "k int, term string, weight double")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "x int, y int")
    assert {(r["x"], r["y"]): r["cosine"] for r in text.pair_cosine(weights, "k", pairs, "x", "y").collect()} == {(1, 2): 1.0, (1, 3): 0.0}


def test_string_indexer_skips_unseen(spark):
    df = spark.createDataFrame([(x,) for x in "abcaac"], "x string")
    model = StringIndexer(inputCol="x", outputCol="i", handleInvalid="skip").fit(df)
    out = model.transform(df)
    assert {r["x"]: r["i"] for r in out.collect()} == {"a": 0.0, "c": 1.0, "b": 2.0}
    back = IndexToString(inputCol="i", outputCol="y").transform(out)
    assert all(r["x"] == r["y"] for r in back.collect())
    assert model.transform(spark.createDataFrame([("a",), ("d",)], "x string")).count() == 1


def test_hadamard_assembler_slicer(spark):
    stage = ElementwiseProduct(scalingVec=Vectors.dense([0.0, 1.0, 2.0]), inputCol="x", outputCol="y")
    assert arrays(stage.transform(vectors(spark, [[1, 2, 3], [4, 5, 6]])), "y") == [[0.0, 2.0, 6.0], [0.0, 5.0, 12.0]]
    df = spark.createDataFrame([(18, 1.0, Vectors.dense([0.0, 10.0, 0.5]))], ["hour", "mobile", "user"])
    assert arrays(VectorAssembler(inputCols=["hour", "mobile", "user"], outputCol="f").transform(df), "f") == [[18.0, 1.0, 0.0, 10.0, 0.5]]
    assert arrays(VectorSlicer(inputCol="x", outputCol="y", indices=[1, 2]).transform(vectors(spark, [[-2.0, 2.3, 0.0]])), "y") == [[2.3, 0.0]]


def test_sql_transformer(spark):
    df = spark.createDataFrame([(5, 4.0, 0.5), (6, 1.5, 2.0)], "id int, v1 double, v2 double")
    out = udfs.sql_transform(df, "SELECT *, (v1 + v2) AS v3, (v1 * v2) AS v4 FROM __THIS__")
    assert [(r["v3"], r["v4"]) for r in out.orderBy("id").collect()] == [(4.5, 2.0), (3.5, 3.0)]


def test_chi_square_top_two(spark):
    rows = [(0.0, 0.0, 18.0, 1.0, 1.0), (0.0, 1.0, 12.0, 0.0, 0.0), (1.0, 0.0, 15.0, 0.1, 0.0)]
    df = spark.createDataFrame(rows, "f0 double, f1 double, f2 double, f3 double, label double")
    top = fe.top_features(fe.chi_square(df, "label", ["f0", "f1", "f2", "f3"]), 2)
    assert [r["feature"] for r in top.collect()] == ["f2", "f3"]


def test_count_vectors_and_ngrams(spark):
    df = spark.createDataFrame([(0, ["a", "b", "c"]), (1, ["a", "b", "b", "c", "a"])], "id int, w array<string>")
    out = text.count_vectors(df, "w", "v", ["a", "b", "c"])
    assert arrays(out, "v") == [[1.0, 1.0, 1.0], [2.0, 2.0, 1.0]]
    df = spark.createDataFrame([(["Hi", "I", "heard", "about", "Spark"],), (["one"],)], "w array<string>")
    assert [r["g"] for r in text.ngrams(df, "w", 2, "g").collect()] == [["Hi I", "I heard", "heard about", "about Spark"], []]


def test_weighted_z_score(spark):
    df = spark.createDataFrame([(1, 7.1), (1, 1.9)], "year int, x double")
    out = seasons.season_scores(df, "year", [seasons.Stat("x")])
    assert sorted(round(r["z_x"], 6) for r in out.collect()) == [-1.0, 1.0]
    assert round((7.1 - 4.5) / 1.3, 6) == 2.0


def test_constant_season_gives_null(spark):
    df = spark.createDataFrame([(1, 3.0), (1, 3.0)], "year int, x double")
    assert [r["z_x"] for r in seasons.season_scores(df, "year", [seasons.Stat("x")]).collect()] == [None, None]


def test_stat_counter_counts_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (1, float("nan")), (1, 3.0)], "k int, x double")
    row = profile.stat_counter(df, ["k"], ["x"]).first()
    assert (row["x_count"], row["x_avg"], row["x_stdev"], row["x_missing"]) == (2, 2.0, 1.0, 1)


def test_blank_field_is_zero(spark):
    df = spark.createDataFrame([("",), ("  ",), (None,), ("7",)], "x string")
    assert [r[0] for r in df.select(fn.blank_to_zero(F.col("x"))).collect()] == ["0", "0", "0", "7"]


def test_after_marker(spark):
    df = spark.createDataFrame([("a >>> b ",), ("plain",)], "x string")
    assert [r[0] for r in df.select(fn.after_marker(F.col("x"), ">>>")).collect()] == ["b", "plain"]


def test_udaf_skips_nulls_and_empty_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None)], "k string, x double")
    assert {r["k"]: r["m"] for r in udfs.aggregate(df, ["k"], "x", "m").collect()} == {"a": 2.0, "b": None}


def test_epoch_does_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.123456' AS ts")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(fn.epoch_micros(F.col("ts")).alias("u"), fn.from_epoch_micros(fn.epoch_micros(F.col("ts"))) == F.col("ts")).first()
        assert (row[0], row[1]) == (1710037800123456, True)
        assert df.select(fn.zoneless(fn.instant(F.col("ts"))) == F.col("ts")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_chunked_lists_keep_every_value(spark, route):
    df = spark.createDataFrame([("hot", i) for i in range(25)] + [("cold", 1)], "k string, v int")
    out = ordered.chunked_lists(df, ["k"], ["v"], F.col("v"), 10, "vs")
    got = sorted((r["k"], r["chunk"], r["vs"]) for r in out.collect())
    assert got == [("cold", 0, [1]), ("hot", 0, list(range(10))), ("hot", 1, list(range(10, 20))), ("hot", 2, list(range(20, 25)))]
