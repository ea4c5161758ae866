"""Round trips of readers and writers, each in a fresh folder."""

import json
from pathlib import Path

import pytest
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from lodestone.operators import features as fe
from lodestone.sources import readers, schemas, serving, writers

ORDERS = StructType([
    StructField("o_orderkey", LongType()), StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType()),
])


@pytest.fixture
def orders(spark):
    return spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(*ORDERS.fieldNames())


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).isEmpty()


def test_text_lines_and_overwrite(spark, folder):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lines = documents.select(F.regexp_replace("text", "\n", " ").alias("value"))
    writers.to_text(lines.limit(3), f"{folder}/t")
    writers.to_text(lines, f"{folder}/t")
    assert readers.text_lines(spark, f"{folder}/t").count() == lines.count()


@pytest.mark.parametrize("separator", [",", "\t", "|", " "])
def test_delimited(spark, folder, orders, separator):
    writers.to_delimited(orders, f"{folder}/d", separator)
    assert same(readers.delimited(spark, f"{folder}/d", separator, ORDERS), orders)


def test_multi_character_separator(spark, folder, orders):
    writers.to_multichar_text(orders, f"{folder}/d", "::")
    assert same(readers.delimited(spark, f"{folder}/d", "::", ORDERS), orders)


def test_ratings_lines(spark, folder):
    Path(folder, "ratings.dat").write_text("1::1193::5::978300760\n1::661::3::978302109\n")
    schema = StructType([StructField(n, LongType()) for n in ("user", "item", "rating", "at")])
    rows = readers.delimited(spark, f"{folder}/ratings.dat", "::", schema).orderBy("item").collect()
    assert [tuple(r) for r in rows] == [(1, 661, 3, 978302109), (1, 1193, 5, 978300760)]


def test_headed_csv_casts_and_nulls(spark, folder):
    Path(folder, "a.csv").write_text("o_orderkey,o_orderstatus,o_totalprice\n1,F,2.5\nx,O,\n")
    rows = readers.headed_csv(spark, f"{folder}/a.csv", ORDERS).collect()
    assert [tuple(r) for r in rows] == [(1, "F", 2.5), (None, "O", None)]


def test_json(spark, folder, orders):
    writers.to_json(orders, f"{folder}/j")
    assert same(readers.json_lines(spark, f"{folder}/j").select(*ORDERS.fieldNames()), orders)
    assert same(readers.json_lines(spark, f"{folder}/j", ORDERS), orders)


def test_people_json_inferred(spark, folder):
    people = [{"name": "Michael"}, {"name": "Andy", "age": 30}, {"name": "Justin", "age": 19}]
    Path(folder, "people.json").write_text("\n".join(json.dumps(p) for p in people))
    df = readers.json_lines(spark, f"{folder}/people.json")
    assert [r["name"] for r in df.where(F.col("age").between(13, 19)).collect()] == ["Justin"]
    assert df.where("age is null").count() == 1


def test_parquet_partitioned(spark, folder, orders):
    writers.to_parquet(orders, f"{folder}/p", "o_orderstatus")
    assert same(spark.read.parquet(f"{folder}/p").select(*ORDERS.fieldNames()), orders)


def test_whole_files_with_parent_label(spark, folder):
    for group, name, text in (("a.b", "1", "x\ny"), ("a.b", "2", "z"), ("c", "1", "w")):
        Path(folder, group).mkdir(exist_ok=True)
        Path(folder, group, name).write_text(text)
    rows = readers.whole_files(spark, folder).select("label", "content").collect()
    assert sorted(tuple(r) for r in rows) == [("a.b", "x\ny"), ("a.b", "z"), ("c", "w")]


def test_libsvm(spark, folder):
    Path(folder, "s.txt").write_text("1 1:0.5 3:2\n0 2:1\n")
    rows = readers.libsvm(spark, f"{folder}/s.txt", 3).collect()
    assert [(r["label"], r["features"].toArray().tolist()) for r in rows] == [(1.0, [0.5, 0.0, 2.0]), (0.0, [0.0, 1.0, 0.0])]


def test_labelled_points_both_forms(spark, folder):
    Path(folder, "p.txt").write_text("1,0.5 2\n(0.0,[1.0,3.0])\n")
    rows = readers.labelled_points(spark, f"{folder}/p.txt").collect()
    assert [(r["label"], r["features"].toArray().tolist()) for r in rows] == [(1.0, [0.5, 2.0]), (0.0, [1.0, 3.0])]


def test_managed_table_and_insert(spark, orders):
    writers.to_table(orders, "orders_copy")
    writers.to_table(orders, "orders_copy")
    assert spark.table("orders_copy").count() == orders.count()
    writers.create_table(spark, "orders_load", ORDERS)
    writers.load_into(orders, "orders_load")
    writers.load_into(orders, "orders_load")
    assert spark.table("orders_load").count() == 2 * orders.count()
    spark.sql("DROP TABLE orders_copy")
    spark.sql("DROP TABLE orders_load")


def test_jdbc_sink_overwrites(spark, orders):
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    url = "jdbc:derby:memory:reports;create=true"
    small = orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    writers.to_jdbc(small, url, "status_report", **options)
    writers.to_jdbc(small, url, "status_report", **options)
    assert same(readers.jdbc(spark, url, "status_report", **options).toDF("o_orderstatus", "n"), small)


def test_single_file(spark, folder, orders):
    writers.to_single_file(orders.select(F.col("o_orderstatus").alias("value")).repartition(5), f"{folder}/one")
    assert len(list(Path(folder, "one").glob("part-*"))) == 1


def test_tag_and_count_by_file(spark, folder):
    Path(folder, "leagues_1980_a.csv").write_text("1,x\n2,y\n")
    Path(folder, "leagues_1981_a.csv").write_text("3,z\n")
    tagged = readers.tagged_by_file(spark, f"{folder}/leagues_*", r"leagues_(\d{4})", "year")
    assert sorted(tuple(r) for r in tagged.collect()) == [("1980", "1,x"), ("1980", "2,y"), ("1981", "3,z")]
    counts = readers.count_per_file(spark, folder)
    assert sorted((r["file"], r["n"]) for r in counts.collect()) == [("leagues_1980_a.csv", 2), ("leagues_1981_a.csv", 1)]
    for name in ("a", "b"):
        Path(folder, name).mkdir()
        Path(folder, name, "part-0.txt").write_text("1\n2\n")
    Path(folder, "b", "part-1.txt").write_text("")
    counts = readers.count_per_file(spark, [f"{folder}/a", f"{folder}/b"])
    assert sorted((r["file"], r["n"]) for r in counts.collect()) == [("part-0.txt", 2), ("part-0.txt", 2), ("part-1.txt", 0)]


def test_append_and_increment(spark, folder):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    serving.append(spark, f"{folder}/all", rows, 1)
    assert serving.append(spark, f"{folder}/all", rows, 2).count() == 4
    assert serving.append(spark, f"{folder}/all", rows, 2).count() == 4
    serving.increment(spark, f"{folder}/sums", rows, 1, ["k"])
    assert sorted(tuple(r) for r in serving.increment(spark, f"{folder}/sums", rows, 2, ["k"]).collect()) == [("a", 2), ("b", 4)]


def test_wide_text_to_parquet_prunes_and_pushes_down(spark, folder, capsys):
    leading = ["country", "city"]
    schema = schemas.wide_schema(leading, 329)
    assert len(schema) == 2 + 3 * 329
    line = "|".join(["US", "X"] + ["Y", "7", "true"] * 329)
    other = "|".join(["wE", "Z"] + ["N", "3", "false"] * 329)
    Path(folder, "wide.txt").write_text(line + "\n" + other + "\n")
    writers.wide_text_to_parquet(spark, f"{folder}/wide.txt", f"{folder}/wide", "|", schema)
    df = spark.read.parquet(f"{folder}/wide").where("country not like 'w%' and number7 > 5 and bool9").groupBy("city").count()
    assert [tuple(r) for r in df.collect()] == [("X", 1)]
    df.explain("formatted")
    plan = capsys.readouterr().out
    read = next(x for x in plan.splitlines() if x.startswith("ReadSchema"))
    assert read.count(":") == 5 and "GreaterThan(number7,5)" in plan  # the label's colon and four columns


def test_keyed_upsert_is_idempotent(spark, folder):
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    second = spark.createDataFrame([("b", 5), ("c", 9)], "k string, n int")
    serving.upsert(spark, folder, first, 0, ["k"])
    serving.upsert(spark, folder, second, 1, ["k"])
    rows = serving.upsert(spark, folder, second, 1, ["k"])
    assert sorted(tuple(r) for r in rows.collect()) == [("a", 1), ("b", 5), ("c", 9)]
    serving.compact(spark, folder, f"{folder}-compact", first.schema, ["k"])
    compacted = serving.newest(spark, f"{folder}-compact", first.schema, ["k"])
    assert sorted(tuple(r) for r in compacted.collect()) == [("a", 1), ("b", 5), ("c", 9)]


def test_model_round_trip(spark, folder):
    labels = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"), fe.vector("l_quantity", "l_tax").alias("features")
    )
    model = LogisticRegression(maxIter=3).fit(labels)
    model.write().overwrite().save(f"{folder}/model")
    assert LogisticRegressionModel.load(f"{folder}/model").coefficients == model.coefficients
