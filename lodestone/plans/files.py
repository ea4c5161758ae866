"""Round trips through files: what a source reads back must be what was written."""

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import functions as F

from lodestone.operators import features as fe
from lodestone.plans.registry import query
from lodestone.session import scratch_path
from lodestone.sources import readers, schemas, serving, writers

_ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
_ORDERS_SQL = f"select {', '.join(_ORDER)} from orders"


def _orders(t):
    return t.orders.select(*_ORDER)


@query("src_text_lines", """
with l as (select unnest(string_split(text, chr(10))) as line from documents) select md5(line) digest, count(*) n from l group by 1""")
def text_lines(t):
    path = scratch_path(t.spark, "lines")
    writers.to_text(t.documents.select(F.col("text").alias("value")), path)
    return readers.text_lines(t.spark, path).groupBy(F.md5("value").alias("digest")).agg(F.count(F.lit(1)).alias("n"))


@query("src_delimited", _ORDERS_SQL)
def delimited(t):
    """A separator of two characters."""
    path, rows = scratch_path(t.spark, "delimited"), _orders(t)
    writers.to_multichar_text(rows, path, "::")
    return readers.delimited(t.spark, path, "::", rows.schema)


@query("src_csv_header", _ORDERS_SQL)
def csv_header(t):
    path, rows = scratch_path(t.spark, "headed"), _orders(t)
    writers.to_delimited(rows, path, ",", header=True)
    return readers.headed_csv(t.spark, path, rows.schema)


@query("src_json", _ORDERS_SQL)
def json(t):
    path = scratch_path(t.spark, "json")
    writers.to_json(_orders(t), path)
    return readers.json_lines(t.spark, path).select(*_ORDER)


@query("src_parquet_roundtrip", _ORDERS_SQL)
def parquet(t):
    """One folder per status; the column comes back from the folder names."""
    path = scratch_path(t.spark, "parquet")
    writers.to_parquet(_orders(t), path, "o_orderstatus")
    return t.spark.read.parquet(path).select(*_ORDER)


@query("src_libsvm", "select l_linenumber::double as label, l_quantity::double q, l_discount::double d, count(*) n from lineitem group by 1, 2, 3")
def libsvm(t):
    path = scratch_path(t.spark, "libsvm")
    line = F.concat_ws(" ", F.col("l_linenumber").cast("double"), F.concat(F.lit("1:"), "l_quantity"), F.concat(F.lit("2:"), "l_discount"))
    writers.to_text(t.lineitem.select(line.alias("value")), path)
    x = vector_to_array("features")
    return readers.libsvm(t.spark, path, 2).groupBy("label", x[0].alias("q"), x[1].alias("d")).agg(F.count(F.lit(1)).alias("n"))


@query("src_labeled_points", "select l_linenumber::double as label, l_quantity::double q, l_discount::double d, count(*) n from lineitem group by 1, 2, 3")
def labeled_points(t):
    path = scratch_path(t.spark, "points")
    line = F.concat(F.col("l_linenumber").cast("double"), F.lit(","), F.concat_ws(" ", "l_quantity", "l_discount"))
    writers.to_text(t.lineitem.select(line.alias("value")), path)
    x = vector_to_array("features")
    return readers.labelled_points(t.spark, path).groupBy("label", x[0].alias("q"), x[1].alias("d")).agg(F.count(F.lit(1)).alias("n"))


@query("src_count_per_file", "select o_orderstatus as status, count(*) n from orders group by 1")
def count_per_file(t):
    """Files of one folder per status, all with names that another folder may have too."""
    path = scratch_path(t.spark, "counted")
    t.orders.select("o_orderstatus", F.col("o_orderkey").cast("string").alias("value")).write.partitionBy("o_orderstatus").text(path)
    counts = readers.count_per_file(t.spark, path)
    return counts.groupBy(F.regexp_extract("path", "o_orderstatus=([^/]*)", 1).alias("status")).agg(F.sum("n").alias("n"))


@query("src_keyed_upsert", "select o_custkey, max(o_orderkey) as last from orders group by 1")
def keyed_upsert(t):
    """The newest order of every customer, from three batches of orders; each batch replaces the rows of its customers."""
    path, shown = scratch_path(t.spark, "upsert"), None
    bound = t.orders.agg(F.max("o_orderkey")).first()[0]
    for k in range(3):
        part = t.orders.where((F.col("o_orderkey") * 3 > bound * k) & (F.col("o_orderkey") * 3 <= bound * (k + 1)))
        shown = serving.upsert(t.spark, path, part.groupBy("o_custkey").agg(F.max("o_orderkey").alias("last")), k, ["o_custkey"])
    return shown


@query("src_keyed_append", "select o_custkey, count(*) n from orders group by 1")
def keyed_append(t):
    path, shown = scratch_path(t.spark, "append"), None
    for k in range(3):
        shown = serving.append(t.spark, path, t.orders.where(F.col("o_orderkey") % 3 == k).select("o_custkey", "o_orderkey"), k)
    return shown.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("src_keyed_increment", "select o_custkey, count(*) n from orders group by 1")
def keyed_increment(t):
    path, shown = scratch_path(t.spark, "increment"), None
    for k in range(3):
        rows = t.orders.where(F.col("o_orderkey") % 3 == k).select("o_custkey", F.lit(1).cast("bigint").alias("n"))
        shown = serving.increment(t.spark, path, rows, k, ["o_custkey"])
    return shown


@query("src_whole_files", "select 'o_orderpriority=' || substr(o_orderpriority, 1, 1) as label, count(*) n, sum(o_orderkey)::bigint as keys from orders group by 1")
def whole_files(t):
    """Many files in a folder per priority, each read whole; the label is the folder's name."""
    path = scratch_path(t.spark, "whole")
    rows = t.orders.select(F.substring("o_orderpriority", 1, 1).alias("o_orderpriority"), F.col("o_orderkey").cast("string").alias("value"))
    rows.repartition(16, "value").write.partitionBy("o_orderpriority").option("maxRecordsPerFile", 500).text(path)
    files = readers.whole_files(t.spark, path)
    lines = files.select("label", F.explode(F.split(F.rtrim("content", F.lit("\n")), "\n")).alias("key"))
    return lines.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("key").cast("bigint")).alias("keys"))


@query("src_saved_table", "select o_orderstatus, count(*) n, round(sum(o_totalprice)::double, 2) as price from orders where o_orderstatus <> 'P' group by 1")
def saved_table(t):
    """A table that is dropped and created again holds the second content only."""
    name, path = f"saved_{uuid.uuid4().hex}", scratch_path(t.spark, "saved")
    writers.to_table(_orders(t), name, path)
    writers.to_table(_orders(t).where("o_orderstatus <> 'P'"), name, path)
    summary = t.spark.table(name).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("o_totalprice").cast("double")), 2).alias("price"))
    summary.write.parquet(shown := scratch_path(t.spark, "saved-summary"))
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.read.parquet(shown)


@query("src_insert_into", "select o_orderkey, 2::bigint as n from orders")
def insert_into(t):
    """Rows loaded twice into one table are there twice."""
    name, path = f"loaded_{uuid.uuid4().hex}", scratch_path(t.spark, "loaded")
    rows = _orders(t)
    writers.create_table(t.spark, name, rows.schema, path)
    writers.load_into(rows, name)
    writers.load_into(rows, name)
    t.spark.sql(f"DROP TABLE {name}")  # its files stay
    return t.spark.read.schema(rows.schema).parquet(path).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("src_text_overwrite", "select o_orderkey::varchar as value from orders where o_orderstatus = 'F'")
def text_overwrite(t):
    """Text written to a folder twice: the second output replaces the first."""
    path = scratch_path(t.spark, "overwritten")
    lines = t.orders.select(F.col("o_orderkey").cast("string").alias("value"), "o_orderstatus")
    writers.to_text(lines.select("value"), path)
    writers.to_text(lines.where("o_orderstatus = 'F'").select("value"), path)
    return readers.text_lines(t.spark, path)


@query("src_single_file", "select 1::bigint as files, o_orderpriority || ' ' || count(*) as value from orders group by o_orderpriority")
def single_file(t):
    """A small report in one file."""
    path = scratch_path(t.spark, "single")
    report = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    writers.to_single_file(report.select(F.concat_ws(" ", "o_orderpriority", "n").alias("value")), path)
    lines = t.spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    files = lines.agg(F.countDistinct("file").alias("files"))  # one row
    return lines.join(F.broadcast(files)).select("files", "value")


@query("src_year_files", "select year(o_orderdate)::varchar as year, count(*) n, sum(o_orderkey)::bigint as keys from orders group by 1")
def year_files(t):
    """A folder of files per year, read together by a pattern; every row is tagged with the year in its path."""
    path = scratch_path(t.spark, "years")
    rows = t.orders.select(F.year("o_orderdate").alias("year"), F.col("o_orderkey").cast("string").alias("value"))
    for year in sorted(r["year"] for r in rows.select("year").distinct().collect()):  # a folder for each year
        writers.to_text(rows.where(F.col("year") == year).select("value"), f"{path}/orders_{year}")
    tagged = readers.tagged_by_file(t.spark, f"{path}/orders_*", r"/orders_(\d{4})/", "year", folder=True)
    return tagged.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("bigint")).alias("keys"))


@query("src_wide_to_parquet", """
select c_mktsegment as segment, count(*) n from customer where c_nationkey > 5 and c_acctbal > 0 group by 1""")
def wide_to_parquet(t):
    """Text of about 1,000 columns under a generated schema, kept as Parquet, of which a report reads three columns."""
    groups, text, path = 329, scratch_path(t.spark, "wide-text"), scratch_path(t.spark, "wide")
    triple = F.concat_ws("|", F.substring("c_mktsegment", 1, 1), F.col("c_nationkey").cast("string"), (F.col("c_acctbal") > 0).cast("string"))
    line = F.concat_ws("|", "c_mktsegment", F.col("c_custkey").cast("string"), *[triple] * groups)
    writers.to_text(t.customer.select(line.alias("value")), text)
    writers.wide_text_to_parquet(t.spark, text, path, "|", schemas.wide_schema(["segment", "customer"], groups))
    return t.spark.read.parquet(path).where("number7 > 5 AND bool9").groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


@query("src_model_roundtrip", """
select l_orderkey, l_linenumber, l_partkey, round(slope * l_quantity + intercept, 2) prediction
from lineitem, (select regr_slope(l_extendedprice, l_quantity) slope, regr_intercept(l_extendedprice, l_quantity) intercept from lineitem)""")
def model_roundtrip(t):
    """Predictions of a model that was saved and loaded again."""
    path = scratch_path(t.spark, "model")
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    rows = t.lineitem.select(*keys, F.col("l_extendedprice").alias("label"), fe.vector("l_quantity").alias("features"))
    LinearRegression(solver="normal").fit(rows).write().overwrite().save(path)
    return LinearRegressionModel.load(path).transform(rows).select(*keys, F.round("prediction", 2).alias("prediction"))
