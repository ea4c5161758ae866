"""Scalar function plans."""

from pyspark.sql import functions as F

from lodestone.functions import columns as fn
from lodestone.plans.registry import query


@query("fn_split", r"""
select doc_id, len(string_split(text, ' ')) n_space, len(string_split_regex(text, '\W+')) n_regex,
       len(string_split(text, chr(10))) n_lines from documents""")
def split(t):
    def size(pattern):
        return F.size(F.split("text", pattern)).cast("bigint")

    return t.documents.select("doc_id", size(" ").alias("n_space"), size(r"\W+").alias("n_regex"), size("\n").alias("n_lines"))


@query("fn_explode", """
select item_id, unnest(range(len(w))) pos, unnest(w) word from (select item_id, string_split(text, ' ') w from benchmark)""")
def explode(t):
    words = t.benchmark.select("item_id", F.posexplode(F.split("text", " ")).alias("pos", "word"))
    return words.withColumn("pos", F.col("pos").cast("bigint"))


@query("fn_string_clean", r"""
select doc_id, lower(trim(source)) source, length(text) n, replace(lang, 'e', '"') lang,
       length(regexp_replace(text, '[^a-zA-Z]+', ' ', 'g')) n_clean from documents""")
def string_clean(t):
    return t.documents.select(
        "doc_id", F.lower(F.trim("source")).alias("source"), F.length("text").cast("bigint").alias("n"),
        F.replace("lang", F.lit("e"), F.lit('"')).alias("lang"),
        F.length(F.regexp_replace("text", "[^a-zA-Z]+", " ")).cast("bigint").alias("n_clean"),
    )


@query("fn_regex_extract", r"""
select page_id, regexp_extract(url, '^(https?)://([^/]+)/([a-z]+)/([0-9]+)', 1) scheme,
       regexp_extract(url, '^(https?)://([^/]+)/([a-z]+)/([0-9]+)', 2) host,
       regexp_extract(url, '^(https?)://([^/]+)/([a-z]+)/([0-9]+)', 4) num from pages""")
def regex_extract(t):
    pattern = "^(https?)://([^/]+)/([a-z]+)/([0-9]+)"
    return t.pages.select(
        "page_id", *[F.regexp_extract("url", pattern, i).alias(n) for i, n in ((1, "scheme"), (2, "host"), (4, "num"))]
    )


@query("fn_substring", "select c_custkey, substring(c_name, 1, 4) head, right(c_name, 1) last from customer")
def substring(t):
    return t.customer.select("c_custkey", F.substring("c_name", 1, 4).alias("head"), F.right("c_name", F.lit(1)).alias("last"))


@query("fn_after_marker", """
select page_id, case when contains(url, '?') then trim(string_split(url, '?')[2]) else url end as rest from pages""")
def after_marker(t):
    return t.pages.select("page_id", fn.after_marker(F.col("url"), "?").alias("rest"))


@query("fn_prefix", """
select event_id, 'id:' || user_id as tagged, epoch_us(ts) // 1000 || ',' || event_type as stamped from events""")
def prefix(t):
    millis = F.floor(fn.epoch_micros(F.col("ts")) / 1000).cast("bigint")
    return t.events.select(
        "event_id", F.concat(F.lit("id:"), "user_id").alias("tagged"), F.concat_ws(",", millis, "event_type").alias("stamped")
    )


@query("fn_epoch_format", """
select event_id, epoch_us(ts) // 1000 as millis, strftime(ts, '%Y-%m-%d %H') as hour from events""")
def epoch_format(t):
    millis = t.events.select("event_id", F.floor(fn.epoch_micros(F.col("ts")) / 1000).cast("bigint").alias("millis"))
    return millis.withColumn("hour", F.date_format(fn.from_epoch_micros(F.col("millis") * 1000), "yyyy-MM-dd HH"))


@query("fn_date_dim", """
select distinct strftime(o_orderdate, '%Y-%m-%d') dateid, year(o_orderdate) as year, month(o_orderdate) as month, day(o_orderdate) as day,
  dayofweek(o_orderdate) weekday, weekofyear(o_orderdate) as week, quarter(o_orderdate) as quarter,
  case when day(o_orderdate) <= 10 then 1 when day(o_orderdate) <= 20 then 2 else 3 end::bigint period,
  case when day(o_orderdate) <= 15 then 1 else 2 end::bigint halfmonth from orders""")
def date_dim(t):
    dates = t.orders.select("o_orderdate").distinct()
    parts = [value.alias(name) for name, value in fn.calendar(F.col("o_orderdate")).items()]
    return dates.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("dateid"), *parts)


@query("fn_math", """
select l_orderkey, l_linenumber, l_partkey, cast(l_quantity as bigint) % 7 m, cast(ceil(l_extendedprice / 1000) as bigint) c,
  round(abs(l_discount - 0.05), 6) a, greatest(l_discount, l_tax) g, round(sqrt(l_quantity), 6) s, round(pow(l_quantity, 1.5), 4) p,
  round(exp(-l_quantity), 8) e from lineitem""")
def math(t):
    q = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", (q.cast("bigint") % 7).alias("m"), F.ceil(F.col("l_extendedprice") / 1000).alias("c"),
        F.round(F.abs(F.col("l_discount") - 0.05), 6).alias("a"), F.greatest("l_discount", "l_tax").alias("g"),
        F.round(F.sqrt(q), 6).alias("s"), F.round(F.pow(q, F.lit(1.5)), 4).alias("p"), F.round(F.exp(-q), 8).alias("e"),
    )


@query("fn_sigmoid_score", """
select l_orderkey, l_linenumber, l_partkey,
  round(1 / (1 + exp(-(-0.5 + l_quantity * 0.02 + l_discount * -3.0 + l_tax * 1.5))), 8) score from lineitem""")
def sigmoid_score(t):
    score = fn.sigmoid_score([F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")], [0.02, -3.0, 1.5], -0.5)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(score, 8).alias("score"))


@query("fn_json", """
select event_id, cast(json_extract_string(props, '$.k') as bigint) k, json_extract_string(props, '$.k') k_text from events""")
def json(t):
    return t.events.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"), F.get_json_object("props", "$.k").alias("k_text"))


@query("fn_format", """
select o_orderkey, printf('%.6f', o_totalprice) six, printf('%1.2f', o_totalprice / 7) two from orders""")
def format_number(t):
    return t.orders.select(
        "o_orderkey", F.format_string("%.6f", "o_totalprice").alias("six"),
        F.format_string("%1.2f", F.col("o_totalprice") / 7).alias("two"),
    )


@query("fn_cast", """
select o_orderkey, cast(left(o_orderpriority, 1) as integer) as level, try_cast(o_orderpriority as integer) as bad,
  o_orderstatus = 'F' as done, cast(cast(o_totalprice as varchar) as double) price from orders""")
def cast(t):
    return t.orders.select(
        "o_orderkey", F.left("o_orderpriority", F.lit(1)).cast("int").alias("level"), F.col("o_orderpriority").try_cast("int").alias("bad"),
        (F.col("o_orderstatus") == "F").alias("done"), F.col("o_totalprice").cast("string").cast("double").alias("price"),
    )


@query("fn_array", """
select vec_id, len(embedding) n, list_contains([1, 3, 5], label) odd, list_transform(embedding[1:3], lambda x: cast(x as double)) first3,
  label || ':' || label || ':' || label as labels, cast(embedding[5] as double) + label as zipped from embeddings""")
def array(t):
    zipped = F.arrays_zip(F.col("embedding").alias("x"), F.array_repeat("label", F.size("embedding")).alias("y"))
    fifth = F.element_at(zipped, 5)
    return t.embeddings.select(
        "vec_id", F.size("embedding").cast("bigint").alias("n"), F.array_contains(F.array(F.lit(1), F.lit(3), F.lit(5)), F.col("label")).alias("odd"),
        fn.doubles(F.slice("embedding", 1, 3)).alias("first3"),
        F.array_join(F.array_repeat(F.col("label").cast("string"), 3), ":").alias("labels"),
        (fifth.getField("x").cast("double") + fifth.getField("y")).alias("zipped"),
    )


@query("fn_vector", """
with v as (select vec_id, list_transform(embedding, lambda x: x::double) a, list_transform(list_reverse(embedding), lambda x: x::double) b
           from embeddings)
select vec_id, round(list_dot_product(a, b), 6) dot, round(sqrt(list_dot_product(a, a)), 6) l2, round(list_distance(a, b) ** 2, 6) dist2,
  list_transform(list_zip(a, b), lambda p: round(p[1] * p[2], 6) + 0.0) product from v""")
def vector(t):
    rows = t.embeddings.select("vec_id", fn.doubles(F.col("embedding")).alias("a"), fn.doubles(F.reverse("embedding")).alias("b"))
    a, b = F.col("a"), F.col("b")
    return rows.select(
        "vec_id", F.round(fn.dot(a, b), 6).alias("dot"), F.round(fn.norm(a), 6).alias("l2"),
        F.round(fn.squared_distance(a, b), 6).alias("dist2"), fn.rounded(fn.hadamard(a, b), 6).alias("product"),
    )


@query("fn_cosine", """
with v as (select vec_id, list_transform(embedding, lambda x: x::double) a from embeddings)
select p.vec_id, round(list_cosine_similarity(p.a, q.a), 6) + 0.0 similarity from v p join v q on q.vec_id = p.vec_id + 1""")
def cosine(t):
    rows = t.embeddings.select("vec_id", fn.doubles(F.col("embedding")).alias("a"))
    following = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"))
    return rows.join(following, "vec_id").select("vec_id", (F.round(fn.cosine(F.col("a"), F.col("b")), 6) + 0.0).alias("similarity"))


# Names of the order priorities.
PRIORITY_NAMES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "5-LOW": "low"}


@query("fn_map_lookup", """
select o_orderkey, case o_orderpriority when '1-URGENT' then 'urgent' when '2-HIGH' then 'high' when '3-MEDIUM' then 'medium'
  when '5-LOW' then 'low' end as priority from orders""")
def map_lookup(t):
    return t.orders.select("o_orderkey", fn.lookup_literal(F.col("o_orderpriority"), PRIORITY_NAMES).alias("priority"))


@query("fn_flags_to_names", """
select l_orderkey, l_linenumber, l_partkey, array_to_string(list_filter([
  case when l_returnflag = 'R' then 'returned' end, case when l_linestatus = 'O' then 'open' end,
  case when l_discount > 0 then 'discounted' end, case when l_tax = 0 then 'untaxed' end], lambda x: x is not null), '|') as names from lineitem""")
def flags_to_names(t):
    flags = F.array(F.col("l_returnflag") == "R", F.col("l_linestatus") == "O", F.col("l_discount") > 0, F.col("l_tax") == 0)
    names = fn.flags_to_names(flags, ["returned", "open", "discounted", "untaxed"])
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(names, "|").alias("names"))


@query("fn_array_approx_equal", """
with v as (select vec_id, list_transform(embedding, lambda x: x::double) a from embeddings)
select p.vec_id, len(list_filter(list_zip(p.a, q.a), lambda z: abs(abs(z[1]) - abs(z[2])) > 0.3)) = 0 as same
from v p join v q on q.vec_id = p.vec_id + 1""")
def array_approx_equal(t):
    rows = t.embeddings.select("vec_id", fn.doubles(F.col("embedding")).alias("a"))
    following = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"))
    return rows.join(following, "vec_id").select("vec_id", fn.equal_up_to_sign(F.col("a"), F.col("b"), 0.3).alias("same"))
