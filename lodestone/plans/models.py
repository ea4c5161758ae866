"""Model plans: the label is whether a line item was returned, unless stated otherwise."""

from pyspark.ml.classification import (
    DecisionTreeClassifier, LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import CountVectorizerModel, Interaction, OneHotEncoder
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lodestone.functions import columns as fn
from lodestone.operators import features as fe
from lodestone.operators import metrics, models, ordered, recommend, relational, text
from lodestone.plans.registry import query
from lodestone.session import spread, stored

LINE = ["l_orderkey", "l_linenumber", "l_partkey"]


def _returns(t):
    label = F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    features = fe.vector("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    # Every iteration reads all rows: use all cores even when the table is one file.
    return spread(t.lineitem.select(*LINE, label.alias("label"), features.alias("features")))


def _predicted(model, rows):
    return model.transform(rows).select(*LINE, "label", "prediction")


@query("ml_logreg")
def logreg(t):
    rows = _returns(t)
    model = LogisticRegression(maxIter=10, regParam=0.01, elasticNetParam=0.5).fit(rows)
    scored = model.transform(rows)
    return scored.select(*LINE, "label", "prediction", F.round(vector_to_array("probability")[1], 6).alias("probability"))


@query("ml_svm")
def svm(t):
    rows = _returns(t)
    return _predicted(LinearSVC(maxIter=10, regParam=0.1).fit(rows), rows)


@query("ml_decision_tree")
def decision_tree(t):
    rows = _returns(t)
    return _predicted(DecisionTreeClassifier(maxDepth=5, maxBins=32, impurity="gini", seed=7).fit(rows), rows)


@query("ml_random_forest")
def random_forest(t):
    rows = _returns(t)
    return _predicted(RandomForestClassifier(numTrees=10, maxDepth=4, seed=7).fit(rows), rows)


@query("ml_naive_bayes", """
with b as (select p_brand, row_number() over (order by p_brand) - 1 slot from part group by 1),
     x as (select p_type, slot, p_size::double v from part join b using (p_brand)),
     c as (select k.p_type, b.slot, coalesce(sum(v), 0) v from (select distinct p_type from part) k join b on true
           left join x on x.p_type = k.p_type and x.slot = b.slot group by 1, 2),
     n as (select p_type, count(*) n from part group by 1)
select p_type, slot, round(ln((n + 0.5) / (sum(n) over (partition by slot) + 0.5 * count(*) over (partition by slot))), 6) pi,
  round(ln((v + 0.5) / (sum(v) over (partition by p_type) + 0.5 * count(*) over (partition by p_type))), 6) theta
from c join n using (p_type)""")
def naive_bayes(t):
    """Class priors and likelihoods of a multinomial model: part type from its size in its brand's slot."""
    brands = fe.dictionary(t.part, "p_brand", "slot")
    slots = brands.count()
    slot_vector = OneHotEncoder(inputCol="slot", outputCol="hot", dropLast=False)
    types = [row["p_type"] for row in fe.dictionary(t.part, "p_type").orderBy("idx").collect()]  # the classes
    label = F.array_position(F.array(*[F.lit(x) for x in types]), F.col("p_type")) - 1
    sized = stored(t.part.join(brands, "p_brand").select(label.cast("double").alias("label"), "slot", F.col("p_size").cast("double").alias("size")), "sized")
    # a sparse vector holds one slot, times the size
    rows = Interaction(inputCols=["size", "hot"], outputCol="features").transform(slot_vector.fit(sized).transform(sized))
    model = NaiveBayes(modelType="multinomial", smoothing=0.5).fit(rows)
    table = [
        (types[k], j, float(model.pi[k]), float(model.theta[k, j])) for k in range(len(types)) for j in range(slots)
    ]
    out = t.spark.createDataFrame(table, "p_type string, slot bigint, pi double, theta double")
    return out.select("p_type", "slot", F.round("pi", 6).alias("pi"), F.round("theta", 6).alias("theta"))


@query("ml_linreg", """
select l_orderkey, l_linenumber, l_partkey, round(slope * l_quantity + intercept, 2) prediction
from lineitem, (select regr_slope(l_extendedprice, l_quantity) slope, regr_intercept(l_extendedprice, l_quantity) intercept from lineitem)""")
def linreg(t):
    rows = t.lineitem.select(*LINE, F.col("l_extendedprice").alias("label"), fe.vector("l_quantity").alias("features"))
    model = LinearRegression(solver="normal").fit(rows)
    return model.transform(rows).select(*LINE, F.round("prediction", 2).alias("prediction"))


def _vectors(t):
    return t.embeddings.select("vec_id", "label", fn.doubles(F.col("embedding")).alias("x"))


@query("ml_kmeans")
def kmeans(t):
    rows = _vectors(t).select("vec_id", array_to_vector("x").alias("features"))
    model = KMeans(k=10, maxIter=10, seed=7, initMode="random").fit(rows)
    return model.transform(rows).select("vec_id", F.col("prediction").alias("cluster"))


@query("ml_cluster_report", """
with v as (select vec_id, label, list_transform(embedding, lambda x: x::double) x from embeddings),
     u as (select label, unnest(range(len(x))) slot, unnest(x) x from v),
     c as (select label, list(m order by slot) centre from (select label, slot, avg(x) m from u group by 1, 2) group by 1),
     d as (select label, vec_id, round(list_distance(x, centre) ** 2, 6) distance from v join c using (label))
select label, vec_id, distance, row_number() over (partition by label order by distance, vec_id) place from d qualify place <= 20""")
def cluster_report(t):
    rows = _vectors(t)
    return models.cluster_report(rows, "vec_id", "x", "label", models.mean_vectors(rows, "x", "label", "centre"), "centre", 20)


@query("ml_kmeans_sweep")
def kmeans_sweep(t):
    rows = _vectors(t).select("vec_id", array_to_vector("x").alias("features"))
    parts = relational.random_split(rows, ["vec_id"], {"train": 0.6, "test": 0.4}, seed=123)
    train, test = parts.where("part = 'train'"), parts.where("part = 'test'")
    return models.kmeans_sweep(train, test, "features", [2, 3, 4, 5, 10, 20], seed=7)


@query("ml_als_topn")
def als_topn(t):
    """Ten best parts of every customer by factors."""
    ratings, users, items = _ratings(t)
    model = ALS(rank=10, maxIter=5, regParam=0.1, seed=7, coldStartStrategy="drop").fit(ratings)
    rows = recommend.best_items(model.userFactors, model.itemFactors, "id", "features", 10).withColumn("rating", F.col("score").cast("float"))
    return rows.join(users, "user").join(items, "item").select(F.col("o_custkey").alias("user"), F.col("place").cast("int"), F.col("l_partkey").alias("item"), "rating")


def _ratings(t):
    """Mean quantities per (customer, part) with dense numbers for both, and the two dictionaries."""
    bought = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey", "l_partkey").agg(F.avg("l_quantity").alias("rating"))
    bought = stored(bought, "bought")
    users = stored(fe.dictionary(bought, "o_custkey", "user"), "users")
    items = stored(fe.dictionary(bought, "l_partkey", "item"), "items")
    rows = bought.join(users, "o_custkey").join(items, "l_partkey")
    return stored(rows.select("o_custkey", "l_partkey", F.col("user").cast("int"), F.col("item").cast("int"), "rating"), "ratings"), users, items


def _als_errors(t, points):
    """(rank, reg, validation, test, baseline): errors of every point, and of the mean rating, on rows held out."""
    ratings, _, _ = _ratings(t)
    parts = stored(relational.random_split(ratings, ["o_custkey", "l_partkey"], {"train": 0.6, "validation": 0.2, "test": 0.2}, seed=42), "parts")
    train = parts.where("part = 'train'")
    mean = train.agg(F.avg("rating")).first()[0]
    rmse = lambda e: F.sqrt(F.avg(e * e))
    out = None
    for rank, reg in points:
        scored = ALS(rank=rank, maxIter=5, regParam=reg, seed=7).fit(train).transform(parts.where("part <> 'train'"))
        # a user or item without training rows has no factors and takes the mean
        error = F.col("rating") - F.coalesce(F.nanvl(F.col("prediction").cast("double"), F.lit(mean)), F.lit(mean))
        row = scored.agg(
            F.lit(rank).alias("rank"), F.lit(reg).alias("reg"), rmse(F.when(F.col("part") == "validation", error)).alias("validation"),
            rmse(F.when(F.col("part") == "test", error)).alias("test"), rmse(F.when(F.col("part") == "test", F.col("rating") - mean)).alias("baseline"))
        out = row if out is None else out.unionByName(row)
    return out


@query("ml_als_rmse")
def als_rmse(t):
    """Error of one factorization on rows held out, and the improvement on the mean rating in percent."""
    errors = _als_errors(t, [(10, 0.1)])
    return errors.withColumn("improvement", (F.col("baseline") - F.col("test")) / F.col("baseline") * 100)


@query("ml_als_grid")
def als_grid(t):
    """Errors over rank and regularisation; the best is the one with the least error on the validation rows."""
    errors = stored(_als_errors(t, [(r, l) for r in (4, 10) for l in (0.1, 1.0)]), "errors")
    least = errors.agg(F.min("validation").alias("least"))  # one row
    return errors.join(F.broadcast(least)).withColumn("best", F.col("validation") == F.col("least")).drop("least")


@query("ml_kmeans_cost")
def kmeans_cost(t):
    """Sum of squared distances to the fitted centres, and the members nearest to each."""
    rows = stored(_vectors(t).select("vec_id", "x", array_to_vector("x").alias("features")), "rows")
    model = KMeans(k=10, maxIter=10, seed=7, initMode="random").fit(rows)
    centres = t.spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster int, centre array<double>")
    members = model.transform(rows).select("vec_id", "x", F.col("prediction").alias("cluster"))
    best = models.cluster_report(members, "vec_id", "x", "cluster", F.broadcast(centres), "centre", 10)  # k rows
    return best.withColumn("cost", F.lit(float(model.summary.trainingCost)))


@query("ml_text_classify", """
with s as (select doc_id, source, md5(doc_id::varchar) < 'b' train from documents),
  x as (select doc_id, list_filter(string_split_regex(lower(text), '\\W+'), lambda w: w <> '') ws from documents),
  o as (select doc_id, unnest(ws) token from x),
  v as (select 'raw' variant, doc_id, token, count(*) tf from o group by 2, 3
        union all select 'clean', doc_id, token, count(*) from o where not regexp_matches(token, '[0-9]') and length(token) >= 2 and token not in (STOP) group by 2, 3),
  i as (select variant, token, ln(((select count(*) from documents where md5(doc_id::varchar) < 'b') + 1.0) / (count(*) + 1)) idf
        from v join s using (doc_id) where train group by 1, 2),
  w as (select variant, doc_id, token, tf * idf x from v join i using (variant, token)),
  c as (select variant, source, token, sum(x) x from w join s using (doc_id) where train group by 1, 2, 3),
  size as (select variant, count(distinct token) n from i group by 1),
  tot as (select variant, source, sum(x) x from c group by 1, 2),
  prior as (select source, ln(count(*)) p from s where train group by 1),
  base as (select variant, source, p, ln(x + 0.1 * n) z, n from tot join size using (variant) join prior using (source)),
  score as (select w.variant, w.doc_id, c.source, sum(w.x * (ln(c.x + 0.1) - ln(0.1))) hit from w join s on s.doc_id = w.doc_id and not train
            join c on c.variant = w.variant and c.token = w.token group by 1, 2, 3),
  mass as (select variant, doc_id, sum(x) m from w group by 1, 2),
  every as (select b.variant, s.doc_id, s.source actual, b.source, round(p + coalesce(m, 0) * (ln(0.1) - z) + coalesce(hit, 0), 6) score
            from s join base b on not train left join mass m on m.variant = b.variant and m.doc_id = s.doc_id
            left join score h on h.variant = b.variant and h.doc_id = s.doc_id and h.source = b.source),
  pick as (select variant, doc_id, actual, source predicted from every qualify row_number() over (partition by variant, doc_id order by score desc, source) = 1)
select variant, actual, predicted, count(*) n from pick group by 1, 2, 3""".replace("STOP", ", ".join(f"'{w}'" for w in text.STOP_WORDS)))
def text_classify(t):
    """Confusion cells of multinomial naive Bayes over TF-IDF weights, documents to source, on raw and on cleaned tokens."""
    train = F.md5(F.col("doc_id").cast("string")) < "b"
    labels = t.documents.select("doc_id", F.col("source").alias("actual"), train.alias("train"))
    tf = stored(text.term_frequencies(text.token_rows(t.documents, "doc_id", "text"), "doc_id"), "tf")
    out = None
    for variant, rows in (("raw", tf), ("clean", tf.where(text.clean_token(F.col("term"))))):
        cells = text.classified(rows, labels, "doc_id", smoothing=0.1).groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
        cells = cells.select(F.lit(variant).alias("variant"), "actual", "predicted", "n")
        out = cells if out is None else out.unionByName(cells)
    return out


@query("ml_grid_search")
def grid_search(t):
    rows = stored(_returns(t).select("label", "features"), "rows")
    estimator = LogisticRegression(maxIter=5)
    return models.grid_search(estimator, {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5]}, rows, "label", 0.6, 123)


@query("ml_fpgrowth", """
with b as (select distinct l_orderkey o, p_brand i from lineitem join part on l_partkey = p_partkey),
     k as (select ceil(0.01 * count(distinct o)) least from b)
select i as items, count(*) freq from b group by 1 having count(*) >= (select least from k)
union all select x.i || ',' || y.i, count(*) from b x join b y on x.o = y.o and x.i < y.i group by 1 having count(*) >= (select least from k)
union all select x.i || ',' || y.i || ',' || z.i, count(*) from b x join b y on x.o = y.o and x.i < y.i join b z on z.o = x.o and y.i < z.i
  group by 1 having count(*) >= (select least from k)""")
def fpgrowth(t):
    """Brand sets bought together; an order's list holds distinct brands, so it is never longer than the brand dictionary."""
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    baskets = stored(lines.groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("items")), "baskets")
    sets = FPGrowth(itemsCol="items", minSupport=0.01).fit(baskets).freqItemsets
    return sets.select(F.array_join(F.array_sort("items"), ",").alias("items"), "freq")


@query("ml_ctr_weights")
def ctr_weights(t):
    """One weight per brand: whether an order is finished, from the multi-hot set of its brands."""
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("o_orderkey"), "p_brand")
    words = fe.dictionary(t.part, "p_brand")
    names = [row["p_brand"] for row in words.orderBy("idx").collect()]  # the dictionary, as long as the weights
    brands = lines.groupBy("o_orderkey").agg(F.collect_set("p_brand").alias("brands"))  # never longer than the dictionary
    label = F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)
    orders = t.orders.join(brands, "o_orderkey").select(label.alias("label"), "brands")
    rows = stored(CountVectorizerModel.from_vocabulary(names, inputCol="brands", outputCol="features", binary=True).transform(orders).select("label", "features"), "rows")
    model = LogisticRegression(maxIter=10, regParam=0.01).fit(rows)
    return models.weight_table(t.spark, model.coefficients, words, "p_brand").withColumnRenamed("p_brand", "feature")


@query("ml_single_auc", """
with x as (unpivot (select (l_returnflag = 'R')::int as label, cast(l_linenumber as varchar) l_linenumber, l_linestatus,
      cast(cast(round(l_discount * 100) as bigint) as varchar) discount, cast(cast(round(l_tax * 100) as bigint) as varchar) tax from lineitem)
    on l_linenumber, l_linestatus, discount, tax into name feature value value),
  g as (select feature, value, count(*) filter (where label = 1) p, count(*) filter (where label = 0) n from x group by 1, 2),
  s as (select feature, p / (p + n) rate, sum(p) p, sum(n) n from g group by 1, 2),
  r as (select feature, p, n, sum(n) over (partition by feature order by rate) - n below from s)
select feature, round(sum(p * (below + n / 2)) / (sum(p) * sum(n)), 6) auc from r group by feature""")
def single_auc(t):
    """Area under ROC of each feature by itself, scored by the positive rate of its values; one pass over the rows."""
    rows = t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_linenumber").cast("string").alias("l_linenumber"), "l_linestatus",
        F.round(F.col("l_discount") * 100).cast("bigint").cast("string").alias("discount"),
        F.round(F.col("l_tax") * 100).cast("bigint").cast("string").alias("tax"),
    )
    return models.single_feature_auc(rows, "label", ["l_linenumber", "l_linestatus", "discount", "tax"]).withColumn("auc", F.round("auc", 6))


@query("ml_baseline_rmse", """
with p as (select l_quantity q, avg(l_quantity) over () base, avg(l_quantity) over (partition by l_partkey) m from lineitem)
select round(sqrt(avg((q - base) ** 2)), 6) baseline, round(sqrt(avg((q - m) ** 2)), 6) model,
  round((sqrt(avg((q - base) ** 2)) - sqrt(avg((q - m) ** 2))) / sqrt(avg((q - base) ** 2)) * 100, 4) improvement from p""")
def baseline_rmse(t):
    rows = ordered.with_group_values(t.lineitem.select("l_partkey", "l_quantity"), ["l_partkey"], m=F.avg("l_quantity"))
    rows = ordered.with_group_values(rows, [], base=F.avg("l_quantity"))
    q = F.col("l_quantity")
    baseline = F.sqrt(F.avg((q - F.col("base")) * (q - F.col("base"))))
    model = F.sqrt(F.avg((q - F.col("m")) * (q - F.col("m"))))
    return rows.agg(
        F.round(baseline, 6).alias("baseline"), F.round(model, 6).alias("model"), F.round((baseline - model) / baseline * 100, 4).alias("improvement")
    )


@query("rp_model_compare")
def model_compare(t):
    """Accuracy, ROC and PR area of four models on the same rows."""
    rows = stored(_returns(t).select("label", "features"), "rows")
    fitted = {
        "logistic regression": LogisticRegression(maxIter=10).fit(rows),
        "linear svm": LinearSVC(maxIter=10, regParam=0.01).fit(rows),
        "naive bayes": NaiveBayes().fit(rows),
        "decision tree": DecisionTreeClassifier(maxDepth=5, impurity="entropy", seed=7).fit(rows),
    }
    return models.binary_report(fitted, rows, "label")


@query("rp_fraud_report")
def fraud_report(t):
    """Split, balance by class weights, fit, and evaluate on both parts."""
    parts = relational.random_split(_returns(t), LINE, {"train": 0.7, "test": 0.3}, seed=12345)
    train, test = parts.where("part = 'train'"), parts.where("part = 'test'")
    train = stored(fe.class_weight(train.select("label", "features"), "label", "weight"), "train")
    model = LogisticRegression(maxIter=10, weightCol="weight").fit(train)
    out = None
    for name, part in (("train", train), ("test", test)):
        cells = metrics.confusion(model.transform(part), "label", "prediction")
        report = metrics.class_report(cells).select(F.lit(name).alias("part"), "label", "actual", "precision", "recall", "f1", "weighted_f1")
        out = report if out is None else out.unionByName(report)
    return out
