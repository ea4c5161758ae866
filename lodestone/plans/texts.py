"""Text processing plans over the whole documents."""

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer, StopWordsRemover, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lodestone.operators import ordered, text, topics
from lodestone.plans.registry import query
from lodestone.session import spread, stored

_STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)
_TOKENS = r"""
with d as (select doc_id, source, list_filter(string_split_regex(lower(text), '\W+'), lambda x: x <> '') tokens from documents),
     o as (select doc_id, unnest(range(len(tokens))) pos, unnest(tokens) token from d),
     c as (select token, count(*) n from o group by token),
     k as (select * from o where not regexp_matches(token, '[0-9]') and length(token) >= 2 and token not in (""" + _STOP + """)),
     f as (select * from k where token in (select token from c where n >= 2)),
     tf as (select doc_id, token as term, count(*) tf from f group by 1, 2),
     idf as (select term, ln(((select count(*) from documents) + 1.0) / (count(*) + 1)) idf from tf group by term),
     w as (select doc_id, term, tf, tf * idf weight from tf join idf using (term))"""


def _joined(column):
    return F.md5(F.array_join(column, " "))


def _frequencies(t):
    return text.clean_frequencies(t.documents, "doc_id", "text")


def _weights(t):
    return text.tf_idf(_frequencies(t), t.documents.count())


@query("tx_tokenize_ws", r"""
select item_id, array_to_string(string_split_regex(lower(text), '\s'), '|') tokens from benchmark""")
def tokenize_ws(t):
    return text.whitespace_tokens(t.benchmark, "text", "tokens").select("item_id", F.array_join("tokens", "|").alias("tokens"))


@query("tx_tokenize_regex", _TOKENS + """
select doc_id, len(tokens) n, md5(array_to_string(tokens, ' ')) digest from d""")
def tokenize_regex(t):
    out = text.word_tokens(spread(t.documents.select("doc_id", "text")), "text", "tokens")
    return out.select("doc_id", F.size("tokens").cast("bigint").alias("n"), _joined("tokens").alias("digest"))


@query("tx_no_digits", _TOKENS + "select token, n from c where not regexp_matches(token, '[0-9]')")
def no_digits(t):
    return text.token_counts(text.token_rows(t.documents, "doc_id", "text")).where(text.no_digits(F.col("token")))


@query("tx_token_counts", _TOKENS + "select token, n from c order by n desc, token limit 20")
def token_counts(t):
    return text.token_counts(text.token_rows(t.documents, "doc_id", "text")).orderBy(F.col("n").desc(), "token").limit(20)


@query("tx_stopwords", _TOKENS + f"""
select doc_id, len(list_filter(tokens, lambda x: x not in ({_STOP}))) n,
  md5(array_to_string(list_filter(tokens, lambda x: x not in ({_STOP})), ' ')) digest from d""")
def stopwords(t):
    tokens = text.word_tokens(spread(t.documents.select("doc_id", "text")), "text", "tokens")
    out = StopWordsRemover(inputCol="tokens", outputCol="kept", stopWords=text.STOP_WORDS).transform(tokens)
    return out.select("doc_id", F.size("kept").cast("bigint").alias("n"), _joined("kept").alias("digest"))


@query("tx_rare_tokens", _TOKENS + "select token, n from c where n >= 2 and length(token) >= 2")
def rare_tokens(t):
    return text.common_tokens(text.token_rows(t.documents, "doc_id", "text")).where(F.length("token") >= 2)


@query("tx_clean_docs", _TOKENS + """
select doc_id, count(token) n, md5(coalesce(string_agg(token, ' ' order by pos), '')) digest from documents left join f using (doc_id) group by doc_id""")
def clean_docs(t):
    out = text.clean_documents(t.documents, "doc_id", "text")
    return out.select("doc_id", F.size("tokens").cast("bigint").alias("n"), _joined("tokens").alias("digest"))


@query("tx_vocab_funnel", _TOKENS + """
select 'whitespace' stage, count(distinct token) n from (select unnest(string_split(lower(text), ' ')) token from documents)
union all select 'words', count(*) from c
union all select 'no digits', count(*) from c where not regexp_matches(token, '[0-9]')
union all select 'clean', count(distinct token) from f""")
def vocab_funnel(t):
    spaced = t.documents.select(F.explode(F.split(F.lower("text"), " ")).alias("token")).agg(F.countDistinct("token").alias("n"))
    counts = text.token_counts(text.token_rows(t.documents, "doc_id", "text"))
    token = F.col("token")
    stages = counts.agg(
        F.count(F.lit(1)).alias("words"), F.count_if(text.no_digits(token)).alias("no digits"),
        F.count_if(text.clean_token(token) & (F.col("n") >= 2)).alias("clean"),
    )
    return spaced.select(F.lit("whitespace").alias("stage"), "n").unionByName(stages.unpivot([], stages.columns, "stage", "n"))


@query("tx_ngrams", r"""
with w as (select item_id, string_split_regex(lower(text), '\s') w from benchmark)
select item_id, len(w) - 1 as n, array_to_string(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), '|') grams from w""")
def ngrams(t):
    out = text.ngrams(text.whitespace_tokens(t.benchmark, "text", "tokens"), "tokens", 2, "grams")
    return out.select("item_id", F.size("grams").cast("bigint").alias("n"), F.array_join("grams", "|").alias("grams"))


@query("tx_count_vectorizer", _TOKENS + """
, v as (select term, row_number() over (order by sum(tf) desc, term) - 1 idx from tf group by term having count(*) >= 2)
select doc_id, idx, tf from tf join v using (term) where idx < 1000""")
def count_vectorizer(t):
    tf = stored(_frequencies(t), "frequencies")
    return text.count_cells(tf, "doc_id", text.vocabulary(tf, "doc_id", 1000, least_documents=2))


@query("tx_hashing_tf", _TOKENS + """
select doc_id, (('0x' || substr(md5(token), 1, 8))::ubigint % 262144)::bigint slot, count(*) n from o group by 1, 2""")
def hashing_tf(t):
    """Term counts of every document in 2^18 hashed slots."""
    return text.hashed_counts(text.token_rows(t.documents, "doc_id", "text"), "doc_id", 1 << 18)


@query("tx_tfidf", _TOKENS + "select doc_id, term, tf, round(weight, 6) weight from w")
def tfidf(t):
    return _weights(t).select("doc_id", "term", "tf", F.round("weight", 6).alias("weight"))


@query("tx_tfidf_range", _TOKENS + """
select 'range' as kind, null as term, round(min(weight), 6) low, round(max(weight), 6) high, count(*) n from w
union all select 'term', term, round(min(weight), 6), round(max(weight), 6), count(*) from w where term in ('ouen', 'erst', 'ren') group by term""")
def tfidf_range(t):
    weights = stored(_weights(t), "weights")
    span = [F.round(F.min("weight"), 6).alias("low"), F.round(F.max("weight"), 6).alias("high"), F.count(F.lit(1)).alias("n")]
    words = weights.where(F.col("term").isin("ouen", "erst", "ren")).groupBy("term").agg(*span).withColumn("kind", F.lit("term"))
    whole = weights.agg(*span).withColumns({"kind": F.lit("range"), "term": F.lit(None).cast("string")})
    return whole.unionByName(words)


@query("tx_doc_cosine", _TOKENS + """
, p as (select doc_id a, source, lead(doc_id) over (partition by source order by doc_id) same, lead(doc_id) over (order by doc_id) nxt,
          lead(source) over (order by doc_id) next_source from documents),
  pairs as (select a, same b, 'same source' kind from p where same is not null
            union all select a, nxt, 'other source' from p where nxt is not null and next_source <> source),
  nm as (select doc_id, sqrt(sum(weight * weight)) norm from w group by 1),
  dots as (select a, b, kind, sum(x.weight * y.weight) dot from pairs join w x on x.doc_id = a join w y on y.doc_id = b and y.term = x.term group by 1, 2, 3)
select a, b, pairs.kind, round(coalesce(dot / nullif(n1.norm * n2.norm, 0), 0.0), 6) cosine
from pairs left join dots using (a, b, kind) left join nm n1 on n1.doc_id = a left join nm n2 on n2.doc_id = b""")
def doc_cosine(t):
    """Every document against the next one of its own source, and the next one when its source differs."""
    documents = t.documents.select("doc_id", "source")
    same = ordered.with_neighbours(documents, ["source"], ["doc_id"], {"b": ("doc_id", -1, None)})
    following = ordered.with_neighbours(documents, [], ["doc_id"], {"b": ("doc_id", -1, None), "next_source": ("source", -1, None)})
    pairs = same.where("b is not null").select(F.col("doc_id").alias("a"), "b", F.lit("same source").alias("kind")).unionByName(
        following.where("b is not null and next_source <> source").select(F.col("doc_id").alias("a"), "b", F.lit("other source").alias("kind"))
    )
    weights = stored(_weights(t), "weights")
    return text.pair_cosine(weights, "doc_id", pairs, "a", "b").withColumn("cosine", F.round("cosine", 6))


#: Parts whose vectors are averaged; the result depends on their number, so it is not that of the cores.
_WORD2VEC_PARTS = 8


@query("tx_word2vec")
def word2vec(t):
    """Twenty synonyms of the most frequent token, from vectors trained on all documents."""
    tokens = stored(text.word_tokens(spread(t.documents.select("doc_id", "text")), "text", "tokens").select("doc_id", "tokens"), "tokens")
    counts = text.token_counts(tokens.select(F.explode("tokens").alias("token")))
    word = counts.orderBy(F.col("n").desc(), "token").first()["token"]
    model = Word2Vec(vectorSize=20, seed=7, numPartitions=_WORD2VEC_PARTS, inputCol="tokens", outputCol="v").fit(tokens)
    return model.findSynonyms(word, 20).withColumn("query", F.lit(word))


@query("tx_doc_vectors")
def doc_vectors(t):
    """Mean Word2Vec vector of every document."""
    tokens = stored(text.word_tokens(spread(t.documents.select("doc_id", "text")), "text", "tokens").select("doc_id", "tokens"), "tokens")
    model = Word2Vec(vectorSize=20, seed=7, numPartitions=_WORD2VEC_PARTS, inputCol="tokens", outputCol="v").fit(tokens)
    return model.transform(tokens).select("doc_id", vector_to_array("v").alias("v"))


@query("tx_lda")
def lda(t):
    """Topic weights of every document under five topics; zeros for a document of which cleaning leaves no word."""
    tokens = stored(text.clean_documents(t.documents, "doc_id", "text"), "clean")
    counts = CountVectorizer(inputCol="tokens", outputCol="features", minDF=2.0).fit(tokens).transform(tokens)
    model = LDA(k=5, maxIter=5, seed=7, optimizer="online").fit(counts)
    return model.transform(counts).select("doc_id", vector_to_array("topicDistribution").alias("topics"))


_TOPICS, _VOCABULARY, _TOPIC_STEPS = 5, 300, 8


def _topic_model(t, batches=1):
    """Topics over the 300 most frequent clean words; (topic weights, perplexities, vocabulary)."""
    tokens = text.token_rows(t.documents, "doc_id", "text").where(text.clean_token(F.col("token")))
    tf = stored(text.term_frequencies(tokens, "doc_id"), "tf")
    words = stored(text.vocabulary(tf, "doc_id", _VOCABULARY, least_documents=2), "words")
    docs = topics.documents(tf, "doc_id", words)
    return *topics.fit(docs, words.count(), _TOPICS, _TOPIC_STEPS, batches), words


@query("tx_topic_terms")
def topic_terms(t):
    """The ten heaviest terms of every topic."""
    weights, _, words = _topic_model(t)
    rows = topics.topic_terms(weights, words)
    return ordered.top_per_group(rows, ["topic"], [F.col("weight").desc(), F.col("term")], 10, "place").select("topic", "place", "term", F.round("weight", 6).alias("weight"))


@query("tx_topic_mass", f"""
with x as (select doc_id, unnest(list_filter(string_split_regex(lower(text), '\\W+'), lambda w: w <> '')) token from documents),
     c as (select * from x where not regexp_matches(token, '[0-9]') and length(token) >= 2 and token not in ({', '.join(f"'{w}'" for w in text.STOP_WORDS)}))
select token as term, count(*)::double as mass from c group by 1 having count(distinct doc_id) >= 2 order by count(*) desc, token limit {_VOCABULARY}""")
def topic_mass(t):
    """Expected counts of every term over all topics: what the topics share out is what the documents hold."""
    weights, _, words = _topic_model(t)
    mass = (weights - 1 / _TOPICS).sum(axis=0)
    rows = t.spark.createDataFrame([(i, float(x)) for i, x in enumerate(mass)], "idx bigint, mass double")
    return rows.join(words, "idx").select("term", F.round("mass", 3).alias("mass"))


@query("tx_topic_perplexity")
def topic_perplexity(t):
    """Perplexity before every step, over all documents and over four hash-chosen batches in turn."""
    rows = [(n, step, x) for n in (1, 4) for step, x in enumerate(_topic_model(t, n)[1])]
    return t.spark.createDataFrame(rows, "batches int, step int, perplexity double").withColumn("perplexity", F.round("perplexity", 4))


@query("tx_group_counts", "select source, count(*) n from documents group by source")
def group_counts(t):
    return t.documents.groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "source")
