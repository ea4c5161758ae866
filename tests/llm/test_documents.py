"""Near-duplicates, repeated strings, main text, toxicity and the pipeline against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestone.llm import components, html, jaccard, queries, suffix_index, toxicity

FOLDER = "/root/testdata/sf0.001"


def shingles(text, n=5):
    words = (text or "").lower().split()
    n = min(n, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def classes(rows, threshold=0.8):
    """(class, links) of each row by comparing all rows."""
    sets = [shingles(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= threshold * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        least.setdefault(find(a), []).append(i)
    return [(min(least[find(a)], key=lambda x: (x is not None, x)), links[a]) for a in range(len(rows))]


def near_copies(n, words=60, seed=1):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for i in range(n):
        copy = list(base)
        for _ in range(rng.randrange(0, 3)):
            copy[rng.randrange(words)] = f"new{i}"
        out.append(" ".join(copy))
    return out


def check_classes(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(df, "doc_id", "text").collect())
    assert got == Counter((i, c, n) for (i, _), (c, n) in zip(rows, classes(rows)))


def test_classes_and_links(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"r{rng.randrange(9999)}" for _ in range(rng.randrange(1, 50)))) for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate(near_copies(60) + near_copies(20, seed=5))]
    rows += [(300, rows[0][1]), (301, rows[0][1].upper()), (302, None), (303, ""), (304, "one two"), (305, "one  Two"), (None, "three four"), (306, "three four"), (302, None)]
    check_classes(spark, rows)


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    check_classes(spark, [(i, t) for i, t in enumerate(near_copies(90))])


def test_prefix_is_shortened_to_the_recall():
    lengths = [jaccard.prefix_length(0.8, r) for r in (0.9, 0.999, 0.99999)]
    assert lengths == sorted(lengths, reverse=True)
    for length, recall in zip(lengths, (0.9, 0.999, 0.99999)):
        assert 1 - (1 - 0.8**length) ** jaccard.TREES >= recall


def test_near_duplicates_odd_rows(odd):
    got = jaccard.near_duplicates(odd, "doc_id", "text")
    assert got.count() == odd.count()
    assert {r["doc_id"]: r["class_id"] for r in got.collect()}[5] == 4
    left = jaccard.without_near_duplicates(odd, "doc_id", "text")
    assert left.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "2", "2", "3", "4", "6", "7", "None", "None"]
    assert jaccard.near_duplicates(odd.limit(0), "doc_id", "text").count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    root = list(range(500))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["u"]: r["v"] for r in components.labelled(spark.createDataFrame(edges, "u int, v int")).collect()}
    assert got == {x: find(x) for e in edges for x in e if find(x) != x}
    assert components.labelled(spark.createDataFrame([], "u int, v int")).count() == 0


def cut(texts, length):
    seen = Counter(d[i:i + length] for d in texts for i in range(len(d) - length + 1))
    out = []
    for d in texts:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((bytes(b for b, g in zip(d, gone) if not g), sum(gone), spans))
    return out


def repeated_texts():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdéñ漢 ") for _ in range(rng.randrange(1, 9)))
    passage = " ".join(word() for _ in range(150))
    other = " ".join(word() for _ in range(120))
    texts = [" ".join(word() for _ in range(rng.randrange(5, 250))) for _ in range(25)]
    texts += [a + passage + b for a, b in zip(texts[:9], texts[9:18])]  # all borders differ
    texts += [texts[0], texts[0], texts[3] + other + texts[4] + other, passage[:399], passage[:400], passage[1:402], "ab" * 900, "x" * 1000, "x" * 399, "", other[50:480]]
    texts += [passage[k:k + 410 + k] + word() for k in range(0, 60, 7)]
    return texts


def test_repeated_strings_against_brute_force(spark):
    texts = repeated_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = cut([t.encode() for t in texts], 400)
    got = {r["doc_id"]: (bytes(r["kept"]), r["n_removed"], r["n_spans"]) for r in suffix_index.deduplicated(df, "doc_id", "text").collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_repeated_strings_by_shuffled_joins(spark, monkeypatch):
    """What is too large to be broadcast takes shuffled joins, with the same result; repeated rows cut each other."""
    monkeypatch.setattr(suffix_index, "sized", lambda df, row_bytes, most=0: df)
    monkeypatch.setattr(suffix_index, "sized_lists", lambda df, values, most=0: df)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = repeated_texts()
        rows = [*enumerate(texts), (0, texts[0]), (0, texts[0]), (None, texts[9]), (None, None)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
        want = cut([(t or "").encode() for _, t in rows], 400)
        got = Counter((r["doc_id"], bytes(r["kept"]), r["n_removed"], r["n_spans"]) for r in suffix_index.deduplicated(df, "doc_id", "text").collect())
        assert got == Counter((i, *w) for (i, _), w in zip(rows, want))
        near = [(i, t) for i, t in enumerate(near_copies(40) + near_copies(20, seed=5))] + [(3, near_copies(40)[3])] * 3
        frame = spark.createDataFrame(near, "doc_id long, text string")
        found = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(frame, "doc_id", "text", broadcast_bytes=0).collect())
        assert found == Counter((i, c, n) for (i, _), (c, n) in zip(near, classes(near)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_kept_text_has_no_broken_characters(spark):
    passage = "é" * 300 + "漢字" * 100
    texts = ["x" + passage + "é tail", "yy" + passage + "ñ other", "漢" + passage[300:] + "\U0001F600 end \ufffd"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [b.decode("utf-8", "ignore") for b, _, _ in cut([t.encode() for t in texts], 400)]
    assert any(b.decode("utf-8", "replace") != w for (b, _, _), w in zip(cut([t.encode() for t in texts], 400), want))
    got = {r["doc_id"]: r["kept"] for r in suffix_index.deduplicated(df, "doc_id", "text", as_text=True).collect()}
    assert [got[i] for i in range(3)] == want


def test_other_length_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_index, "CHUNK", 700)  # runs are cut at the ends of chunks
    texts = repeated_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (bytes(r["kept"]), r["n_removed"], r["n_spans"]) for r in suffix_index.deduplicated(df, "doc_id", "text", batches=1).collect()}
    assert [got[i] for i in range(len(texts))] == cut([t.encode() for t in texts], 400)


def test_levels_merge_geometrically(spark):
    family = suffix_index.SuffixFamily(spark, "bigint")
    ranks = []
    for b in range(5):
        family.ingest(spark.createDataFrame([(b, f"{b} " * 500)], "id long, text string"))
        ranks.append(sorted(family.levels))
    assert ranks == [[0], [1], [0, 1], [2], [0, 2]]
    assert family.levels[2].agg(F.sum("n")).first()[0] == sum(x.count() for x in family.batches[:4])


def test_repeated_strings_odd_rows(odd):
    out = suffix_index.deduplicated(odd, "doc_id", "text")
    assert set(odd.columns) <= set(out.columns)
    rows = out.collect()
    assert len(rows) == odd.count()
    for r in rows:
        whole = r["doc_id"] in (4, 5)
        assert r["n_removed"] == (r["n_bytes"] if whole else 0) and bytes(r["kept"]) == (b"" if whole else (r["text"] or "").encode())
    assert suffix_index.deduplicated(odd.limit(0), "doc_id", "text").count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><article>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=/a>Menu one</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><header><h2>Head &amp; line</h2><span>by me</span></header><p>First&nbsp;<b>bold</b>er  text<br>next &lt;line&gt;<p title="a > b">Second<ul><li>one<li>two</ul>
<div class="ad-slot">Buy</div><form><input value=x>Send</form><!-- no --><table><tr><td>c1<td>c2</table><aside>Side</aside><section id=comments><article class=comment>Nice!</article></section></article>
<div id="sidebar"><p>Links</p></div><footer>&copy; all</footer></body></html>"""


def test_main_text_of_a_page():
    text = " ".join(html.chosen(html.parse(PAGE, {}), set()))
    assert text == "Head & line First bolder text next <line> Second one two c1 c2"
    for broken in ("", "plain & text", "<", "<p", "<article><p>open <b>never closed", "</p></div>x", "<a title='it's>y</a>", "<" * 5000, '<p a="' * 3000):
        html.chosen(html.parse(broken, {}), set())


@pytest.mark.parametrize("part, text", [
    ('<svg class="x" viewBox="0 0 1 1"/>', ""), ("<math/>", ""), ("<button>Share", "Share "), ("<object data=x>Fallback", "Fallback "), ("<math><mi>x</mi><mo>=</mo><mn>1</mn></math>", "x=1 "),
    ("<svg><text>drawn</text></svg>", ""), ("<button><div>Share</div></button>", ""), ("<select><option>a<option>b</select>", ""), ("<svg/><svg><g/></svg>", ""),
])
def test_text_after_drawings_formulas_and_buttons_is_kept(part, text):
    page = f"<body><article><p>First</p>{part}<p>Then</p><button>b</button><p>Last</p></article></body>"
    assert " ".join(html.chosen(html.parse(page, {}), set())) == f"First {text}Then Last"


def test_template_of_a_host_is_cut_by_its_importance(spark):
    rows = [(i, "https://User@Host.org:80/p%d" % i, f"<body><div><div>Welcome to our host</div><div><div>Own text {i} of page {i * i}.</div></div><p>Call us now</p></div></body>") for i in range(12)]
    rows += [(50, "https://alone.org/", "<body><div><div>Welcome to our host</div><div><div>Own text.</div></div></div></body>"), (51, None, None), (52, None, ""), (52, "x", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit(1), "low": F.lit(2), "row": F.lit(3), "text": F.lit("old")})
    got = {r["page_id"]: r for r in html.with_main_text(df, "url", "html").collect()}
    counts = html.style_counts(df.select(F.lit("h").alias("host"), "html").limit(12), "host", "html")
    nodes = {r["importance"] for r in html.node_importance(counts).collect()}
    assert min(nodes) < 0.2 < max(nodes)
    for i in range(12):
        assert got[i]["text"] == f"Own text {i} of page {i * i}."
    assert got[50]["text"] == "Welcome to our host Own text." and got[51]["text"] == got[52]["text"] == "" and got[50]["n_chars"] == len(got[50]["text"])
    few = html.with_main_text(df, "url", "html", broadcast_bytes=0)
    assert {r["page_id"]: r["text"] for r in few.collect()} == {i: r["text"] for i, r in got.items()}
    assert html.with_main_text(df.limit(0), "url", "html").count() == 0


def test_articles_with_the_same_text_are_kept(spark):
    rows = [(i, "https://h.org/%d" % i, "<body><nav>Menu</nav><article><h1>Same</h1><p>The same article.</p></article><footer>f</footer></body>") for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["text"] for r in html.with_main_text(df, "url", "html").collect()} == {"Same The same article."}


@pytest.mark.parametrize("page", ["<div class='c'>{rest}<p>{text}</p></div>", "<div class='c'>{text}{rest}</div>"])
def test_own_text_below_a_node_of_many_child_sequences_is_kept(spark, page):
    # 16 child sequences, one of them on 985 of 1,000 pages
    rest = ["".join(f"<h{1 + k // 4}></h{1 + k // 4}><ul class='u{chr(97 + k)}'></ul>" for k in ([i % 15] if i < 15 else [])) for i in range(1000)]
    rows = [(i, "http://hot.org/", "<body>" + page.format(rest=rest[i], text=f"The text of page {i}.") + "<div class='t'><p>On every page</p></div></body>") for i in range(1000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    counts = html.style_counts(df.select(F.lit("h").alias("host"), "html"), "host", "html")
    many = counts.where(F.col("kind") == html.STYLE).groupBy("path").count().where("count = 16").select("path")
    assert html.node_importance(counts).join(many, "path").first()["importance"] < 0.2
    got = {r["page_id"]: r["text"] for r in html.with_main_text(df, "url", "html").collect()}
    assert got == {i: f"The text of page {i}." for i in range(1000)}


@pytest.mark.parametrize("copies, last", [(334, ""), (334, "<p>Seen {i} times</p>"), (600, "")])
def test_copies_on_a_host_without_articles_are_kept(spark, copies, last):
    page = "<body><div><p>Call us now</p><p>{text}</p><p>{more}</p>" + last + "</div></body>"
    rows = [(i, "http://hot.org/", page.format(i=i, text="The copied text.", more="And its end.") if i < copies else page.format(i=i, text=f"Text {i}.", more=f"End {i}.")) for i in range(1000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.with_main_text(df, "url", "html").collect()}
    seen = lambda i: f" Seen {i} times" if last else ""
    assert got == {i: ("The copied text. And its end." if i < copies else f"Text {i}. End {i}.") + seen(i) for i in range(1000)}


def labelled_texts(n, seed):
    rng = random.Random(seed)
    bad = {"en": ["vile", "scorn", "brute"], "de": ["wüst", "grob"]}
    rows = []
    for i in range(n):
        lang, toxic = rng.choice(["en", "de"]), int(rng.random() < 0.3)
        words = [f"{lang}{rng.randrange(400)}" for _ in range(rng.randrange(5, 80))]
        for _ in range(2 * toxic):
            words[rng.randrange(len(words))] = rng.choice(bad[lang])
        rows.append((i, " ".join(words), lang, toxic))
    return rows


def test_classifier_on_rows_held_out(spark, odd):
    rows = labelled_texts(1200, 8)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows if r[0] % 3] + [(9999, 1), (None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    truth = {r[0]: r[3] for r in rows}
    scored = [(r["score"], truth[r["doc_id"]], r["toxic_flag"]) for r in toxicity.with_scores(docs, "text", "lang", model).collect() if r["doc_id"] % 3 == 0]
    assert np.mean([(s >= 0.7) == bool(y) for s, y, _ in scored]) > 0.95 and np.mean([f == bool(y) for _, y, f in scored]) > 0.95
    assert {"", "en", "de"} <= set(model.thresholds)
    out = toxicity.with_scores(odd, "text", "lang", model)
    assert set(out.columns) == set(odd.columns) | {"toxic_flag"}
    got = out.collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if not (r["text"] or "").strip()}) == 1  # no words
    again = toxicity.with_scores(docs.withColumn("lang", F.lit("xx")), "text", "lang", toxicity.train(docs, labels)).select("score").collect()
    assert sorted(r["score"] for r in again) == sorted(r["score"] for r in toxicity.with_scores(docs, "text", "lang", model).collect())


def test_scores_and_thresholds_stand_for_all_labels_not_for_the_sample(spark):
    rng = random.Random(9)
    rows = []
    for i in range(4000):
        toxic, lang = int(rng.random() < 0.06), "de" if i % 4 == 0 else "en"
        words = [f"{lang}{rng.randrange(200)}" for _ in range(20)] + ["vile"] * (rng.random() < (0.7 if toxic else 0.05))
        rows.append((i, " ".join(words), lang, toxic))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    share = np.mean([r[3] for r in rows])
    model = toxicity.train(docs, labels, most_toxic=100, most_clean=200)
    scores = [r["score"] for r in toxicity.with_scores(docs, "text", "lang", model).collect()]
    assert 0.8 * share < np.mean(scores) < 1.25 * share
    assert {"", "en", "de"} <= set(model.thresholds)


def test_classifier_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string").withColumn("lang", F.lit("en"))
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r["score"] < 0.7 for r in toxicity.with_scores(docs, "text", "lang", none).collect())
    assert toxicity.with_scores(docs.limit(0), "text", "lang", none).count() == 0


def random_model(seed=0, words=50):
    rng = np.random.default_rng(seed)
    embedding = np.r_[np.zeros((1, 16)), rng.normal(size=(words - 1, 16))].astype(np.float32)
    filters = {w: rng.normal(size=(w, 16, 8)).astype(np.float32) for w in toxicity.WIDTHS}
    size = 8 * len(toxicity.WIDTHS)
    return toxicity.Model(np.arange(toxicity.BUCKETS) % words, embedding, filters, rng.normal(size=size).astype(np.float32), rng.normal(size=size).astype(np.float32), 0.1)


def plain_logit(model, rows):
    """One text at a time, window by window."""
    rows = [*rows, *[0] * toxicity.PAD]
    pooled = []
    for width, f in model.filters.items():
        windows = [sum(model.embedding[rows[i + k]] @ f[k] for k in range(width)) for i in range(len(rows) - width + 1)]
        pooled.append(np.max(windows, axis=0))
    return np.maximum(np.concatenate(pooled) + model.bias, 0) @ model.weights + model.intercept


def test_scores_equal_a_plain_forward_pass(spark):
    """A text's score is the same alone and among others, empty texts included."""
    model, rng = random_model(), np.random.default_rng(1)
    docs = [rng.integers(0, 50, rng.integers(0, 9)) for _ in range(150)]
    got = model.logits([toxicity.padded(d) for d in docs], model.tables())
    assert got == pytest.approx([plain_logit(model, d) for d in docs], rel=1e-4, abs=1e-3)
    texts = [None, "", "one word", *[" ".join(f"{chr(97 + x % 26)}{chr(97 + x // 26)}" for x in d) for d in docs[:40]]]
    rows = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "id long, text string, lang string").repartition(3)
    scored = {r["id"]: r["score"] for r in toxicity.with_scores(rows, "text", "lang", model).collect()}
    for i, text in enumerate(texts):
        logit = plain_logit(model, [model.row_of[b] for b in toxicity.buckets(text or "", {})])
        assert scored[i] == pytest.approx(1 / (1 + np.exp(-np.clip(logit, -30, 30))), rel=1e-3, abs=1e-5)


def test_held_out_labels_are_not_learned(spark):
    """The scores of op10 do not change when the labels that are held out are turned round."""
    rows = queries.QUERIES["op10_toxicity"](spark, FOLDER).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()} if "text" in docs.columns else {}
        docs = stage(spark, docs, FOLDER).persist()
        after[name] = (before, docs)
    before, out = after["near_duplicates"]
    rows = sorted(before.items())
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(i for (i, _), (c, _) in zip(rows, classes(rows)) if c == i)
    before, out = after["repeated_strings"]
    rows = sorted(before.items())
    want = {i: (kept, gone) for (i, t), (kept, gone, _) in zip(rows, cut([t.encode() for _, t in rows], 400)) if kept or not t}
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert set(got) == set(want)
    for i, (kept, gone) in want.items():
        assert got[i][0] == (kept.decode("utf-8", "ignore") if gone else before[i]) and got[i][1] == len(got[i][0])
    before, out = after["decontamination"]
    import re

    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    words = lambda t: pattern.findall((t or "").translate(low))
    items = [words(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    grams = {tuple(w[i:i + 10]) for w in items for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(g) for g in grams}
    clean = {i for i, t in before.items() if not any(tuple(words(t)[k:k + s]) in grams for s in sizes for k in range(len(words(t)) - s + 1))}
    assert {r["doc_id"] for r in out.collect()} == clean
    for name, (before, out) in after.items():
        if name != "encoding":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert after["encoding"][1].count() == len(clean)


    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    codec = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
    before, out = after["encoding"]
    for r in out.collect():
        ids = codec.encode_ordinary(before[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(before[r["doc_id"]].encode()).hexdigest()


def test_stages_hold_few_texts_at_once(spark, capsys):
    """Arrow batches are small in every stage, and no task holds encoders and decoders together."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(20)
    for given, kept in (("10000", 500), ("0", 500), ("100", 100)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", given)
        try:
            out = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
            assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == kept
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    out.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_and_empty_documents(spark, odd, stage):
    """Columns named like those of the operators come through unchanged."""
    docs = odd.withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long"), "toxic_flag": F.lit("extra toxic_flag"), "n_removed": F.lit("extra n_removed")})
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, docs, FOLDER)
    kept = out.count()
    assert kept <= docs.count() and run(spark, docs.limit(0), FOLDER).count() == 0
    if name != "encoding":
        assert out.columns == docs.columns
        extras = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
        assert all(out.where(F.col(c) != f"extra {c}").count() == 0 for c in extras)
    if name == "decontamination":
        assert kept == docs.count()
