"""Bottom-k near-duplicates, Merkle manifests and collocations against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import collocations, merkle, queries, sketches
from lodestone.session import stored
from tests.oracle import normal, sql_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_bottom_k", "op12_merkle_manifest", "op13_collocations"])
def test_against_sql(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == sql_rows(queries.ORACLES[name], FOLDER)


# ------------------------------------------------------------------ bottom-k sketches


def gram_set(text, n=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    n = min(n, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def components(rows, percent=85):
    sets = [gram_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for a, (i, _) in enumerate(rows):
        least[find(a)].append(i)
    best = [min((x for x in least[find(a)] if x is not None), default=None) for a in range(len(rows))]
    return Counter((i, len(s), i if not s else c, (i if not s else c) == i) for (i, _), s, c in zip(rows, sets, best))


def check_components(spark, rows, percent=85):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in sketches.near_duplicates(df, "doc_id", "text", 3, percent).collect()) == components(rows, percent)


def family(n, words, seed, changes):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(9000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(changes + 1)):
            copy[rng.randrange(words)] = f"n{rng.randrange(10**9)}"
        out.append(" ".join(copy))
    return out


def test_components(spark):
    texts = family(40, 60, 1, 2) + family(40, 60, 1, 4) + family(30, 400, 2, 16) + family(20, 12, 3, 1) + family(20, 180, 4, 10)
    rng = random.Random(5)
    texts += [" ".join(f"r{rng.randrange(500)}" for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(900, texts[0]), (901, texts[0].upper()), (None, texts[0]), (902, None), (903, ""), (902, None), (904, "one two"), (905, "ONE  two"), (906, "one"), (907, "ÉCOLE École"), (908, "École École"), (None, "alone and unnamed here")]
    check_components(spark, rows)


def test_chains_and_blocks(spark, monkeypatch):
    """Texts that drift word by word: links reach far beyond what is alike; lists are cut into many blocks."""
    monkeypatch.setattr(sketches, "BLOCK", 8)
    rng = random.Random(7)
    now, rows = [f"c{k}" for k in range(80)], []
    for i in range(90):
        rows.append((i, " ".join(now)))
        for _ in range(rng.randrange(1, 4)):
            now[rng.randrange(80)] = f"x{rng.randrange(10**9)}"
    rng.shuffle(rows)
    stem = " ".join(f"law{k}" for k in range(40))
    rows += [(1000 + i, f"{stem} " + " ".join(f"u{i}v{k}" for k in range(rng.randrange(4, 60)))) for i in range(60)]
    check_components(spark, rows)


def test_sketches_stay_in_place(spark, monkeypatch):
    """Sketches and sets are joined without a shuffle of their own while the other side is small; else the rows are the same."""
    texts = family(30, 60, 1, 2) + family(20, 400, 2, 30) + family(20, 180, 4, 10)
    rows = list(enumerate(texts)) + [(900, texts[0]), (901, texts[0].upper()), (902, None), (None, texts[3])]
    plans = defaultdict(list)

    def recorded(df, label):
        plans[label].append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # Spark's own choice changes with the size
    try:
        with monkeypatch.context() as patch:
            patch.setattr(sketches, "stored", recorded)
            check_components(spark, rows)
        assert plans["sets"] and plans["joining"] and not [p for p in plans["sets"] + plans["joining"] if "SortMergeJoin" in p]
        monkeypatch.setattr(sketches, "broadcast_if_small", lambda df, **most: df)
        check_components(spark, rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_overlap_bound_and_union_sketch(spark):
    for width in (sketches.LISTED, sketches.KEPT):
        sure = sketches.sure_overlap(width, 85)
        assert width / 3 < sure < width * 0.85
        assert (np.random.default_rng(1).binomial(width, 0.85, 200_000) < sure).sum() == 0
    rng, rows = np.random.default_rng(3), []
    for j in (0.3, 0.5, 0.84, 0.86, 0.95):
        common = int(round(600 * j))
        values = rng.integers(-(2**63), 2**63 - 1, 600)
        a, b = values[:common + (600 - common) // 2], np.r_[values[:common], values[common + (600 - common) // 2:]]
        rows.append((j, len(a), len(b), np.sort(a)[:128].tolist(), np.sort(b)[:128].tolist()))
    df = spark.createDataFrame(rows, "j double, size_a long, size_b long, set_a array<bigint>, set_b array<bigint>")
    passed = {r["j"]: r["passed"] for r in df.select("j", sketches.union_sketch_passes(85).alias("passed")).collect()}
    assert not passed[0.3] and passed[0.86] and passed[0.95]


def test_sketch_odd_rows(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = sketches.near_duplicates(odd, "doc_id", "text")
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert Counter(tuple(r) for r in got.collect()) == components(rows)
    assert sketches.near_duplicates(odd.limit(0), "doc_id", "text").count() == 0


# ------------------------------------------------------------------ Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def proofs(nodes):
    """The root of a list of digests, and each one's siblings from below as lists of (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            run = nodes[p // 16 * 16:p // 16 * 16 + 16]
            paths[k].append((run[:p % 16], run[p % 16 + 1:]))
            at[k] = p // 16
        nodes = [sha(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute_manifest(rows):
    groups = defaultdict(list)
    for doc, source, text in rows:
        groups[source].append((doc, leaf_of(doc, source, text), text))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: ((r[0] is not None, r[0] or 0), r[1]))
        trees[s] = proofs([r[1] for r in groups[s]])
    root, above = proofs([trees[s][0] for s in names])
    out = Counter()
    for k, s in enumerate(names):
        for (doc, leaf, text), own in zip(groups[s], trees[s][1]):
            steps = own + above[k]
            now = leaf_of(doc, s, text.translate({c: c + 32 for c in range(65, 91)}) if text is not None and doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0 else text)
            for left, right in steps:
                now = sha(*left, now, *right)
            out[doc, leaf, trees[s][0], root, sha(*[x for left, right in steps for x in left + right]), now] += 1
    return out


def spark_manifest(df):
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.translate("text", *merkle.LOWER)).otherwise(F.col("text"))
    got = merkle.manifest(df, "doc_id", "source", ["doc_id", "source", "text"], merkle.leaf(F.col("doc_id"), F.col("source"), changed))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "path", "now"]
    rows = got.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), merkle.folded(F.col("path"), F.col("now"))).collect()
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16, "b": 17, None: 1, "É": 256, "": 3}, {f"s{k}": 1 + k % 3 for k in range(40)}, {"hot": 4500, "b": 2}])
def test_manifest(spark, sizes):
    rng, rows, i = random.Random(1), [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, source, rng.choice([None, "", f"Text {i} ÄÖ", "same TEXT", "lower"])))
            i += rng.randrange(1, 9)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    assert spark_manifest(df) == brute_manifest(rows)


def test_manifest_odd_rows(spark, odd):
    df = odd.withColumn("source", F.when(F.col("doc_id") > 3, "b")).withColumn("g", F.lit(1)).withColumn("pos", F.lit("x")).withColumn("node", F.lit(2))
    rows = [(r["doc_id"], r["source"], r["text"]) for r in df.collect()]
    assert spark_manifest(df) == brute_manifest(rows)
    assert sum(spark_manifest(df.limit(0)).values()) == 0


# ------------------------------------------------------------------ collocations


def brute_phrases(rows, min_count, max_words, top, covered=100):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\n-\r]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        dropped = {q[i:i + k] for q, a in candidates.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if 100 * a >= covered * counts[q[i:i + k]]}
        scored = []
        for p, a in candidates.items():
            if p not in dropped:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        scored.sort()
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(scored[:top], 1)]
    return sorted(out)


def corpus(seed, docs):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(25)] + ["Über", "漢字", "x|y", "A", "a"]
    parts = [" ".join(rng.choices(vocabulary, k=rng.randrange(2, 7))) for _ in range(12)]
    rows = []
    for _ in range(docs):
        pieces = [rng.choice([rng.choice(parts), " ".join(rng.choices(vocabulary, k=rng.randrange(0, 9)))]) + rng.choice([" ", ", ", ".", "\n", "\t", "!?"]) for _ in range(rng.randrange(0, 12))]
        rows.append((rng.choice(["en", "de", None, "und"]), rng.choice(["", " "]) + "".join(pieces)))
    return rows + [("en", None), ("en", ""), ("fr", "a a a a a a a a a a a a a a a a a a a a"), ("de", "\x1c odd \x85   odd")]


def check_phrases(spark, rows, **how):
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("f", F.lit(1)).withColumn("word", F.lit("x")).repartition(4)
    got = collocations.collocations(df, "text", "lang", **how)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, how["min_count"], how["max_words"], how["top"], how.get("covered", 100))


def test_phrases(spark):
    check_phrases(spark, corpus(1, 200), min_count=5, max_words=5, top=50)


def test_phrases_in_small_batches(spark):
    """Arrow batches are lowered, so that few texts are copied outside the heap at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, 10_000)
    try:
        collocations.collocations(spark.createDataFrame([("en", "a b. a b")], "lang string, text string"), "text", "lang", min_count=2)
        assert int(spark.conf.get(name)) == 500
    finally:
        spark.conf.unset(name)


def test_phrases_in_many_tries_and_flushes(spark, monkeypatch):
    for name, value in (("TRIE_PHRASES", 40), ("WORDS_HELD", 7), ("NUMBERS_HELD", 50)):
        monkeypatch.setattr(collocations, name, value)
    check_phrases(spark, corpus(2, 150), min_count=4, max_words=4, top=10_000, covered=80)


def test_phrases_of_shared_hashes(spark, monkeypatch):
    """Two words with one hash: everything is made anew with another seed."""
    real, seeds = collocations.word_counts, []

    def clashing(rows, seed):
        seeds.append(seed)
        return real(rows, seed).withColumn("hash", F.lit(5).cast("bigint")) if seed == 0 else real(rows, seed)

    monkeypatch.setattr(collocations, "word_counts", clashing)
    check_phrases(spark, [("en", "w1 w2 w3 w1 w3. w2 w3")] * 5, min_count=2, max_words=3, top=50)
    assert seeds == [0, 1]


def test_phrases_of_nothing(spark, odd):
    empty = odd.limit(0)
    assert collocations.collocations(empty, "text", "lang").count() == 0
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    got = collocations.collocations(odd, "text", "lang", min_count=2, max_words=3, top=500)
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, 2, 3, 500)


def test_exact_beyond_64_bits(spark):
    """a * n * 1000 and l * r pass 64 bits; the score stays exact."""
    big = 3_000_000_000_000
    row = spark.sql(f"select cast(1000 * {big} as decimal(19, 0)) * cast({big * 7} as decimal(19, 0)) div (cast({big} as decimal(19, 0)) * cast({big + 1} as decimal(19, 0))) as score").first()
    assert row["score"] == 1000 * big * big * 7 // (big * (big + 1))


def test_double_array():
    rng = np.random.default_rng(4)
    for rows, depth, symbols in ((1, 1, 5), (300, 1, 1000), (4000, 3, 60), (3000, 4, 2000)):
        words = np.unique(rng.integers(1, 1 << 62, symbols, dtype=np.uint64))
        table = np.unique(rng.choice(words, (rows, depth)), axis=0)
        ids = rng.permutation(len(table)).astype(np.int64)
        trie = collocations.DoubleArray(table, ids)
        text = np.concatenate([table.ravel(), rng.choice(np.r_[words, np.uint64(0)], 5000)])
        known = {tuple(r): i for r, i in zip(table.tolist(), ids)}
        want = [known.get(tuple(text[i:i + depth].tolist()), -1) for i in range(len(text))]
        assert trie.found(text).tolist() == want
