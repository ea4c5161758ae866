"""Token counts, byte-pair encoding and token files against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestone.llm import bpe, counts, queries, token_files
from tests.llm.conftest import LONG

BYTES, WORDS, RANKS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken")
FOLDER = "/root/testdata/sf0.001"


def strings(n=4000):
    random.seed(3)
    parts = list("abzTHé ÀÿſƀȘñ  \n\t'sllve19²½ΩΣσςاب漢字한 \x1c\x85́̈‍_.,!?-#<|>ﬁİẞ　") + [
        "<|endoftext|>", "<|startoftext|>", "don't", "we'll", "\U0001F600", " the"]
    drawn = ["".join(random.choice(parts) for _ in range(random.randint(0, 60))) for _ in range(n)]
    return ["", " ", "  a", "a  ", "aaaa" * 500, "!" * 3000, " " * 3000, LONG[:20_000], *drawn]


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_equals_tiktoken(tik):
    for text in strings():
        assert bpe.encode_text(text, RANKS, P.PATTERN).tolist() == tik.encode_ordinary(text)


def test_counts_and_ids_equal_the_library():
    texts = strings()
    count = counts.counter(BYTES)
    numbers = [n for i in range(0, len(texts), 64) for n in count(texts[i:i + 64])]
    ids = [x for i in range(0, len(texts), 64) for x in token_files.encode_texts(texts[i:i + 64], WORDS)]
    for n, own, a, b in zip(numbers, ids, Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False), Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)):
        assert n == len(a.ids) and own.tolist() == b.ids


def test_streaming_decode_in_any_pieces(tik):
    bytes_of = bpe._decoder(RANKS)
    for text in strings(200):
        ids = tik.encode_ordinary(text)
        for chunk in (1, 3, 4096):
            stream = bpe.StreamDecoder(bytes_of)
            assert "".join(stream.feed(ids[i:i + chunk]) for i in range(0, len(ids), chunk)) + stream.finish() == text
    broken = bpe.StreamDecoder({0: b"\xe6\xbc", 1: b"a"})
    assert broken.feed([0]) + broken.feed([1]) + broken.finish() == "�a"


def test_encode_decode_odd_rows(spark, odd, tik):
    back = bpe.decode(bpe.encode(odd, "doc_id", "text", RANKS, P.PATTERN), "doc_id", RANKS)
    want = sorted(((r["doc_id"] or -1, r["text"] or "") for r in odd.collect()))
    got = back.collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in got) == want
    assert all(r["ids"] == tik.encode_ordinary(r["text"]) for r in got)
    assert bpe.decode(bpe.encode(odd.limit(0), "doc_id", "text", RANKS, P.PATTERN), "doc_id", RANKS).count() == 0


def test_counts_odd_rows(odd):
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in counts.with_token_counts(odd, "doc_id", "text", BYTES, 512).collect())
    library = Tokenizer.from_file(BYTES)
    rows = [(r["doc_id"] or -1, r["text"] or "") for r in odd.collect()]
    want = [(i, len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in rows]
    assert got == sorted((*w, w[2] > 512) for w in want)
    assert counts.with_token_counts(odd.limit(0), "doc_id", "text", BYTES, 512).count() == 0


@pytest.mark.parametrize("bits, unit", [(16, 8), (16, 1), (17, 1), (24, 8)])
def test_planes_round_trip(bits, unit):
    ids = np.random.default_rng(1).integers(0, 1 << min(bits, 17), 70_001, dtype=np.uint32) & np.uint32((1 << bits) - 1)
    assert (token_files.from_planes(token_files.to_planes(ids, bits, unit), len(ids), unit) == ids).all()


@pytest.mark.parametrize("unit", [1, 8])
def test_files_keep_order_and_ids(spark, odd, unit):
    manifest = token_files.write(odd, "doc_id", "text", WORDS, end_id=2, unit=unit)
    got = token_files.read(manifest, "bigint").orderBy("start").collect()
    rows = sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["text"] or "") for r in odd.collect())
    assert [(-1 if r["id"] is None else r["id"]) for r in got] == [i for i, _ in rows]
    library = Tokenizer.from_file(WORDS)
    assert sorted(tuple(r["ids"]) for r in got) == sorted((*library.encode(t, add_special_tokens=False).ids, 2) for _, t in rows)
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    digests = token_files.read(manifest, "bigint", digest=True).orderBy("start").collect()
    assert [r["ids_crc32"] for r in digests] == [zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got]
    assert token_files.read(token_files.write(odd.limit(0), "doc_id", "text", WORDS, end_id=2), "bigint").count() == 0


def test_files_refuse_ids_that_do_not_fit(odd):
    with pytest.raises(Exception, match="does not fit"):
        token_files.write(odd, "doc_id", "text", WORDS, end_id=1 << 20).count()


def test_queries_over_documents(spark, tik):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in queries.QUERIES["op4_bpe"](spark, FOLDER).collect():
        ids = tik.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    at, library = 0, Tokenizer.from_file(WORDS)
    for r in queries.QUERIES["op3_token_files"](spark, FOLDER).orderBy("doc_id").collect():
        ids = np.array(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [2], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    library = Tokenizer.from_file(BYTES)
    for r in queries.QUERIES["op8_token_counts"](spark, FOLDER).collect():
        assert (r["n_bytes"], r["n_tokens"]) == (len(texts[r["doc_id"]].encode()), len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids))
