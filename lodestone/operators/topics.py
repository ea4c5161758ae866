"""Topics by mini-batch variational updates, with expected counts as rows.

Documents are lists of (term, count) cells. In every step the documents of one batch, chosen by a hash of their keys, meet the
current topics; each task fits its documents' topic shares with numpy and adds up the expected counts of (topic, term), which
Spark sums. The topics move towards what the batch says by a step that shrinks. The vocabulary is bounded by the caller.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.operators.ordered import broadcast_if_small
from lodestone.session import stored


def digamma(x: np.ndarray) -> np.ndarray:
    """The derivative of the logarithm of the gamma function, for positive numbers: recurrence up to 6, then its series."""
    x, out = np.array(x, dtype=float), np.zeros(np.shape(x))
    while (small := x < 6).any():
        out = np.where(small, out - 1 / x, out)
        x = np.where(small, x + 1, x)
    inverse = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - inverse * (1 / 12 - inverse * (1 / 120 - inverse / 252))


def shares(terms: np.ndarray, counts: np.ndarray, beta: np.ndarray, alpha: float, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """(gamma, phi-weighted counts topics x terms) of one document; `beta` is exp(E[log topic]) by topic and term."""
    own = beta[:, terms] + 1e-100
    gamma = np.full(len(beta), alpha + counts.sum() / len(beta))
    for _ in range(rounds):
        theta = np.exp(digamma(gamma) - digamma(gamma.sum()))
        moved = alpha + theta * (own @ (counts / (theta @ own)))
        change = np.abs(moved - gamma).mean()
        gamma = moved
        if change < 1e-4:
            break
    theta = np.exp(digamma(gamma) - digamma(gamma.sum()))
    return gamma, theta[:, None] * own * (counts / (theta @ own))


def documents(tf: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """(key, terms, counts) of every document with words of the vocabulary, stored; lists are as long as the vocabulary at most.

    `tf` is (key, term, tf), `words` (term, idx) with numbers from 0.
    """
    cells = tf.join(broadcast_if_small(words), "term").groupBy(F.col(key).alias("key")).agg(F.array_sort(F.collect_list(F.struct("idx", "tf"))).alias("cells"))
    return stored(cells.select("key", F.transform("cells", lambda c: c["idx"].cast("int")).alias("terms"), F.transform("cells", lambda c: c["tf"].cast("double")).alias("counts")), "cells")


def _expected(rows: DataFrame, beta: np.ndarray, alpha: float) -> tuple[np.ndarray, float, float, int]:
    """Expected counts (topics x terms), log likelihood bound of the words, number of words and documents."""
    topics, size = beta.shape
    shared = rows.sparkSession.sparkContext.broadcast(beta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beta, total, bound, words, docs = shared.value, np.zeros((topics, size)), 0.0, 0.0, 0
        for batch in batches:
            for terms, counts in zip(batch.column(0), batch.column(1)):
                t, c = terms.values.to_numpy(), counts.values.to_numpy()
                gamma, phi = shares(t, c, beta, alpha)
                np.add.at(total.T, t, phi.T)
                bound += float(c @ np.log((gamma / gamma.sum()) @ (beta[:, t] / beta.sum(axis=1, keepdims=True)) + 1e-100))
                words += float(c.sum())
                docs += 1
        at = np.flatnonzero(total.ravel())
        slots = np.concatenate([at, np.arange(3) + topics * size])
        values = np.concatenate([total.ravel()[at], [bound, words, docs]])
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64)), pa.array(values)], names=["slot", "v"])

    found = rows.select("terms", "counts").mapInArrow(run, "slot bigint, v double").groupBy("slot").agg(F.sum("v").alias("v")).toPandas()  # topics x vocabulary
    shared.destroy()
    out = np.zeros(topics * size + 3)
    out[found["slot"]] = found["v"]
    return out[:-3].reshape(topics, size), out[-3], out[-2], int(out[-1])


def fit(docs: DataFrame, size: int, topics: int, steps: int, batches: int = 1, alpha: float | None = None, eta: float | None = None, delay: float = 1.0, power: float = 0.7, seed: int = 7) -> tuple[np.ndarray, list[float]]:
    """(lambda, perplexities): topic-term weights (topics x vocabulary) after so many steps, and each batch's perplexity before its step.

    Step t takes the documents whose key's hash is t modulo `batches` and moves the weights by (delay + t) ** -power; with one
    batch, weights are replaced as in variational EM. A batch without documents moves nothing. A document that has no word
    of the vocabulary does not count.
    """
    alpha, eta = alpha or 1 / topics, eta or 1 / topics
    weights = np.random.default_rng(seed).gamma(100.0, 0.01, (topics, size))
    all_docs, perplexities = docs.count(), []
    for t in range(steps):
        beta = np.exp(digamma(weights) - digamma(weights.sum(axis=1, keepdims=True)))
        part = docs if batches == 1 else docs.where(F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(batches)) == t % batches)
        counts, bound, words, n = _expected(part, beta, alpha)
        if not n:
            continue
        perplexities.append(float(np.exp(-bound / words)))
        rate = 1.0 if batches == 1 else (delay + t) ** -power
        weights = (1 - rate) * weights + rate * (eta + counts * all_docs / n)
    return weights, perplexities


def topic_terms(weights: np.ndarray, words: DataFrame) -> DataFrame:
    """(topic, term, weight): the share of every term in every topic; each topic's shares add up to 1."""
    rows = [(k, i, float(x)) for k, own in enumerate(weights / weights.sum(axis=1, keepdims=True)) for i, x in enumerate(own)]
    return words.sparkSession.createDataFrame(rows, "topic int, idx bigint, weight double").join(words, "idx").select("topic", "term", "weight")
