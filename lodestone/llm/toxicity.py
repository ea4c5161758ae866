"""A convolutional text classifier: hashed word embeddings, filters of several widths, max pooling, trained in numpy.

Words of fewer than MIN_DOCS training texts keep a zero embedding, so that a rare word says nothing. A score depends on the
text alone. Scores and thresholds by language are calibrated on all labelled rows that the fit did not use, each class weighted
to its share of all labelled rows: the fit itself takes a bounded sample of each class.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from lodestone.llm.rows import give_back, sliced, tidy, unwrapped, wrapped
from lodestone.operators.ordered import broadcast_if_small
from lodestone.session import stored

WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 20
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS)
#: Logits are counted in steps of 1 / STEPS, those beyond LIMIT at LIMIT.
STEPS, LIMIT = 64, 32
#: Rows of either class from which on a language has a threshold of its own.
LEAST = 20


def buckets(text: str, known: dict[str, int]) -> list[int]:
    """The hashed words of a whole text, lower-cased; never 0, which is the padding."""
    found = WORD.findall(text.lower())
    out = []
    for word in found:
        bucket = known.get(word)
        if bucket is None:
            if len(known) > 200_000:
                known.clear()
            bucket = known[word] = 1 + zlib.crc32(word.encode()) % (BUCKETS - 1)
        out.append(bucket)
    return out


@dataclass
class Model:
    """Rows of the embedding that are not zero, the filters, and the calibrated output."""

    row_of: np.ndarray  # bucket -> row, 0 for the zero row
    embedding: np.ndarray  # rows x dim
    filters: dict[int, np.ndarray]  # width -> width x dim x filters
    bias: np.ndarray  # of all filters
    weights: np.ndarray
    intercept: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)  # by language; "" for any other

    def tables(self) -> dict[int, list[np.ndarray]]:
        """What each word adds to each filter, by width and place in the window."""
        return {w: [np.ascontiguousarray(self.embedding @ f[k], dtype=np.float32) for k in range(w)] for w, f in self.filters.items()}

    def logits(self, docs: list[np.ndarray], tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        """Texts, given as padded rows, one after the other in one array."""
        rows = np.concatenate(docs)
        ends = np.cumsum([0, *map(len, docs)])
        starts, ends = ends[:-1], ends[1:]
        pooled = []
        for width, parts in tables.items():
            total = parts[0][rows]
            for k in range(1, width):
                total[:-k] += parts[k][rows[k:]]
                total[ends - k] = -np.inf  # a window that would reach into the next text
            pooled.append(np.maximum.reduceat(total, starts, axis=0))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        return hidden @ self.weights + self.intercept

    def scores(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * logits + self.scale[1], -30, 30)))


def padded(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([rows, np.zeros(PAD, rows.dtype)])


def fit(texts: list[np.ndarray], labels: np.ndarray, langs: list[str], dim: int = 16, n_filters: int = 8, epochs: int = 6, min_docs: int = 3, drop: float = 0.5, seed: int = 7) -> Model:
    """Train on hashed texts; every fifth text is kept out of the steps and used to calibrate.

    In each step a share `drop` of the words of a text is hidden, so that no single word of a text is learned by heart.

    One class only, or no texts, give a model that scores every text with the share of toxic ones.
    """
    rng = np.random.default_rng(seed)
    doc_freq = np.zeros(BUCKETS, np.int32)
    for t in texts:
        doc_freq[np.unique(t)] += 1
    active = np.flatnonzero(doc_freq >= min_docs)
    active = active[active > 0]
    row_of = np.zeros(BUCKETS, np.int32)
    row_of[active] = np.arange(1, len(active) + 1)
    embedding = rng.normal(0, 0.1, (len(active) + 1, dim)).astype(np.float32)
    embedding[:, 0] = _evidence(texts, labels, row_of, len(active) + 1)
    embedding[0] = 0
    filters = {w: rng.normal(0, 0.5 / np.sqrt(w * dim), (w, dim, n_filters)).astype(np.float32) for w in WIDTHS}
    size = n_filters * len(WIDTHS)
    model = Model(row_of, embedding, filters, np.zeros(size, np.float32), rng.normal(0, 0.3, size).astype(np.float32), 0.0)
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        model.weights[:] = 0
        model.intercept = float(np.log((share + 0.01) / (1.01 - share)))
        return model
    docs = [padded(row_of[t]) for t in texts]
    kept_out = np.arange(len(docs)) % 5 == 4
    train = np.flatnonzero(~kept_out)
    weight = np.where(labels == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
    params = {"bias": model.bias, "weights": model.weights, **{w: filters[w] for w in WIDTHS}}
    seen = {k: np.full_like(v, 1e-6) for k, v in params.items()}
    seen_rows, seen_intercept = np.full_like(embedding, 1e-6), 1e-6
    for epoch in range(epochs):
        rate = 0.08 / (1 + epoch)
        order = rng.permutation(train)
        for first in range(0, len(order), 32):
            grads = {k: np.zeros_like(v) for k, v in params.items()}
            touched, pulls, grad_intercept = [], [], 0.0
            for d in order[first:first + 32]:
                rows = np.where(rng.random(len(docs[d])) < drop, 0, docs[d])
                vectors = embedding[rows]
                tops, values = {}, []
                for w in WIDTHS:
                    n = len(rows) - w + 1
                    total = sum(vectors[k:k + n] @ filters[w][k] for k in range(w))
                    tops[w] = total.argmax(axis=0)
                    values.append(total[tops[w], np.arange(n_filters)])
                hidden = np.concatenate(values) + model.bias
                on = hidden > 0
                hidden = hidden * on
                p = 1 / (1 + np.exp(-np.clip(hidden @ model.weights + model.intercept, -30, 30)))
                g = np.float32(weight[d] * (p - labels[d]))
                grad_intercept += g
                grads["weights"] += g * hidden
                back = (g * model.weights * on).astype(np.float32)
                grads["bias"] += back
                for j, w in enumerate(WIDTHS):
                    own = back[j * n_filters:(j + 1) * n_filters]
                    for k in range(w):
                        at = tops[w] + k
                        grads[w][k] += vectors[at].T * own
                        touched.append(rows[at])
                        pulls.append(own[:, None] * filters[w][k].T)
            for k, v in params.items():
                grad = grads[k] / 32 + 1e-4 * v
                seen[k] += grad**2
                v -= rate * grad / np.sqrt(seen[k])
            grad_intercept /= 32
            seen_intercept += grad_intercept**2
            model.intercept -= rate * grad_intercept / np.sqrt(seen_intercept)
            rows, where = np.unique(np.concatenate(touched), return_inverse=True)
            pull = np.zeros((len(rows), dim), np.float32)
            np.add.at(pull, where, np.concatenate(pulls))
            pull = pull / 32 + 1e-4 * embedding[rows]
            seen_rows[rows] += pull**2
            embedding[rows] -= rate * pull / np.sqrt(seen_rows[rows])
            embedding[0] = 0
    tables, rest = model.tables(), [docs[i] for i in np.flatnonzero(kept_out)]
    logits = np.concatenate([np.empty(0), *[model.logits(rest[i:i + 64], tables) for i in range(0, len(rest), 64)]])
    _calibrate(model, logits, labels[kept_out], [langs[i] for i in np.flatnonzero(kept_out)])
    return model


def _evidence(texts: list[np.ndarray], labels: np.ndarray, row_of: np.ndarray, size: int) -> np.ndarray:
    """Where the first place of an embedding starts: the log odds of the labels of texts with the word, over their error."""
    counts = np.zeros((2, size))
    for text, label in zip(texts, labels):
        counts[int(label)][np.unique(row_of[text])] += 1
    n0, n1 = (labels == 0).sum(), (labels == 1).sum()
    odds = np.log((counts[1] + 0.5) / (n1 + 1)) - np.log((counts[0] + 0.5) / (n0 + 1))
    return (0.1 * odds / np.sqrt(1 / (counts[1] + 0.5) + 1 / (counts[0] + 0.5))).astype(np.float32)


def _calibrate(model: Model, logits: np.ndarray, labels: np.ndarray, langs: list[str], counts: np.ndarray | None = None, shares: tuple[float, float] = (1.0, 1.0)) -> None:
    """Scale the logits by logistic regression on rows the fit did not use; then, by language, the threshold with the best F1.

    A row stands for `counts` texts, and each of them for shares[label] texts of its class. A language with fewer than LEAST
    texts of either class takes the threshold over all; with fewer than five of a class in all there is nothing to go by, and
    the threshold is 0.7.
    """
    model.scale, model.thresholds = (1.0, 0.0), {}
    if len(logits) == 0 or labels.min() == labels.max():
        model.thresholds = {"": 0.7}
        return
    counts = np.ones(len(logits)) if counts is None else counts.astype(float)
    weights = counts * np.where(labels == 1, shares[1], shares[0])
    a, b = 1.0, 0.0
    # soft targets keep the slope finite when the classes do not overlap
    n1, n0 = counts[labels == 1].sum(), counts[labels == 0].sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        w, off = weights * np.maximum(p * (1 - p), 1e-9), weights * (p - target)
        h = np.array([[np.sum(w * logits**2), np.sum(w * logits)], [np.sum(w * logits), np.sum(w)]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, [np.sum(off * logits), np.sum(off)])
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    if a > 0 and np.isfinite([a, b]).all():
        model.scale = (float(a), float(b))
    scores = model.scores(logits)
    model.thresholds[""] = _best_threshold(scores, labels, weights) if min(n0, n1) >= 5 else 0.7
    tags = np.array(langs)
    for lang in sorted(set(langs) - {""}):
        own = tags == lang
        if min(counts[own & (labels == 1)].sum(), counts[own & (labels == 0)].sum()) >= LEAST:
            model.thresholds[lang] = _best_threshold(scores[own], labels[own], weights[own])


def _best_threshold(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """Half way between the last score taken and the next, where F1 is best; never outside 0.3 to 0.9."""
    values, place = np.unique(-scores, return_inverse=True)  # equal scores are taken together
    toxic = np.bincount(place, weights * labels)
    f1 = 2 * np.cumsum(toxic) / (np.cumsum(np.bincount(place, weights)) + toxic.sum())
    best = int(f1.argmax())
    below = -values[best + 1] if best + 1 < len(values) else 0.0
    return float(np.clip((-values[best] + below) / 2, 0.3, 0.9))


def _flagged(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    return labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).distinct()


def _texts(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, lang_col: str, most: dict[int, int]) -> DataFrame:
    """(buckets, label, lang) of at most most[label] labelled texts per class, those with the smallest hash of their id.

    Texts are hashed on the executors; the bound on rows is what may reach the driver.
    """
    flagged = _flagged(labels, id_col, label_col)
    drawn = [flagged.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(n) for k, n in sorted(most.items())]
    chosen = drawn[0]
    for more in drawn[1:]:
        chosen = chosen.unionByName(more)
    # at most sum(most.values()) ids
    rows = _texts(docs, id_col, text_col, lang_col)
    rows = rows.join(F.broadcast(chosen), "id").select(F.col("id").cast("string").alias("id"), "text", "label", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in sliced(batches):
            found = [np.array(buckets(t, known), "<i4").tobytes() if t else b"" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), batch.column(2), batch.column(3)], names=["id", "buckets", "label", "lang"])

    return rows.mapInArrow(tidy(run), "id string, buckets binary, label int, lang string")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", lang_col: str = "lang",
          most_toxic: int = 4000, most_clean: int = 8000, **settings) -> Model:
    """Fit on a sample bounded by `most_toxic` and `most_clean` labelled texts, calibrate on all labelled texts it did not use.

    Labels other than 0 and 1 are left out, as are labels without a document. If neither bound is reached, the texts not used
    are the fifth of the sample that the fit keeps out.
    """
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, lang_col, {0: most_clean, 1: most_toxic}).toArrow()
    order = sorted(range(sample.num_rows), key=lambda i: (zlib.crc32((sample["id"][i].as_py() or "").encode()), sample["id"][i].as_py() or ""))
    texts = [np.frombuffer(sample["buckets"][i].as_py(), "<i4") for i in order]
    classes = np.array([sample["label"][i].as_py() for i in order], np.float32)
    model = fit(texts, classes, [sample["lang"][i].as_py() for i in order], **settings)
    flagged = _flagged(labels, id_col, label_col)
    counted = dict(flagged.groupBy("label").count().collect())
    if len(set(classes)) == 2 and (counted.get(1, 0) > most_toxic or counted.get(0, 0) > most_clean):
        used = [sample["id"][i].as_py() for k, i in enumerate(order) if k % 5 != 4]
        _calibrate_on_all(model, _texts(docs, id_col, text_col, lang_col).join(broadcast_if_small(flagged), "id"), used)
    give_back()
    return model


def _calibrate_on_all(model: Model, rows: DataFrame, used: list[str]) -> None:
    """Calibrate on the rows (id, text, label, lang) whose ids were not used, by counts of logits per language and label.

    Languages without a threshold of their own are counted as one, so that what reaches the driver is bounded.
    """
    spark = rows.sparkSession
    shared, known_ids = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(frozenset(used))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = shared.value, known_ids.value
        tables, known = model.tables(), {}
        for batch in sliced(batches):
            free = [i not in seen for i in batch.column(0).to_pylist()]
            kept = batch.filter(pa.array(free))
            logits = _logits(kept.column(1).to_pylist(), model, tables, known)
            steps = np.full(batch.num_rows, LIMIT * STEPS * 2, np.int64)  # of rows that were used
            steps[np.array(free)] = np.round(np.clip(logits, -LIMIT, LIMIT) * STEPS)
            yield pa.RecordBatch.from_arrays([batch.column(3), batch.column(2), pa.array(free), pa.array(steps)], names=["lang", "label", "free", "step"])

    rows = rows.select(F.col("id").cast("string").alias("id"), "text", "label", "lang")
    counts = rows.mapInArrow(tidy(run), "lang string, label int, free boolean, step long").groupBy("lang", "label", "free", "step").count()
    counts = stored(counts, "logits")
    free, toxic = F.col("free"), F.col("label") == 1
    own = counts.where("free").groupBy("lang").agg(F.sum(F.when(toxic, F.col("count"))).alias("t"), F.sum(F.when(~toxic, F.col("count"))).alias("c"))
    own = own.where((F.col("t") >= LEAST) & (F.col("c") >= LEAST)).select("lang", F.col("lang").alias("own"))
    total = {r["label"]: r for r in counts.groupBy("label").agg(F.sum("count").alias("all"), F.sum(F.when(free, F.col("count"))).alias("free")).collect()}
    if len(total) < 2 or not all(r["free"] for r in total.values()):
        return
    found = counts.where("free").join(own, "lang", "left").groupBy(F.coalesce("own", F.lit("")).alias("lang"), "label", "step").agg(F.sum("count").alias("n")).toArrow()
    logits, labels = found["step"].to_numpy() / STEPS, found["label"].to_numpy().astype(float)
    _calibrate(model, logits, labels, found["lang"].to_pylist(), found["n"].to_numpy(), tuple(total[k]["all"] / total[k]["free"] for k in (0, 1)))


def _logits(texts: list[str | None], model: Model, tables: dict[int, list[np.ndarray]], known: dict[str, int]) -> np.ndarray:
    logits, docs, size = [np.empty(0)], [], 0
    for i, text in enumerate(texts):
        ids = np.array(buckets(text, known), np.int64) if text else np.empty(0, np.int64)
        docs.append(padded(model.row_of[ids]))
        size += len(ids)
        if size > 20_000 or i + 1 == len(texts):
            logits.append(model.logits(docs, tables).astype(float))
            docs, size = [], 0
    return np.concatenate(logits)


def with_scores(df: DataFrame, text_col: str, lang_col: str, model: Model) -> DataFrame:
    """All rows and columns, with `score` in 0 to 1 and `toxic_flag`, the score against the threshold of the row's language.

    Columns of these names are replaced. NULL and empty texts are scored as texts without words; NULL languages take the
    general threshold. No shuffle; a text is read whole, at any length.
    """
    rows = wrapped(df, text=F.col(text_col).cast("string"), lang=F.col(lang_col).cast("string"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        tables, known = model.tables(), {}
        for batch in sliced(batches):
            found = model.scores(_logits(batch.column(1).to_pylist(), model, tables, known))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.float64())], names=["row", "lang", "score"])

    scored = rows.mapInArrow(tidy(run), StructType([rows.schema["row"], rows.schema["lang"]]).add("score", DoubleType()))
    limit = F.lit(model.thresholds.get("", 0.7))
    for lang, value in sorted(model.thresholds.items()):
        if lang:
            limit = F.when(F.col("lang") == lang, F.lit(value)).otherwise(limit)
    return unwrapped(scored, df.columns, score=F.col("score"), toxic_flag=F.col("score") >= limit)
