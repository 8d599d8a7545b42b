"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes
log-count ratios.

1. Over all labelled training texts: in how many toxic and clean texts each
   hashed n-gram occurs. From these counts come the log-count ratios and the
   features kept (the ``FEATURES`` with the largest chi-square).
2. On a bounded sample of labelled rows (``SAMPLE``, the smallest hashes of
   doc_id): logistic regression on presence times ratio, with an L2 penalty.
3. Every whole text is scored by the n-grams it holds; no join, no shuffle.

Label, language, source and id are never inputs of a score.
"""

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import bounded_batches, room_for, spare, stored

SIZES = (3, 4, 5, 6, 7)  # characters per n-gram, of words set apart by one space
BITS = 20              # hashed n-grams
FEATURES = 4096
SAMPLE = 10_000        # labelled rows that the regression sees at most (SAMPLE x FEATURES floats on the driver)
SMOOTH = 1.0           # added to both counts of an n-gram
PENALTY = 2e-4
ROUNDS = 300
THRESHOLD = 0.7
LABELS_BROADCAST = 1_000_000  # label rows (two small numbers each) sent to all tasks at most

_P = np.uint64(0x9E3779B97F4A7C15)


def buckets(text: str | None) -> np.ndarray:
    """Hashed n-grams at every position of the lower-cased text, repeats included."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.int64)
    c = np.frombuffer(" ".join(["", *words, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out = []
    h = c + np.uint64(1)
    for n in range(2, max(SIZES) + 1):
        if len(c) < n:
            break
        h = (h[:-1] * _P) ^ (c[n - 1:] + np.uint64(n))
        if n in SIZES:
            out.append(((h * _P) >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out) if out else np.empty(0, np.int64)


class Model:
    """Places of the kept n-grams and their weights (ratio times coefficient)."""

    def __init__(self, kept: np.ndarray, weight: np.ndarray, bias: float):
        self.place = np.full(1 << BITS, -1, np.int16)
        self.place[kept] = np.arange(len(kept), dtype=np.int16)
        self.weight, self.bias = weight, bias

    def present(self, text: str | None) -> np.ndarray:
        """Kept n-grams that occur in the text, each once."""
        at = self.place[buckets(text)]
        return np.unique(at[at >= 0])

    def score(self, text: str | None) -> float:
        if self.bias == -np.inf:  # nothing was learnt
            return 0.0
        return float(1.0 / (1.0 + np.exp(-np.clip(self.bias + self.weight[self.present(text)].sum(), -500, 500))))


def held_out(key: Column) -> Column:
    return (F.crc32(key.cast("string")) % 3 == 1)


def training_labels(labels: DataFrame, key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """(k, y) of the rows labels may be learnt from; a repeated id is toxic if any of its rows is."""
    return (labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
            .groupBy(F.col(key).alias("k")).agg(F.max(F.col(label)).cast("int").alias("y")))


def _labelled(docs, labels, key, text):
    y = stored(training_labels(labels), "toxicity-labels")
    if y.count() <= LABELS_BROADCAST:
        return y, docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(y), "k")
    return y, docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(y, "k")


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Train on the labelled texts; without both classes the score is the constant 0."""
    bounded_batches(docs.sparkSession)
    y, texts = _labelled(docs, labels, key, text)

    def count(batches):
        n = np.zeros((2, 1 << BITS), np.int64)
        rows = [0, 0]
        for batch in batches:
            for label, t in zip(batch.column("y").to_pylist(), batch.column("t")):
                n[label, np.unique(buckets(t.as_py()))] += 1
                rows[label] += 1
        at = np.flatnonzero(n.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((at, [-1]))), pa.array(np.concatenate((n[0, at], [rows[0]]))),
             pa.array(np.concatenate((n[1, at], [rows[1]])))], ["g", "clean", "toxic"])

    counted = stored(texts.select("t", "y").mapInArrow(count, "g long, clean long, toxic long")
                     .groupBy("g").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxicity-counts")
    rows = counted.where("g = -1").first()
    clean, toxic = (rows.clean, rows.toxic) if rows else (0, 0)
    if not clean or not toxic:
        return Model(np.empty(0, np.int64), np.empty(0), -np.inf)
    a, b = F.col("toxic"), F.col("clean")
    n, seen = F.lit(float(clean + toxic)), a + b
    odds = n * F.pow(a * (clean - b) - b * (toxic - a), F.lit(2.0)) / (seen * (n - seen + 1e-9) * toxic * clean)
    best = (counted.where("g >= 0").select("g", "clean", "toxic", odds.alias("chi2"))
            .orderBy(F.desc("chi2"), "g").limit(FEATURES).collect())  # bounded by FEATURES
    kept = np.array([r.g for r in best], np.int64)
    p, q = (np.array([r[c] for r in best], float) + SMOOTH for c in ("toxic", "clean"))
    ratio = np.log(p / (toxic + 2 * SMOOTH)) - np.log(q / (clean + 2 * SMOOTH))

    chosen = y.orderBy(F.xxhash64("k"), "k").limit(SAMPLE).select("k")
    empty = cloudpickle.dumps(Model(kept, np.zeros(len(kept)), 0.0))

    def rows_of(batches):
        model = pickle.loads(empty)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array([model.present(t.as_py()) for t in batch.column("t")],
                                             pa.list_(pa.int16()))], ["y", "x"])

    sample = texts.join(F.broadcast(chosen), "k", "left_semi").orderBy(F.xxhash64("k"), "k", F.xxhash64("t")) \
        .limit(SAMPLE).select("t", "y").mapInArrow(rows_of, "y int, x array<smallint>")
    weight, bias = regress(sample.toPandas(), ratio)  # at most SAMPLE rows of at most FEATURES numbers
    return Model(kept, weight, bias)


def regress(rows: pd.DataFrame, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights by accelerated gradient steps from zero (fixed number, no randomness)."""
    y = rows["y"].to_numpy(np.float32)
    n = len(rows)
    x = np.zeros((n, len(ratio)), np.float32)
    for i, at in enumerate(rows["x"]):
        x[i, np.asarray(at, np.int64)] = 1.0
    x *= ratio.astype(np.float32)
    # the mean loss bends at most by a quarter of the largest eigenvalue of x'x / n
    v = np.ones(len(ratio), np.float32)
    for _ in range(20):
        v /= np.linalg.norm(v) + 1e-12
        v = x.T @ (x @ v) / n
    step = 1.0 / (0.3 * float(np.linalg.norm(v)) + PENALTY + 1e-6)
    share = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
    w, b = np.zeros(len(ratio), np.float32), float(np.log(share / (1 - share)))
    vw, vb, pw, pb = w, b, w, b
    for k in range(ROUNDS):
        g = 1.0 / (1.0 + np.exp(-np.clip(x @ vw + vb, -80, 80))) - y
        w, b = vw - step * (x.T @ g / n + PENALTY * vw), vb - step * float(g.mean())
        turn = k / (k + 3.0)
        vw, vb = w + turn * (w - pw), b + turn * (b - pb)
        pw, pb = w, b
    return w.astype(float) * ratio, float(b)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add the score (0 to 1) of every whole text; null and empty texts have the bias alone.

    A column of the input named like ``out`` is kept with a leading underscore.
    """
    bounded_batches(docs.sparkSession)
    docs, text = room_for(docs, [out], text)
    sent = cloudpickle.dumps(model)

    def run(batches):
        own = pickle.loads(sent)
        for texts in batches:
            yield pd.Series([own.score(t) for t in texts], dtype=float)

    return docs.withColumn(out, F.pandas_udf(run, "double", F.PandasUDFType.SCALAR_ITER)(F.col(text)))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs -> (doc_id, held_out, score, predicted), one row per input row.

    A null key is not held out and has no label. Repeated rows get equal
    scores. Without labels of both classes every score is 0. An empty table
    gives an empty result. Other columns are not read.
    """
    t = spare(docs, "t")
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias(t))
    scored = score(own, fit(docs, labels, key, text), t)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
