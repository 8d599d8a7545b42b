"""Benchmark decontamination: n-gram seeds, then Smith-Waterman.

Every 3-gram of a test item is a seed, however many documents hold it, so an
item that leaked a thousand times is found in all of them. Every stretch of a
document around a seed is aligned with the item's words; the score is that of
the best local alignment as a share of the item's length. A stretch is passed
over only where its words cannot reach the least score (see ``reachable``).

The test items are a stated query set. They travel to the tasks in blocks of at
most ``BLOCK_BYTES`` of text; more items mean more passes, never fewer items.
"""

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import bounded_batches
from tierlake.llm.ngram_index import Codes, Places, windows, words

N = 3                      # words per seed
MATCH, MISMATCH, GAP = 1, -1, -1
MIN_SCORE = 0.5            # of the item's words
BLOCK_BYTES = 16 << 20


def _row(item_word: int, text: np.ndarray, above: np.ndarray, slope: np.ndarray) -> np.ndarray:
    """Scores of one item word from those of the word before; the gap along the
    text is a running maximum, so a row is a handful of array operations."""
    pair = np.where((text == item_word) & (text >= 0), MATCH, MISMATCH)
    best = np.maximum(np.maximum(above[:-1] + pair, above[1:] + GAP), 0)
    out = np.zeros_like(above)
    out[1:] = np.maximum.accumulate(best + slope) - slope
    return out


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int, int, int, int]:
    """Best local alignment: (score, item start, item end, text start, text end, matches).

    Ties: the earliest end. Every ``step``-th row is kept, step about the root of
    the item's length; the way back computes the rows between two kept ones
    again. So memory is 2 * sqrt(item) * text scores, not item * text.
    """
    m, n = len(item), len(text)
    step = int(m ** 0.5) + 1
    slope = (-GAP * np.arange(1, n + 1)).astype(np.int32)
    row = np.zeros(n + 1, np.int32)
    kept, score, end_i, end_j = [row], 0, 0, 0
    for i in range(1, m + 1):
        row = _row(item[i - 1], text, row, slope)
        if row.max(initial=0) > score:
            end_j = int(row.argmax())
            score, end_i = int(row[end_j]), i
        if i % step == 0:
            kept.append(row)
    i, j, hit = end_i, end_j, 0
    rows, base = [], end_i + 1  # rows base, base + 1, ... up to the one after which nothing is needed
    while i > 0 and j > 0:
        if i - 1 < base:  # the block of rows that holds i - 1 and i
            base = (i - 1) // step * step
            rows = [kept[base // step]]
            for k in range(base, i):
                rows.append(_row(item[k], text, rows[-1], slope))
        own, above = rows[i - base], rows[i - 1 - base]
        if own[j] <= 0:
            break
        same = text[j - 1] >= 0 and text[j - 1] == item[i - 1]
        if own[j] == above[j - 1] + (MATCH if same else MISMATCH):
            hit += int(same)
            i, j = i - 1, j - 1
        elif own[j] == above[j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, i, end_i, j, end_j, hit


def reachable(item: np.ndarray, text: np.ndarray, least: float) -> bool:
    """Whether an alignment of ``text`` may score ``least``; False is proven.

    A score of ``least`` takes that many matches, each item word as often as the
    item has it, and at most len(item) - least edits: it lies in a stretch of at
    most 2 * len(item) - least words.
    """
    own, many = np.unique(item, return_counts=True)
    at = np.minimum(np.searchsorted(own, text), len(own) - 1)
    mine = own[at] == text
    if np.minimum(np.bincount(at[mine], minlength=len(own)), many).sum() < least:
        return False
    span = max(1, int(2 * len(item) - least))
    total = np.concatenate(([0], np.cumsum(mine)))
    return bool((total[min(span, len(text)):] - total[:len(total) - min(span, len(text))]).max() >= least)


class Items:
    """One block of test items with its 3-gram index."""

    def __init__(self, rows: list[tuple[int, str]], n: int = N):
        kept = [(i, w) for i, w in ((i, words(t)) for i, t in rows) if len(w) >= n]
        self.ids = [i for i, _ in kept]
        self.n = n
        self.codes = Codes([w for _, w in kept])
        self.words = [self.codes.encode(w) for _, w in kept]
        grams = [self.codes.grams(w, n) for w in self.words]
        self.places = Places(
            np.concatenate([np.empty(0, np.int64), *grams]),
            np.repeat(np.arange(len(kept)), [len(g) for g in grams]).astype(np.int64),
            np.concatenate([np.empty(0, np.int64), *[np.arange(len(g)) for g in grams]]).astype(np.int64))

    def leaks(self, text: str, min_score: float) -> list[tuple]:
        """(item id, score, text start, text end, item start, item end, matches), best per item."""
        ws = words(text)
        codes = self.codes.encode(ws)
        at, passage, position = self.places.hits(self.codes.grams(codes, self.n))
        out = []
        for p in np.unique(passage).tolist():
            mine = passage == p
            item = self.words[p]
            best = (0,)
            for lo, hi, _ in windows(at[mine], position[mine], len(item), len(ws)):
                if not reachable(item, codes[lo:hi], min_score * len(item)):
                    continue
                score, i, ie, j, je, hit = smith_waterman(item, codes[lo:hi])
                if score > best[0]:
                    best = (score, lo + j, lo + je, i, ie, hit)
            if best[0] and best[0] >= min_score * len(item):
                out.append((self.ids[p], best[0] / len(item), *best[1:]))
        return out


def _blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[Items]:
    """Items in blocks of bounded size, by a hash of their id; one is held at a time."""
    bounded_batches(benchmark.sparkSession)
    rows = benchmark.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("i"), F.col(text).alias("t"))
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = int(size // BLOCK_BYTES) + 1
    for b in range(n):
        yield Items(sorted({(r.i, r.t) for r in rows.where(F.pmod(F.xxhash64("i"), F.lit(n)) == b).collect()}))


def _sent(docs: DataFrame, items: Items):
    """The block, broadcast by value: executors need no copy of this package."""
    return docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(items))


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item_key: str = "item_id", item_text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, item_id) pairs whose best alignment scores ``min_score`` or more
    of the item's words, with score, word spans and matches.

    Whole texts are searched. Rows with a null key or text and items under
    three words or with a null id give no row; repeated rows give repeated
    pairs only if the document row is repeated. Case and punctuation are
    ignored. Of equal alignments the earliest is reported. An empty table on
    either side gives an empty result; other columns are not read.
    """
    out = None
    for items in _blocks(benchmark, item_key, item_text):
        block = _sent(docs, items)
        part = docs.select(F.col(key).cast("long").alias("d"), F.col(text).alias("t")).where(
            "d is not null and t is not null").mapInArrow(
            _search(block, min_score), "doc_id long, item_id long, score double, doc_start long, doc_end long, item_start long, "
                                       "item_end long, matches long")
        out = part if out is None else out.union(part)
    return out


def _search(block, min_score: float):
    names = ["doc_id", "item_id", "score", "doc_start", "doc_end", "item_start", "item_end", "matches"]

    def search(batches):
        found = pickle.loads(block.value)
        for batch in batches:
            rows = [(d, *leak) for d, t in zip(batch.column("d").to_pylist(), batch.column("t"))
                    for leak in found.leaks(t.as_py(), min_score)]
            cols = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.float64() if n == "score" else pa.int64()) for n, c in zip(names, cols)], names)

    return search


def drop_leaked(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
                item_text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the rows that hold a leaked item; no shuffle, no join."""
    for items in _blocks(benchmark, item_key, item_text):
        block = _sent(docs, items)

        docs = docs.where(~_leaked(block, min_score)(F.col(text)))
    return docs


def _leaked(block, min_score: float):
    def leaked(batches):
        found = pickle.loads(block.value)
        for texts in batches:
            yield pd.Series([t is not None and bool(found.leaks(t, min_score)) for t in texts], dtype=bool)

    return F.pandas_udf(leaked, "boolean", F.PandasUDFType.SCALAR_ITER)
