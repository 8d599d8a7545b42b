"""Hilbert orderings and nearest neighbours against brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierlake.llm import curves

ROWS = "vec_id long, embedding array<float>, label int, rep string, rank string, score double"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0, "r", "k", 0.5) for i, v in rows], ROWS).repartition(parts)


def brute(rows, k, asks):
    ok = {(i, tuple(map(float, np.array(v, np.float32)))) for i, v in rows
          if i is not None and v and len(v) == 4 and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for i, v in ok:
        if asks(i):
            d = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for j, w in ok if j != i)[:k]
            out += [(i, n, j, s) for n, (s, j) in enumerate(d, 1)]
    return sorted(out)


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    key = curves.hilbert_key(cells, bits)
    assert sorted(key.tolist()) == list(range(len(cells)))
    walked = cells[np.argsort(key)]
    assert (np.abs(np.diff(walked, axis=0)).sum(axis=1) == 1).all()


def test_odd_rows_ties_and_copies(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(150)]
    rows += [(200 + i, [0.25, 0.5, 0.0, 1.0]) for i in range(300)]   # one vector with most of the rows
    rows += [(600, None), (601, []), (602, [0.0] * 4), (603, [1.0, None, 0.0, 0.0]), (604, [float("nan")] * 4),
             (605, [float("inf"), 0.0, 0.0, 1.0]), (606, [1.0, 2.0]), (None, [1.0] * 4), (607, [-0.0, 1.0, 2.0, 0.0]),
             (607, [0.0, 1.0, 2.0, 0.0]), (3, rows[3][1])]
    got = curves.nearest(frame(spark, rows), F.col("id") % 7 == 0, k=10).collect()
    want = brute(rows, 10, lambda i: i % 7 == 0)
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got)] == [w[:3] for w in want]
    assert np.allclose([r.score for r in sorted(got)], [w[3] for w in want], rtol=1e-12)


def test_recall_on_clusters_with_narrow_windows(spark):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(60, 16)) * 4
    x = (centre[rng.integers(0, 60, 6000)] + rng.normal(size=(6000, 16))).astype(np.float32)
    share = curves.fitted_share(x[:4000].astype(float), curves.Orderings(x[:4000].astype(float)), 10)
    assert share <= 0.25
    got = curves.nearest(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), F.col("id") % 50 == 0).collect()
    found = {(r.query_id, r.vec_id) for r in got}
    hits = 0
    for q in range(0, 6000, 50):
        d = ((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += sum((q, int(j)) in found for j in np.argsort(d)[:10])
    assert len(got) == 1200 and hits >= 0.9 * 1200


def test_few_and_no_rows(spark):
    cond = F.col("id") % 2 == 0
    assert curves.nearest(frame(spark, []), cond).collect() == []
    assert curves.nearest(frame(spark, [(0, [1.0, 2.0])], 1), cond).collect() == []
    two = curves.nearest(frame(spark, [(0, [1.0, 2.0]), (1, [1.0, 3.0])], 1), cond).collect()
    assert [tuple(r) for r in two] == [(0, 1, 1, 1.0)]
