"""Approximate nearest neighbours on shifted space-filling curves.

1. Equal vectors collapse into one, with the smallest ``k + 1`` ids of each: no
   list of neighbours needs more of them, whatever share of the table is equal.
2. ``CURVES`` Hilbert orderings: each projects the vectors by its own rotation
   to ``DIMS`` dimensions, brings every dimension to even cells (quantiles of the
   sample), shifts the grid and takes the Hilbert key. Spark orders each curve by
   ranges of the key and numbers its rows.
3. A query looks at a window of every curve, centred on its own place. The
   curves are stored in chunks; a task holds one chunk and streams the queries
   whose windows touch it, keeping ``KEEP`` candidates of each by the distances
   between 16-bit codes.
4. A query's candidates of all windows are merged and ranked by the distance
   of the original vectors, in double precision.

The windows' share of a curve is fitted: on a sample of at most ``SAMPLE``
distinct vectors, the smallest share whose merged windows hold ``TARGET`` of the
true neighbours. Neighbours come nearer as a table grows, so the share found
on the sample holds for the whole. Clustered vectors need small windows; vectors
without any structure need a good part of each curve, and the work then grows
with queries x rows.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import bounded_batches, in_order, stored

CURVES, DIMS, BITS = 4, 8, 7
SEED = 7919
SAMPLE = 8192            # distinct vectors the cells and the share are fitted on
TARGET = 0.96            # share of true neighbours asked for on the sample
SHARES = (0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.16, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.8, 1.0)
LEAST_WINDOW = 256       # rows on either side at least
KEEP = 48                # candidates a window hands on for the exact ranking, at least 4 * k
CELLS = 4_000_000        # numbers a task holds of one chunk, and of one block of distances


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cells (each below 2**bits) on the Hilbert curve.

    The coordinates are turned into the curve's transposed form, one bit plane
    after another, and the planes are interleaved.
    """
    x = np.asarray(cells, np.uint64).T.copy()
    k = len(x)
    for b in range(bits - 1, 0, -1):
        plane, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(k):
            up = (x[i] & plane) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, k):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(b)) & np.uint64(1), np.uint64((1 << b) - 1), np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(k):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return key.astype(np.int64)


class Orderings:
    """Rotations, cells and shifts of all curves, fitted on a sample."""

    def __init__(self, sample: np.ndarray, curves: int = CURVES, dims: int = DIMS, bits: int = BITS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        d = sample.shape[1]
        self.bits, self.turns, self.borders, self.shifts = bits, [], [], []
        for _ in range(curves):
            turn = np.linalg.qr(rng.normal(size=(d, d)))[0][:, :min(dims, d)]
            at = np.linspace(0, 1, 1 << (bits - 1), endpoint=False)[1:]
            self.turns.append(turn)
            self.borders.append(np.quantile(sample @ turn, at, axis=0))
            self.shifts.append(rng.integers(0, 1 << (bits - 1), turn.shape[1]))

    def keys(self, vectors: np.ndarray) -> list[np.ndarray]:
        out = []
        for turn, borders, shift in zip(self.turns, self.borders, self.shifts):
            y = vectors @ turn
            cells = np.stack([np.searchsorted(borders[:, i], y[:, i], side="right") for i in range(y.shape[1])], axis=1)
            out.append(hilbert_key(cells + shift, self.bits))
        return out


def fitted_share(sample: np.ndarray, orderings: Orderings, k: int, target: float = TARGET, queries: int = 512) -> float:
    """The smallest window share that finds ``target`` of the k nearest within the sample."""
    n = len(sample)
    if n <= k + 1:
        return 1.0
    asked = np.linspace(0, n - 1, min(queries, n)).astype(np.int64)
    near = []
    square = (sample ** 2).sum(axis=1)
    for at in range(0, len(asked), 64):
        q = asked[at:at + 64]
        d = square[None, :] - 2 * sample[q] @ sample.T
        d[np.arange(len(q)), q] = np.inf
        near.append(np.argpartition(d, k, axis=1)[:, :k])
    near = np.concatenate(near)
    ranks = []
    for key in orderings.keys(sample):
        rank = np.empty(n, np.int64)
        rank[np.argsort(key, kind="stable")] = np.arange(n)
        ranks.append(rank)
    for share in SHARES:
        w = share * n / 2
        seen = np.zeros(near.shape, bool)
        for rank in ranks:
            seen |= np.abs(rank[near] - np.clip(rank[asked], w, max(w, n - 1 - w))[:, None]) <= w
        if seen.mean() >= target:
            return share
    return 1.0


def vectors_of(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, dim, mark, vec): rows with an id and a vector of finite numbers, not all 0.

    ``vec`` holds the numbers as they are, 32-bit or 64-bit; ``mark`` is a 128-bit hash of them.
    """
    bounded_batches(df.sparkSession)
    item = df.schema[vector].dataType.elementType.typeName()
    kind = "<f4" if item == "float" else "<f8"
    own = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast(f"array<{'float' if kind == '<f4' else 'double'}>").alias("v"))

    def run(batches):
        for batch in batches:
            rows = []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not len(v.values) or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(kind) + 0.0  # -0 becomes 0
                if np.isfinite(x).all() and x.any():
                    raw = x.astype(kind).tobytes()
                    rows.append((i, len(x), xxhash.xxh3_128_digest(raw), raw))
            c = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(c, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], ["id", "dim", "mark", "vec"])

    return own.mapInArrow(run, "id long, dim int, mark binary, vec binary")


def nearest(df: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
            target: float = TARGET) -> DataFrame:
    """The k nearest rows found of every query row: (query_id, rank, vec_id, score).

    ``is_query`` is a condition on the column ``id``; all rows but the query's own id are
    candidates. score: Euclidean distance, nearest first, ties to the smaller id.
    Rows without id, and vectors null, empty, zero or with null or non-finite
    numbers take no part; nor do vectors of another length than the most common
    one. Repeated rows count once; an id given to several vectors stands for each.
    Fewer candidates than k give fewer rows, no candidate or an empty table none.
    """
    item = df.schema[vector].dataType.elementType.typeName()
    kind = "<f4" if item == "float" else "<f8"
    rows = stored(vectors_of(df, key, vector), "curves-vectors")
    most = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = most["dim"]
    rows = rows.where(F.col("dim") == dim)
    distinct = stored(rows.groupBy("mark").agg(F.min("id").alias("rep"), F.max(is_query).alias("asks"),
                                               F.first("vec").alias("vec")), "curves-distinct")
    n = distinct.count()
    drawn = distinct.select("rep", "vec").orderBy(F.xxhash64("rep", F.lit(SEED)), "rep").limit(SAMPLE).select("vec").collect()
    sample = np.stack([np.frombuffer(r["vec"], kind).astype(np.float64) for r in drawn])
    orderings = Orderings(sample)
    half = max(LEAST_WINDOW, int(np.ceil(fitted_share(sample, orderings, k, target) * n / 2)))
    found = _candidates(_placed(distinct, orderings, kind), n, half, dim, max(KEEP, 4 * k))

    # members of equal vectors: the smallest k + 1 ids say all that a list of k can show
    ids = rows.select("mark", "id").distinct()
    few = ids.withColumn("nth", F.row_number().over(Window.partitionBy("mark").orderBy("id"))).where(F.col("nth") <= k + 1)
    members = few.groupBy("mark").agg(F.array_sort(F.collect_list("id")).alias("ids")).join(
        distinct.select("mark", "rep"), "mark").select(F.col("rep").alias("near"), "ids")
    exact = stored(_exact(found, distinct, kind), "curves-exact")
    each = exact.join(members, "near").select("rep", "score", F.explode("ids").alias("vec_id"))
    first = each.withColumn("nth", F.row_number().over(Window.partitionBy("rep").orderBy("score", "vec_id"))).where(
        F.col("nth") <= k + 1)
    lists = first.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    asked = ids.where(is_query).join(distinct.select("mark", "rep"), "mark").join(lists, "rep")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("id")), 1, k)
    return asked.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


def _placed(distinct: DataFrame, orderings: Orderings, kind: str) -> DataFrame:
    """(curve, place from 0, rep, asks, code, scale) for every vector on every curve."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([np.frombuffer(v, kind) for v in batch.column(2).to_pylist()]).astype(np.float64)
            scale = np.abs(x).max(axis=1) / 32767
            code = np.rint(x / scale[:, None]).astype("<i2")
            packed = pa.array([c.tobytes() for c in code], pa.binary())
            for c, keys in enumerate(orderings.keys(x)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), c, np.int32)), pa.array(keys), batch.column(0), batch.column(1), packed,
                     pa.array(scale)], ["curve", "key", "rep", "asks", "code", "scale"])

    placed = distinct.select("rep", "asks", "vec").mapInArrow(
        run, "curve int, key long, rep long, asks boolean, code binary, scale double")
    return in_order(placed, "curve", ["key", "rep"]).select(
        "curve", (F.col("nth") - 1).alias("place"), "rep", "asks", "code", "scale")


def _candidates(placed: DataFrame, n: int, half: int, dim: int, keep: int) -> DataFrame:
    """(rep, near): the ``keep`` vectors nearest by code in the windows around every asking one."""
    size = max(1, min(half // 2, CELLS // dim))
    middle = F.greatest(F.lit(half), F.least("place", F.lit(n - 1 - half)))  # windows at the ends stay whole
    chunk = F.explode(F.sequence(F.floor(F.greatest(middle - half, F.lit(0)) / size),
                                 F.floor(F.least(middle + half, F.lit(n - 1)) / size)))
    held = placed.select("curve", F.floor(F.col("place") / size).alias("chunk"), F.lit(0).alias("turn"), "rep", "code", "scale")
    asking = placed.where("asks").select("curve", chunk.alias("chunk"), F.lit(1).alias("turn"), "rep", "code", "scale")

    def unpack(batch):
        code = np.stack([np.frombuffer(c, "<i2") for c in batch.column("code").to_pylist()]).astype(np.float32)
        return code * batch.column("scale").to_numpy().astype(np.float32)[:, None]

    def scan(batches):
        """Per chunk, first its vectors, then the queries that look at it."""
        at, parts, ids, x, square = None, [], [], None, None
        for whole in batches:
            if not whole.num_rows:
                continue
            curve, chunk, turn = (whole.column(c).to_numpy() for c in ("curve", "chunk", "turn"))
            edge = np.flatnonzero((np.diff(curve) != 0) | (np.diff(chunk) != 0) | (np.diff(turn) != 0)) + 1
            for s, e in zip([0, *edge.tolist()], [*edge.tolist(), len(turn)]):
                batch = whole.slice(s, e - s)
                own = batch.column("rep").to_numpy()
                if (curve[s], chunk[s]) != at:
                    at, parts, ids, x = (curve[s], chunk[s]), [], [], None
                if turn[s] == 0:
                    parts.append(unpack(batch))
                    ids.append(own)
                    continue
                if x is None:
                    x, ids, parts = np.concatenate(parts), np.concatenate(ids), []
                    square = (x ** 2).sum(axis=1)
                q = unpack(batch)
                step = max(1, CELLS // len(x))
                for b in range(0, len(q), step):
                    d = (q[b:b + step] ** 2).sum(axis=1)[:, None] + square[None, :] - 2 * q[b:b + step] @ x.T
                    m = min(keep, len(x))
                    best = np.argpartition(d, m - 1, axis=1)[:, :m]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[b:b + step]), _lists(ids[best], pa.int64()),
                         _lists(np.take_along_axis(d, best, axis=1), pa.float32())], ["rep", "near", "d"])

    per_chunk = (held.union(asking).repartition("curve", "chunk").sortWithinPartitions("curve", "chunk", "turn")
                 .mapInArrow(scan, "rep long, near array<long>, d array<float>"))

    def merge(batches):
        at, near, d = None, [], []

        def best():
            ids, dist = np.concatenate(near), np.concatenate(d)
            order = np.argsort(dist, kind="stable")
            _, first = np.unique(ids[order], return_index=True)
            mine = ids[order[np.sort(first)[:keep]]]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(mine), at)), pa.array(mine)], ["rep", "near"])

        for batch in batches:
            for rep, ids, dist in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if rep != at:
                    if near:
                        yield best()
                    at, near, d = rep, [], []
                near.append(ids.values.to_numpy())
                d.append(dist.values.to_numpy())
        if near:
            yield best()

    return per_chunk.repartition("rep").sortWithinPartitions("rep").mapInArrow(merge, "rep long, near long")


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind))


def _exact(found: DataFrame, distinct: DataFrame, kind: str) -> DataFrame:
    """(rep, near) -> (rep, near, score): the distance of the original vectors."""
    vec = distinct.select(F.col("rep").alias("near"), "vec")
    rows = found.join(vec, "near").select("rep", F.lit(1).alias("turn"), "near", "vec").union(
        distinct.where("asks").select("rep", F.lit(0).alias("turn"), F.col("rep").alias("near"), "vec"))

    def run(batches):
        own = None
        for batch in batches:
            out = []
            for rep, turn, near, vec in zip(*(c.to_pylist() for c in batch.columns)):
                x = np.frombuffer(vec, kind).astype(np.float64)
                if turn == 0:
                    own = x
                else:
                    out.append((rep, near, float(np.sqrt(((x - own) ** 2).sum()))))
            c = list(zip(*out)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(c, (pa.int64(), pa.int64(), pa.float64()))], ["rep", "near", "score"])

    return (rows.repartition("rep").sortWithinPartitions("rep", "turn")
            .mapInArrow(run, "rep long, near long, score double"))
