"""SimHash near-duplicates through a Gray-order hierarchical index.

1. Every whole text gets a 64-bit fingerprint (words, 3-word shingles, XXH64).
2. Equal fingerprints collapse into one before anything is compared.
3. Distinct fingerprints are dealt by parts of blocks: of ``max_bits + k``
   blocks, two fingerprints within ``max_bits`` agree on at least ``k``, so every
   link meets in a bucket keyed by bits of those blocks. The number of key bits
   follows the number of fingerprints, so a bucket holds about ``BUCKET`` of them
   at any size: enough that its index, not the dealing, decides on the links.
4. In a bucket, fingerprints are sorted by Gray rank; runs of neighbours form
   leaves, runs of leaves form upper nodes. A node keeps the bits that all its
   members share, without those already kept by its parent; a search adds up
   the differences on the way down and drops a group once they exceed
   ``max_bits``.
5. A bucket beyond ``split_rows`` is cut at leaf borders into segments of its
   Gray order; pairs of segments are compared by separate tasks, unless the
   bits their members share already differ too much.
6. A task returns a spanning forest of the links it found, never all pairs.
"""

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.common import bounded_batches, connected_components, drop_stored, spare, stored

SEED = 42     # fixed value of the fingerprint contract
BUCKET = 256  # fingerprints in a mean bucket
FAN = 3       # members of a node: few, so that they share many bits and differences add up early


def fingerprint_bytes(raw: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of one UTF-8 text (0 when it has no word)."""
    words = raw.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return digest(joined, SEED)
    lens = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    count = n - shingle + 1
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:count].tolist(), ends[shingle - 1:].tolist())],
                 np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 1 << 15):  # bounded memory for very long texts
        bits = np.unpackbits(h[at:at + (1 << 15)].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int32)
    on = np.flatnonzero(2 * ones > count)
    return int(np.bitwise_or.reduce(np.uint64(1) << on.astype(np.uint64))) if len(on) else 0


def fingerprints(df: DataFrame, text: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """Add the fingerprint as a signed long (same 64 bits). Null text: 0."""
    bounded_batches(df.sparkSession)

    @F.pandas_udf(T.LongType())
    def fp(col: pd.Series) -> pd.Series:
        v = np.fromiter((fingerprint_bytes(t.encode("utf-8", "surrogatepass") if t is not None else b"", shingle)
                         for t in col), np.uint64, len(col))
        return pd.Series(v.view(np.int64))

    return df.withColumn(out, fp(F.col(text)))


# ---------------------------------------------------------------- the index

def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each 64-bit code in the reflected Gray sequence."""
    r = fp.astype(np.uint64).copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def build_index(sorted_fp: np.ndarray, fan: int = FAN) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from leaves up to at most ``fan`` roots: (pattern, residual mask).

    Level 0 are the fingerprints. A node's mask holds the bits on which all its
    members agree, less the bits its parent already holds.
    """
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    levels = [(sorted_fp, np.full(len(sorted_fp), full, np.uint64))]
    while len(levels[-1][0]) > fan:
        pat, mask = levels[-1]
        at = np.arange(0, len(pat), fan)
        both = np.bitwise_and.reduceat(mask, at)
        one = np.bitwise_and.reduceat(pat | ~mask, at)     # 1 in every child
        none = np.bitwise_and.reduceat(~pat | ~mask, at)   # 0 in every child
        shared = both & (one | none)
        levels.append((one & shared, shared))
    out = []
    for k, (pat, mask) in enumerate(levels):
        if k + 1 < len(levels):
            up = levels[k + 1][1][np.arange(len(pat)) // fan]
            mask = mask & ~up
        out.append((pat, mask))
    return out


def search(levels: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray, max_bits: int,
           fan: int = FAN) -> tuple[np.ndarray, np.ndarray]:
    """All (query row, member row) within ``max_bits``, by accumulated differences."""
    top_pat, top_mask = levels[-1]
    d = np.bitwise_count((queries[:, None] ^ top_pat[None, :]) & top_mask[None, :])
    q, node = np.nonzero(d <= max_bits)
    acc = d[q, node].astype(np.uint8)
    for pat, mask in reversed(levels[:-1]):
        first = node * fan
        width = np.minimum(fan, len(pat) - first)
        total = int(width.sum())
        rep = np.repeat(np.arange(len(node)), width)
        off = np.arange(total) - np.repeat(np.cumsum(width) - width, width)
        child = first[rep] + off
        qq = q[rep]
        dist = acc[rep] + np.bitwise_count((queries[qq] ^ pat[child]) & mask[child]).astype(np.uint8)
        keep = dist <= max_bits
        q, node, acc = qq[keep], child[keep], dist[keep]
    return q, node


class Forest:
    """Union-find that keeps only links joining two different sets."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        ra, rb = self.root(a), self.root(b)
        if ra == rb:
            return False
        self.up[max(ra, rb)] = min(ra, rb)
        return True


def spanning_links(left: np.ndarray, right: np.ndarray | None, max_bits: int,
                   most: int = 1 << 17) -> list[tuple[int, int]]:
    """Spanning forest of the links inside ``left`` or between it and ``right``.

    Both are distinct fingerprints in Gray order. Queries go in blocks, so that
    no more than ``most`` pairs are held at once, even where all are links.
    """
    base = left if right is None else right
    block = max(1, most // max(1, len(base)))
    levels = build_index(base)
    forest = Forest(len(left) + (0 if right is None else len(right)))
    links = []
    shift = 0 if right is None else len(left)
    for at in range(0, len(left), block):
        q, m = search(levels, left[at:at + block], max_bits)
        q = q + at
        if right is None:
            keep = q < m
            q, m = q[keep], m[keep]
        for a, b in zip(q.tolist(), m.tolist()):
            if forest.join(a, b + shift):
                links.append((int(left[a]), int(base[b])))
    return links


# ------------------------------------------------------------ the operator

def block_masks(max_bits: int, key_bits: int) -> list[int]:
    """Masks of about ``key_bits`` bits: two codes within ``max_bits`` agree on one at least.

    Of ``max_bits + k`` equal blocks at least k are the same in both. k is the
    least number whose blocks hold the bits asked for, three at most; of every
    block only the bits needed are taken.
    """
    for k in (1, 2, 3):
        n = max_bits + k
        if n > 64:
            return [0]  # no block is sure to agree: one bucket
        if k * (64 // n) >= key_bits:
            break
    take = min(64 // n, -(-key_bits // k))
    blocks = [((1 << take) - 1) << (64 * i // n) for i in range(n)]
    return [0] if not take else [sum(c) for c in combinations(blocks, k)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links_between(distinct: DataFrame, max_bits: int, split_rows: int = 2048, bucket: int = BUCKET) -> DataFrame:
    """Distinct fingerprints (column fp) -> spanning links (src, dst)."""
    bounded_batches(distinct.sparkSession)
    masks = block_masks(max_bits, (distinct.count() // bucket).bit_length())
    dealt = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for i, m in enumerate(masks)])).alias("b")).select("fp", "b.part", "b.key")
    sizes = dealt.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = stored(dealt.join(sizes, ["part", "key"]), "simhash-buckets")

    schema = T.StructType([T.StructField("src", T.LongType()), T.StructField("dst", T.LongType())])

    def emit(links):
        a = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["src", "dst"])

    def small_buckets(batches):
        """Rows arrive sorted by (part, key): one bucket after another."""
        held = None
        for batch in batches:
            part = batch.column("part").to_numpy().astype(np.int64)
            key = batch.column("key").to_numpy()
            fp = batch.column("fp").to_numpy().view(np.uint64)
            if held is not None:
                part, key, fp = (np.concatenate(x) for x in zip(held, (part, key, fp)))
            if not len(part):
                continue
            new = np.flatnonzero((np.diff(part) != 0) | (np.diff(key) != 0)) + 1
            last = int(new[-1]) if len(new) else 0
            held = (part[last:], key[last:], fp[last:])  # may go on in the next batch
            yield from close(fp[:last], new[:-1])
        if held is not None:
            yield from close(held[2], np.array([], np.int64))

    def close(fp, cuts):
        links = []
        edges = [0, *cuts.tolist(), len(fp)]
        width = np.diff(edges)
        starts = np.array(edges[:-1])
        two = starts[width == 2]  # most buckets: one comparison, all at once
        if len(two):
            near = np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits
            links.extend(zip(fp[two][near].tolist(), fp[two + 1][near].tolist()))
        for s, w in zip(starts[width > 2].tolist(), width[width > 2].tolist()):
            group = fp[s:s + w]
            links.extend(spanning_links(group[np.argsort(gray_rank(group))], None, max_bits))
        if links:
            yield emit(links)

    few = (rows.where(F.col("n") <= split_rows).select("part", "key", "fp")
           .repartition("part", "key").sortWithinPartitions("part", "key")
           .mapInArrow(small_buckets, schema))
    return few.union(_hot_links(rows.where(F.col("n") > split_rows), max_bits, split_rows, schema, emit))


def _hot_links(rows: DataFrame, max_bits: int, split_rows: int, schema, emit) -> DataFrame:
    """Links of buckets beyond ``split_rows``: pairs of Gray-order segments.

    Segments are prefix ranges of the Gray rank (64 equal ranges of a bucket's
    rank span, cut again until small), so no task sorts a whole bucket.
    """
    rank = F.col("fp")
    for s in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, s))
    rows = rows.withColumn("gray", rank.bitwiseXOR(F.lit(_signed(1 << 63))))  # signed order
    ranged = stored(rows.select("part", "key", "fp", "gray")
                    .repartitionByRange("part", "key", "gray")
                    .sortWithinPartitions("part", "key", "gray"), "simhash-hot")

    def cut(batches):
        """Consecutive rows of one bucket -> segments of at most split_rows."""
        names = ["part", "key", "seg", "pat", "mask", "fps"]
        seg = 0
        for batch in batches:
            part, key = batch.column("part").to_numpy(), batch.column("key").to_numpy()
            fp = batch.column("fp").to_numpy().view(np.uint64)
            edges = [0, *(np.flatnonzero((np.diff(part) != 0) | (np.diff(key) != 0)) + 1).tolist(), len(fp)]
            out = [[] for _ in names]
            for a, b in zip(edges[:-1], edges[1:]):
                for s in range(a, b, split_rows):
                    g = fp[s:min(b, s + split_rows)]
                    one, none = np.bitwise_and.reduce(g), np.bitwise_and.reduce(~g)
                    pat, mask = np.array([one, one | none], np.uint64).view(np.int64).tolist()
                    for col, v in zip(out, (int(part[a]), int(key[a]), int(fp[s].view(np.int64)),
                                            pat, mask, g.view(np.int64))):
                        col.append(v)
                    seg += 1
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int32()), *(pa.array(c, pa.int64()) for c in out[1:5]),
                     pa.array(out[5], pa.list_(pa.int64()))], names)

    segs = stored(ranged.mapInArrow(cut, "part int, key long, seg long, pat long, mask long, fps array<long>"),
                  "simhash-segments")
    heads = segs.select("part", "key", "seg", "pat", "mask")
    other = heads.select("part", "key", F.col("seg").alias("seg2"), F.col("pat").alias("pat2"),
                         F.col("mask").alias("mask2"))
    far = F.bit_count(F.col("pat").bitwiseXOR(F.col("pat2")).bitwiseAND(F.col("mask")).bitwiseAND(F.col("mask2")))
    pairs = (heads.join(other, ["part", "key"]).where(F.col("seg") <= F.col("seg2"))
             .where(far <= max_bits).select("part", "key", "seg", "seg2"))
    work = (pairs.join(segs.select("part", "key", "seg", F.col("fps").alias("a")), ["part", "key", "seg"])
            .join(segs.select("part", "key", F.col("seg").alias("seg2"), F.col("fps").alias("b")),
                  ["part", "key", "seg2"])
            .repartition("part", "key", "seg", "seg2"))

    def compare(batches):
        for batch in batches:
            for x in batch.to_pylist():
                a = np.array(x["a"], np.int64).view(np.uint64)
                b = None if x["seg"] == x["seg2"] else np.array(x["b"], np.int64).view(np.uint64)
                links = spanning_links(a, b, max_bits)
                if links:
                    yield emit(links)

    return work.select("seg", "seg2", "a", "b").mapInArrow(compare, schema)


def simhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                       max_bits: int = 3) -> DataFrame:
    """docs -> (key, fingerprint, component_id), one row per input row.

    component_id is the smallest key reachable over links of at most
    ``max_bits`` differing bits, the row's own key included. Null or blank
    texts have fingerprint 0 and are linked like any other. A null key keeps
    its row; it is never the smallest unless the whole component has none, and
    then component_id is null. Repeated rows stay repeated. An empty table
    gives an empty result. Columns other than the two named are not read.
    """
    return _components(docs, key, text, shingle, max_bits)[0]


def _components(docs: DataFrame, key: str, text: str, shingle: int, max_bits: int) -> tuple[DataFrame, list[DataFrame]]:
    """The classes of all rows, and the scratch tables that they are read from."""
    own = stored(fingerprints(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), "t", shingle)
                 .select("k", "fp"), "simhash-fp")
    distinct = stored(own.groupBy("fp").agg(F.min("k").alias("least")), "simhash-distinct")
    comp = connected_components(links_between(distinct.select("fp"), max_bits))
    named = distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = named.join(least, "component").select("fp", "component_id")
    return own.join(labels, "fp").select(
        F.col("k").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"), [own, distinct]


def keep_one_per_component(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                           max_bits: int = 3) -> DataFrame:
    """One row of each component: the one whose key is the smallest.

    Rows repeating one (key, text) are reduced to one. Where a key has several
    texts, each is judged by its own component. A component without any key keeps
    one row per fingerprint. All columns are returned.
    """
    fp = spare(docs, "fp")
    lazy, held = _components(docs, key, text, shingle, max_bits)
    comp = stored(lazy, "simhash-components")
    drop_stored(*held)
    first = comp.where(F.col(key) == F.col("component_id"))
    chosen = first.select(key)
    several = comp.groupBy(key).agg(F.count_distinct("fingerprint").alias("n")).where("n > 1").select(key)
    if several.isEmpty():
        out = docs.join(chosen.distinct(), key, "left_semi")
    else:   # the key alone does not tell which of its texts stays
        apart = fingerprints(docs.join(several, key, "left_semi"), text, shingle, fp).withColumn(
            fp, F.lpad(F.lower(F.hex(fp)), 16, "0"))
        kept = first.select(F.col(key).alias("_k"), F.col("fingerprint").alias("_f"))
        apart = apart.join(kept, (apart[key] == F.col("_k")) & (apart[fp] == F.col("_f")), "left_semi").drop(fp)
        out = docs.join(several, key, "left_anti").join(chosen.distinct(), key, "left_semi").select(*docs.columns).union(
            apart.select(*docs.columns))
    if not chosen.groupBy(key).count().where("count > 1").isEmpty():
        out = out.dropDuplicates([key, text])
    lone = comp.where(F.col("component_id").isNull()).select("fingerprint").distinct()
    if not lone.isEmpty():
        rest = fingerprints(docs.where(F.col(key).isNull()), text, shingle, fp).withColumn(
            fp, F.lpad(F.lower(F.hex(fp)), 16, "0"))
        rest = rest.join(lone, F.col(fp) == lone["fingerprint"], "left_semi").dropDuplicates([fp]).drop(fp)
        out = out.select(*docs.columns).union(rest.select(*docs.columns))
    return out.select(*docs.columns)
