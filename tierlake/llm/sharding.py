"""Sharding by histogram sort: exact byte counts below candidate boundaries,
refined until every splitter meets its tolerance, then one exchange.

Rows are ordered by (hash of the text, key), so equal texts stand together. For
each splitter an interval of that order is known to hold it. A round counts, in
one pass over a narrow table, the bytes below equally spaced probes of all open
intervals; each interval shrinks to the probe gap around its target, down to
the keys that occur in it. An interval that is a single text is refined on the
row key, so a text that fills several shards is cut like any other stretch.

The exchange deals rows by ranges of (shard, order), so a task orders its share
of the input and not a shard, whatever the shard's size; only the row counts of
the shards that a task border cuts are added up to number the slots.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import drop_stored, in_order, room_for, stored

SHARDS = 24
PROBES = 256         # candidate boundaries per open interval and round
TOLERANCE = 0.01     # of a shard's mean bytes
ROW_BYTES = 8        # added to the text's bytes, by the contract


@dataclass(frozen=True)
class Splitter:
    """Rows with (hash, key) below (at, key) lie before it; key None: hash below ``at``."""
    at: int
    key: int | None = None


def order_hash(text: Column) -> Column:
    """63 bits of the text's hash; a null text is a text of its own."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit("\u0000null"))), 1)


def row_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def _below(splitters: list[Splitter], h: Column, k: Column) -> Column:
    """Number of splitters at or before the row: a balanced tree of comparisons."""

    def before(s: Splitter) -> Column:
        return h < s.at if s.key is None else (h < s.at) | ((h == s.at) & (k < s.key))

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(before(splitters[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(splitters))


def find_splitters(narrow: DataFrame, targets: list[tuple[float, float]], probes: int = PROBES,
                   max_rounds: int = 64) -> list[Splitter]:
    """Splitters of (h, k, b) whose bytes below are within the tolerance of each
    (target, tolerance), or as near as whole rows allow.

    Returns them in order. Only probe counts reach the driver: at most
    len(targets) x probes rows a round.
    """
    first = narrow.agg(F.sum("b"), F.min("h"), F.max("h")).first()
    if first[0] is None:
        return [Splitter(0) for _ in targets]
    # open interval: (hash or None, lowest, highest value, bytes below lowest)
    spans = {i: (None, first[1], first[2], 0) for i in range(len(targets))}
    chosen: dict[int, Splitter] = {}
    for _ in range(max_rounds):
        if not spans:
            break
        intervals = sorted({s for s in spans.values()}, key=lambda s: (s[1], -1) if s[0] is None else (s[0], s[1]))
        number = {s: n for n, s in enumerate(intervals)}

        def place(lo: int, hi: int) -> Column:
            """(interval, probe gap) of a row: intervals do not overlap."""
            if hi - lo == 1:
                s = intervals[lo]
                v = F.col("h") if s[0] is None else F.col("k")
                step = max(1, -(-(s[2] - s[1] + 1) // probes))
                inside = v.between(s[1], s[2]) if s[0] is None else (F.col("h") == s[0]) & v.between(s[1], s[2])
                return F.when(inside, F.struct(F.lit(lo).alias("n"), F.floor((v - F.lit(s[1])) / F.lit(step)).cast("long").alias("g"),
                                               v.alias("v")))
            mid = (lo + hi) // 2
            s = intervals[mid]
            ahead = F.col("h") < s[1] if s[0] is None else (F.col("h") < s[0]) | ((F.col("h") == s[0]) & (F.col("k") < s[1]))
            return F.when(ahead, place(lo, mid)).otherwise(place(mid, hi))

        counted = (narrow.select(place(0, len(intervals)).alias("p"), "b").where("p is not null")
                   .groupBy("p.n", "p.g").agg(F.sum("b").alias("b"), F.min("p.v").alias("lo"), F.max("p.v").alias("hi"))
                   .collect())
        gaps: dict[int, list] = {}
        for r in sorted(counted, key=lambda r: (r.n, r.g)):
            gaps.setdefault(r.n, []).append(r)
        for i, s in list(spans.items()):
            target, tolerance = targets[i]
            below = s[3]
            for r in gaps[number[s]]:
                if below + r.b >= target or r is gaps[number[s]][-1]:
                    break
                below += r.b
            ends = [(abs(below - target), r.lo), (abs(below + r.b - target), r.hi + 1)]
            miss, value = min(ends)
            cut = Splitter(value) if s[0] is None else (Splitter(s[0], value))
            if miss <= tolerance:
                chosen[i] = cut
            elif r.lo < r.hi:
                spans[i] = (s[0], r.lo, r.hi, below)
                continue
            elif s[0] is None:
                # one text alone: go on by the row key
                edge = narrow.where(F.col("h") == r.lo).agg(F.min("k"), F.max("k")).first()
                if edge[0] is not None and edge[0] < edge[1]:
                    spans[i] = (r.lo, edge[0], edge[1], below)
                    continue
                chosen[i] = cut
            else:
                chosen[i] = cut
            del spans[i]
    if spans:
        raise RuntimeError(f"{len(spans)} splitters not found after {max_rounds} rounds")
    return sorted(chosen.values(), key=lambda s: (s.at, -1 if s.key is None else s.key))


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS,
          tolerance: float = TOLERANCE, prefix: str = "") -> DataFrame:
    """All rows of ``docs`` with shard (0 to shards - 1) and slot (gapless from 0).

    Shards are contiguous in the order (hash of the text, key, whole row) and
    near equal in bytes: each border is within ``tolerance`` of its exact place,
    or at the nearest row where a row or a repeated key is longer than that.
    Equal texts share a shard but where a border must fall between them. A null
    text has no bytes; a null key orders first. Repeated rows get slots of their
    own. An empty table gives an empty result. ``prefix`` keeps the added names
    apart from clashing columns; without one, a clashing column of the input is
    kept under its name with a leading underscore.
    """
    docs, key, text = room_for(docs, [prefix + "shard", prefix + "slot"], key, text)
    least = F.lit(-(1 << 62))
    order, number = order_hash(F.col(text)), F.coalesce(F.col(key).cast("long"), least)
    narrow = stored(docs.select(order.alias("h"), number.alias("k"), row_bytes(F.col(text)).alias("b")), "shards-narrow")
    mean = (narrow.agg(F.sum("b")).first()[0] or 0) / shards
    borders = find_splitters(narrow, [(mean * i, mean * tolerance) for i in range(1, shards)])
    drop_stored(narrow)
    # the row travels as a struct: its columns cannot clash with those of the order
    hashable = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    placed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), order.alias("h"), number.alias("k"),
                         F.xxhash64(*[F.col(f"`{c}`") for c in hashable]).alias("tie"))
    placed = placed.withColumn("shard", _below(borders, F.col("h"), F.col("k")))
    return in_order(placed, "shard", ["h", "k", "tie"]).select(
        *[F.col("doc").getField(c).alias(c) for c in docs.columns],
        F.col("shard").cast("int").alias(prefix + "shard"), (F.col("nth") - 1).cast("long").alias(prefix + "slot"))


def write_shards(sharded: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """One folder per shard, its rows in slot order within each file."""
    sharded.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
