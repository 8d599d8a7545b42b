"""Slowly changing dimensions, type 2.

Versions carry a half-open validity interval ``[scd_effective_from,
scd_effective_to)`` and ``scd_is_current``. A closed snapshot merge uses the
high date 9999-12-31 for open versions; the ordered change feed uses NULL for
the open end (as a managed change-feed table does) unless ``high`` is given.

* ``scd2_merge``: current versions FULL OUTER JOIN incoming snapshot on the
  key, every joined row emits 0-2 versions (keep / close + open / open) in
  one pass. Closed history is passed through untouched: only the current
  part (one row per key) takes part in the shuffle.
* ``scd2_from_feed``: an ordered change feed (key, sequence, values) into
  versions. A per-key window would put every event of a hot key (say a third
  of the feed) into one task. The feed is range-partitioned on (key,
  sequence) instead -- a hot key is split over many contiguous segments --
  the change test runs per segment, and only one summary row per segment
  crosses segments to fix the boundaries.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.session import ensure_checkpoint_dir

# SCD2 column names and the open-ended high date.
EFFECTIVE_FROM = "scd_effective_from"
EFFECTIVE_TO = "scd_effective_to"
IS_CURRENT = "scd_is_current"
HIGH_DATE = "9999-12-31"
SCD_COLUMNS = (EFFECTIVE_FROM, EFFECTIVE_TO, IS_CURRENT)


def current_rows(df: DataFrame) -> DataFrame:
    """Only the current version of each key (P3); plain tables pass through."""
    if IS_CURRENT in df.columns:
        return df.filter(F.col(IS_CURRENT))
    if "__END_AT" in df.columns:
        return df.filter(F.col("__END_AT").isNull())
    return df


def changed(old: Sequence[Column], new: Sequence[Column], null_safe: bool = True) -> Column:
    """True when any tracked value differs.

    ``null_safe=False`` reproduces a plain ``<>`` test, where NULL -> value and
    value -> NULL are not changes (Q9).
    """
    tests = [~o.eqNullSafe(n) if null_safe else F.coalesce(o != n, F.lit(False)) for o, n in zip(old, new)]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def scd2_initial(df: DataFrame, effective: str | dt.date) -> DataFrame:
    """First load: every row is an open version."""
    return (
        df.withColumn(EFFECTIVE_FROM, F.lit(str(effective)).cast(T.DateType()))
        .withColumn(EFFECTIVE_TO, F.lit(HIGH_DATE).cast(T.DateType()))
        .withColumn(IS_CURRENT, F.lit(True))
    )


def _all_columns(stored: DataFrame, incoming: DataFrame) -> list[str]:
    """Columns of the snapshot, then those that only the stored versions have."""
    names = [c for c in incoming.columns if c not in SCD_COLUMNS]
    return names + [c for c in stored.columns if c not in SCD_COLUMNS and c not in names]


def _or_null(own: DataFrame, other: DataFrame, c: str):
    return F.col(c) if c in own.columns else F.lit(None).cast(other.schema[c].dataType)


def scd2_merge_current(current: DataFrame | None, incoming: DataFrame, key: str,
                       tracked: Sequence[str], effective: str | dt.date,
                       null_safe: bool = True, delete_missing: bool = False) -> DataFrame:
    """The versions a snapshot merge touches (V1), from the CURRENT rows only.

    Output: every version that is current after the merge, plus the versions
    this merge closes. Closed history is not an input, so it is never read or
    rewritten. Changed keys: the current version is closed at ``effective``
    and the incoming row opens a new one; unchanged keys keep their version
    (changes in untracked columns are ignored, Q11); new keys open a version;
    keys missing from the snapshot stay current unless ``delete_missing``.
    """
    if current is None:
        return scd2_initial(incoming, effective)
    eff = F.lit(str(effective)).cast(T.DateType())
    cols = _all_columns(current, incoming)
    # a row without a key is told apart by its whole content: it is kept as it
    # is, and delivering it again changes nothing
    both = [c for c in incoming.columns if c in current.columns and c not in SCD_COLUMNS]
    content = F.when(F.col(key).isNull(), F.xxhash64(*[F.col(c).cast("string") for c in both])).otherwise(F.lit(0))
    cur = current_rows(current).select(
        *[_or_null(current, incoming, c).alias("t_" + c) for c in cols], content.alias("t_content"),
        F.col(EFFECTIVE_FROM).alias("t_from"), F.col(EFFECTIVE_TO).alias("t_to"),
    )
    inc = incoming.select(*[_or_null(incoming, current, c).alias("s_" + c) for c in cols],
                          content.alias("s_content"))
    j = cur.join(inc, cur["t_" + key].eqNullSafe(inc["s_" + key]) & (cur["t_content"] == inc["s_content"]), "full_outer")

    has_t = F.col("t_content").isNotNull()
    has_s = F.col("s_content").isNotNull()
    diff = has_t & has_s & changed([F.col("t_" + c) for c in tracked], [F.col("s_" + c) for c in tracked], null_safe)
    close_old = diff | (has_t & ~has_s & F.lit(delete_missing))
    open_new = has_s & (~has_t | diff)

    old_version = F.when(has_t, F.struct(
        *[F.col("t_" + c).alias(c) for c in cols],
        F.col("t_from").alias(EFFECTIVE_FROM),
        F.when(close_old, eff).otherwise(F.col("t_to")).alias(EFFECTIVE_TO),
        (~close_old).alias(IS_CURRENT),
    ))
    new_version = F.when(open_new, F.struct(
        *[F.col("s_" + c).alias(c) for c in cols],
        eff.alias(EFFECTIVE_FROM),
        F.lit(HIGH_DATE).cast(T.DateType()).alias(EFFECTIVE_TO),
        F.lit(True).alias(IS_CURRENT),
    ))
    return j.select(F.inline(F.filter(F.array(old_version, new_version), lambda v: v.isNotNull())))


def scd2_merge(target: DataFrame | None, incoming: DataFrame, key: str,
               tracked: Sequence[str], effective: str | dt.date,
               null_safe: bool = True, delete_missing: bool = False) -> DataFrame:
    """Apply an incoming snapshot (unique on ``key``) to a whole SCD2 table (V1).

    Closed history passes through; only current rows take part in the join.
    """
    if target is None:
        return scd2_initial(incoming, effective)
    touched = scd2_merge_current(target.filter(F.col(IS_CURRENT)), incoming, key, tracked, effective,
                                 null_safe, delete_missing)
    # a column that only one side has is NULL on the other (schema evolution)
    history = target.filter(~F.col(IS_CURRENT)).select(
        *[_or_null(target, incoming, c).alias(c) for c in _all_columns(target, incoming)], *SCD_COLUMNS)
    return history.unionByName(touched)


_PLAN_LOCK = threading.Lock()


def _checkpoint_partitioned(df: DataFrame) -> DataFrame:
    """Reliable checkpoint that keeps the plan's hash partitioning and order.

    An adaptive plan reports unknown partitioning at its root, so the
    checkpointed relation would lose it and every later use would shuffle
    again. All partition counts of ``df`` are explicit, so AQE has nothing to
    adapt there: this one plan is made without it (the setting is restored
    right after, under a lock).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    with _PLAN_LOCK:
        previous = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            return df.checkpoint(eager=True)
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", previous)


def scd2_from_feed(feed: DataFrame, keys: Sequence[str], sequence_by: Sequence[str],
                   tracked: Sequence[str], except_columns: Sequence[str] = (),
                   null_safe: bool = True, high: object | None = None,
                   segments: int | None = None) -> DataFrame:
    """Versions from an ordered change feed (V3-V5).

    A row opens a version when its tracked values differ from the previous
    row of the same key in ``sequence_by`` order. A version ends where the
    next one starts; the last one is current (end NULL, or ``high``).
    ``except_columns`` are not stored. No deletes are applied.
    """
    keys, seq, tracked = list(keys), list(sequence_by), list(tracked)
    spark = feed.sparkSession
    n = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keep = [c for c in feed.columns if c not in except_columns]

    # contiguous segments of (key, sequence); a hot key spans many segments.
    # Segment ids must be identical in every branch below, and range bounds
    # are sampled per exchange: the segmented feed is checkpointed once
    # (reliable storage under spark.checkpoint.dir, survives executor loss).
    # It is stored hash-partitioned and sorted by (key, segment, sequence):
    # the checkpoint keeps that partitioning and order, so the windows,
    # aggregates and joins below need no further shuffle of the feed.
    x = _checkpoint_partitioned(
        feed.select(*keep).repartitionByRange(n, *keys, *seq)
        .withColumn("_seg", F.spark_partition_id())
        .repartition(n, *keys, "_seg")
        .sortWithinPartitions(*keys, "_seg", *seq))
    vals = F.struct(*[F.col(c) for c in tracked])
    order = F.struct(*[F.col(c) for c in seq])
    in_seg = Window.partitionBy(*keys, "_seg").orderBy(*seq)
    by_key = Window.partitionBy(*keys).orderBy("_seg")

    # last tracked values of the previous segment of the same key
    seg_last = (
        x.groupBy(*keys, "_seg").agg(F.max_by(vals, order).alias("_last"))
        .withColumn("_prev_seg", F.lag("_last").over(by_key))
        .select(*keys, "_seg", "_prev_seg")
    )
    x = x.withColumn("_prev_row", F.lag(vals).over(in_seg))
    x = x.join(seg_last, [*keys, "_seg"], "left")
    prev = F.coalesce(F.col("_prev_row"), F.col("_prev_seg"))
    opens = prev.isNull() | changed([prev.getField(c) for c in tracked], [F.col(c) for c in tracked], null_safe)
    starts = x.filter(opens).drop("_prev_row", "_prev_seg")

    # end = start of the next version: same segment, else first in a later one
    seg_first = (
        starts.groupBy(*keys, "_seg").agg(F.min(F.col(seq[0])).alias("_first"))
        .withColumn("_next_seg", F.lead("_first").over(by_key))
        .select(*keys, "_seg", "_next_seg")
    )
    starts = starts.withColumn("_next_row", F.lead(F.col(seq[0])).over(in_seg))
    starts = starts.join(seg_first, [*keys, "_seg"], "left")
    end = F.coalesce(F.col("_next_row"), F.col("_next_seg"))
    ftype = feed.schema[seq[0]].dataType
    open_end = F.lit(None).cast(ftype) if high is None else F.lit(high).cast(ftype)
    return starts.select(
        *keep,
        F.col(seq[0]).alias(EFFECTIVE_FROM),
        F.coalesce(end, open_end).alias(EFFECTIVE_TO),
        end.isNull().alias(IS_CURRENT),
    )
