"""Streaming SCD2 from an ordered change feed, repaired per key (T5).

Late or out-of-order events can change versions that are already closed. A
late event leaves everything before it as it was, so only the versions from
the one in force at that time on are derived anew, for the touched keys only:

    <feed>/batch=<id>/_key_bucket=<b>/...      raw rows of every batch
    <table>/batch=<id>/_key_bucket=<b>/...     patches: versions of the touched keys
    <table>/_layout                            names of the key and sequence columns

A patch replaces, for its key, every older version that starts at or behind
the patch's first one. Files of earlier batches are never rewritten; a reader
keeps the versions that no later patch replaces. Buckets of the key prune
both reads. A replayed batch overwrites its own folders with the same content.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.operators.scd2 import scd2_from_feed

BUCKET = "_key_bucket"
BATCH = "batch"
BATCH_PREFIX = BATCH + "="
LAYOUT = "_layout"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _patches(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """All rows of complete batches (older than ``before``), with their batch number."""
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return None
    done = [st.getPath() for st in fs.listStatus(p) if st.getPath().getName().startswith(BATCH_PREFIX)
            and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))]
    done = [q.toString() for q in done if before is None or int(q.getName()[len(BATCH_PREFIX):]) < before]
    if not done:
        return None
    rows = spark.read.option("basePath", root).parquet(*sorted(done))
    return rows.withColumn(BATCH, F.col(BATCH).cast("long"))


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str], prefix: str) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & left[c].eqNullSafe(right[prefix + c])
    return cond


def _standing(rows: DataFrame, keys: Sequence[str], sequence_by: Sequence[str]) -> DataFrame:
    """The rows of patches that no later patch of their key replaces.

    One row per key and batch tells where its patch starts; a version stands if it
    starts ahead of all later patches. A key is in at most as many patches as batches.
    """
    at = F.struct(*[F.col(c) for c in sequence_by])
    starts = rows.groupBy(*keys, BATCH).agg(F.min(at).alias("_start"))
    later = Window.partitionBy(*keys).orderBy(BATCH).rowsBetween(1, Window.unboundedFollowing)
    limits = starts.withColumn("_limit", F.min("_start").over(later)).where("_limit IS NOT NULL").select(
        *[F.col(c).alias("_k_" + c) for c in (*keys, BATCH)], "_limit")
    joined = rows.join(limits, _same(rows, limits, [*keys, BATCH], "_k_"), "left")
    return joined.where(F.col("_limit").isNull() | (at < F.col("_limit"))).select(*rows.columns)


def read_versioned(spark: SparkSession, root: str) -> DataFrame | None:
    """The current state of a versioned table, or None before its first batch."""
    rows = _patches(spark, root)
    if rows is None:
        return None
    names = spark.read.parquet(f"{root.rstrip('/')}/{LAYOUT}").first()
    return _standing(rows, names["keys"], names["sequence_by"]).drop(BATCH)


def scd2_batch_writer(feed_root: str, table_root: str, keys: Sequence[str], sequence_by: Sequence[str],
                      tracked: Sequence[str], except_columns: Sequence[str] = (), buckets: int = 64):
    """A ``foreachBatch`` function maintaining the versioned table."""
    keys, seq = list(keys), list(sequence_by)
    lost = set(seq) & set(except_columns)
    if lost:
        raise ValueError(f"sequence columns must be stored: {sorted(lost)}")

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tagged = batch.withColumn(BUCKET, key_bucket(keys, buckets))
        name = f"{BATCH_PREFIX}{batch_id:012d}"
        tagged.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{feed_root}/{name}")
        arrived = spark.read.schema(tagged.schema).parquet(f"{feed_root}/{name}")
        # the touched bucket numbers: at most ``buckets`` small integers
        touched = [r[0] for r in arrived.select(BUCKET).distinct().collect()]
        if not touched:
            return
        if not _fs(spark, f"{table_root}/{LAYOUT}")[0].exists(_fs(spark, f"{table_root}/{LAYOUT}")[1]):
            spark.createDataFrame([(keys, seq)], "keys array<string>, sequence_by array<string>") \
                .coalesce(1).write.mode("overwrite").parquet(f"{table_root}/{LAYOUT}")
        at = F.struct(*[F.col(c) for c in seq])
        first = arrived.groupBy(*keys).agg(F.min(at).alias("_from"))
        known = _patches(spark, table_root, before=batch_id)
        if known is not None:
            # start at the version that was in force just before a key's earliest new event
            marks = first.select(*[F.col(k).alias("_k_" + k) for k in keys], "_from")
            old = _standing(known.where(F.col(BUCKET).isin(touched)), keys, seq)
            force = (old.join(marks, _same(old, marks, keys, "_k_")).where(at < F.col("_from"))
                     .groupBy(*keys).agg(F.max(at).alias("_force")))
            force = force.select(*[F.col(k).alias("_k_" + k) for k in keys], "_force")
            first = first.join(force, _same(first, force, keys, "_k_"), "left").select(
                *keys, F.coalesce("_force", "_from").alias("_from"))
        first = first.select(*[F.col(k).alias("_k_" + k) for k in keys], "_from")
        feed = spark.read.parquet(feed_root).where(F.col(BUCKET).isin(touched)).drop(BATCH)
        rows = feed.join(first, _same(feed, first, keys, "_k_")).where(at >= F.col("_from")).select(*feed.columns)
        versions = scd2_from_feed(rows, keys, seq, tracked, except_columns)
        versions.write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy(BUCKET).parquet(f"{table_root}/{name}")

    return process


def start_scd2_stream(stream: DataFrame, feed_root: str, table_root: str, checkpoint: str,
                      keys: Sequence[str], sequence_by: Sequence[str], tracked: Sequence[str],
                      except_columns: Sequence[str] = (), buckets: int = 64,
                      trigger: str = "availableNow"):
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        scd2_batch_writer(feed_root, table_root, keys, sequence_by, tracked, except_columns, buckets))
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=trigger)
    return w.start()
