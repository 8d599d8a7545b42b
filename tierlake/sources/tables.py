"""Layer tables as parquet folders.

No table format with a transaction log is available here, and overwriting a parquet path
that the same plan reads deletes the input first. So a table that is
replaced per run is a set of snapshot folders ``<root>/snapshot=<run_id>``;
a reader takes the newest complete one (``_SUCCESS`` present). A replayed
run overwrites only its own snapshot. Append-only tables (Bronze, logs) are
plain partitioned folders.

Writes go through a rebalance hint: AQE splits a partition value holding a
large share of the rows over several tasks and merges small ones, which
bounds both file count and file size (the reference's optimize-write hints).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SNAPSHOT_PREFIX = "snapshot="
# Ids take most of a table: zstd stores them in about two thirds of what Spark's default (snappy) needs.
CODEC = {"compression": "zstd"}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path`` (metadata only)."""
    fs, p, _ = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def drop(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")


def write_snapshot(df: DataFrame, root: str, run_id: str, partition_by: Sequence[str] = (),
                   max_records_per_file: int | None = None, rebalance: bool = True) -> str:
    """Write ``df`` as the snapshot of ``run_id`` (idempotent for a replay).

    ``rebalance=False``: the rows already lie by ``partition_by`` and are not shuffled again.
    """
    path = f"{root.rstrip('/')}/{SNAPSHOT_PREFIX}{run_id}"
    # a snapshot folder is always new: static mode (dynamic mode writes no _SUCCESS)
    df = _rebalanced(df, partition_by) if rebalance else df
    w = df.write.mode("overwrite").options(**CODEC).option("partitionOverwriteMode", "static")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def snapshots(spark: SparkSession, root: str) -> list[str]:
    """Complete snapshot folders, oldest first."""
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(SNAPSHOT_PREFIX):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(st.getPath().toString())
    return sorted(out, key=lambda s: s.rsplit(SNAPSHOT_PREFIX, 1)[1])


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    snaps = snapshots(spark, root)
    return spark.read.parquet(snaps[-1]) if snaps else None


def expire_snapshots(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` newest complete snapshots; the deleted folders.

    Folders of unfinished runs are left alone: a run may be writing them.
    """
    if keep < 1:
        raise ValueError("the newest snapshot is the table")
    old = snapshots(spark, root)[:-keep]
    for path in old:
        fs, p, _ = _fs(spark, path)
        fs.delete(p, True)
    return old


# An append-only table keeps its schema beside its files, so that a read opens no footers to
# merge them. One small file per version; a version is written when a column is new.
SCHEMAS = "_schemas"


def known_schema(spark: SparkSession, root: str) -> T.StructType | None:
    fs, p, jvm = _fs(spark, f"{root.rstrip('/')}/{SCHEMAS}")
    if not fs.exists(p):
        return None
    newest = max(fs.listStatus(p), key=lambda st: st.getPath().getName())
    stream = fs.open(newest.getPath())
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return T.StructType.fromJson(json.loads(text))


def remember_schema(spark: SparkSession, root: str, schema: T.StructType) -> T.StructType:
    """The known schema with the columns of ``schema`` that it lacks, written if there are any."""
    known = known_schema(spark, root)
    merged = T.StructType(list(known.fields) if known else [])
    for f in schema.fields:
        if f.name not in merged.names:
            merged = merged.add(f.name, f.dataType, True)
    if known is None or len(merged) > len(known):
        fs, p, _ = _fs(spark, f"{root.rstrip('/')}/{SCHEMAS}/columns={len(merged):06d}.json")
        out = fs.create(p, True)
        try:
            out.write(bytearray(merged.json().encode()))
        finally:
            out.close()
    return merged


def append(df: DataFrame, root: str, partition_by: Sequence[str] = (), rebalance: bool = True) -> None:
    """``rebalance=False``: the rows come from a shuffle of their own and hold few partition values."""
    spark = df.sparkSession
    # a table from before its schema was kept: what it has comes first
    if known_schema(spark, root) is None and (held := read_appended(spark, root)) is not None:
        remember_schema(spark, root, held.schema)
    remember_schema(spark, root, df.schema)   # first: a column without rows yet does no harm, rows without it would
    w = (_rebalanced(df, partition_by) if rebalance else df).write.mode("append").options(**CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(root)


def read_appended(spark: SparkSession, root: str) -> DataFrame | None:
    """An append-only table, or None before its first write."""
    fs, p, _ = _fs(spark, root)
    if not fs.exists(p) or len(fs.listStatus(p)) == 0:
        return None
    known = known_schema(spark, root)
    if known is not None:
        return spark.read.schema(known).parquet(root)
    return spark.read.option("mergeSchema", "true").parquet(root)


# ---------------------------------------------------------------- versioned (SCD2) tables

RUN_PREFIX = "run="
CURRENT_FLAG = "scd_is_current"


def write_versions_run(df: DataFrame, root: str, run_id: str) -> str:
    """Write the versions one merge produced (all current rows + the rows it
    closed) as ``<root>/run=<run_id>/scd_is_current=true|false``."""
    path = f"{root.rstrip('/')}/{RUN_PREFIX}{run_id}"
    (_rebalanced(df, ()).write.mode("overwrite").options(**CODEC).option("partitionOverwriteMode", "static")
     .partitionBy(CURRENT_FLAG).parquet(path))
    return path


def _runs(spark: SparkSession, root: str) -> list:
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    runs = [st.getPath() for st in fs.listStatus(p)
            if st.isDirectory() and st.getPath().getName().startswith(RUN_PREFIX)
            and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))]
    return sorted(runs, key=lambda q: q.getName())


def _flag_part(spark: SparkSession, run_path, flag: bool) -> DataFrame | None:
    fs, _, jvm = _fs(spark, str(run_path))
    part = jvm.org.apache.hadoop.fs.Path(run_path, f"{CURRENT_FLAG}={'true' if flag else 'false'}")
    if not fs.exists(part):
        return None
    from pyspark.sql import functions as F
    return spark.read.parquet(part.toString()).withColumn(CURRENT_FLAG, F.lit(flag))


def read_current_versions(spark: SparkSession, root: str, before: str | None = None) -> DataFrame | None:
    """Current versions only: the newest complete run's current part; with
    ``before``, of the runs older than that id, so that a replayed run merges
    into the state it first saw and closes the same versions again."""
    runs = [r for r in _runs(spark, root) if before is None or r.getName() < f"{RUN_PREFIX}{before}"]
    return _flag_part(spark, runs[-1], True) if runs else None


def read_versions(spark: SparkSession, root: str) -> DataFrame | None:
    """The whole versioned table: newest current part + every run's closed part.
    A filter on ``scd_is_current`` prunes the other parts (literal flags)."""
    runs = _runs(spark, root)
    if not runs:
        return None
    parts = [_flag_part(spark, runs[-1], True)] + [_flag_part(spark, r, False) for r in runs]
    parts = [p for p in parts if p is not None]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
