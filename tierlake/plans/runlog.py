"""Run records and quality logs as tables.

Records are tiny (one row per source and run); they are written with Spark
to the lake so that dashboards query them like any other table.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.sources import tables

# Names of the two log tables.
PIPELINE_RUNS = "_pipeline_runs"
QUALITY_LOG = "_quality_log"

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("layer", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("rows_read", T.LongType(), True),
    T.StructField("rows_written", T.LongType(), True),
    T.StructField("drift_messages", T.ArrayType(T.StringType()), True),
    T.StructField("started_at", T.TimestampType(), False),
    T.StructField("finished_at", T.TimestampType(), False),
    T.StructField("duration_seconds", T.DoubleType(), False),
    T.StructField("error", T.StringType(), True),
])


def new_run_id(now: dt.datetime | None = None) -> str:
    """Sortable run id: UTC time then a random suffix."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def run_record(run_id: str, layer: str, source: str, status: str, started: dt.datetime,
               rows_read: int | None = None, rows_written: int | None = None,
               drift_messages: list[str] | None = None, error: str | None = None) -> dict:
    finished = utc_now()
    return {
        "run_id": run_id, "layer": layer, "source": source, "status": status,
        "rows_read": rows_read, "rows_written": rows_written,
        "drift_messages": list(drift_messages or []),
        "started_at": started, "finished_at": finished,
        "duration_seconds": (finished - started).total_seconds(), "error": error,
    }


def runs_frame(spark: SparkSession, records: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r[f.name] for f in RUN_SCHEMA.fields) for r in records], RUN_SCHEMA)


def append_runs(spark: SparkSession, lake_root: str, records: list[dict]) -> None:
    tables.append(runs_frame(spark, records), f"{lake_root}/{PIPELINE_RUNS}")


def quality_rows(results: DataFrame, source: str, layer: str, run_id: str,
                 checked_at: dt.datetime) -> DataFrame:
    """Rule results with their context, as rows of the quality log (R2)."""
    return results.select(
        F.lit(run_id).alias("run_id"), F.lit(layer).alias("layer"), F.lit(source).alias("source"),
        F.lit(checked_at).cast(T.TimestampType()).alias("checked_at"), "*")


def append_quality(results: DataFrame, lake_root: str) -> None:
    tables.append(results, f"{lake_root}/{QUALITY_LOG}")


def table_counts(named: dict[str, DataFrame]) -> DataFrame:
    """Row count per table (R3, A6): one small aggregate per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in named.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_history(runs: DataFrame) -> DataFrame:
    """One row per run and layer with totals and the worst status."""
    return runs.groupBy("run_id", "layer").agg(
        F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at"),
        F.sum("rows_written").alias("rows_written"),
        F.count_if(F.col("status") != "success").alias("failed_steps"),
    )
