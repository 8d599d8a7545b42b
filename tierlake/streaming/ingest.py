"""Incremental, exactly-once file ingestion with Structured Streaming.

The file source remembers which files it has processed in its checkpoint,
and the file sink commits each micro-batch once, so re-running a stream over
the same landing folder adds nothing. ``trigger="availableNow"`` processes
what has landed and stops (a triggered run); a processing-time trigger runs
continuously.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierlake.operators.expectations import apply_expectations
from tierlake.sources.contracts import contract_schema
from tierlake.sources.specs import Contract


# Full-precision timestamp text (Spark's default CSV format stops at milliseconds).
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def landing_stream(spark: SparkSession, path: str, schema: T.StructType | Contract,
                   file_format: str = "csv", max_files_per_trigger: int | None = None,
                   timestamp_format: str | None = TIMESTAMP_FORMAT) -> DataFrame:
    """A stream of new landing files with a fixed schema (streams cannot infer).

    CSV headers are checked against the schema (``enforceSchema=false``): a
    file whose header differs fails the stream instead of shifting values.
    """
    if not isinstance(schema, T.StructType):
        schema = contract_schema(schema)
    reader = spark.readStream.format(file_format).schema(schema)
    if file_format == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "false")
        if timestamp_format:
            reader = reader.option("timestampFormat", timestamp_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def with_stream_lineage(df: DataFrame, source: str) -> DataFrame:
    """Lineage of a streamed row: its file and the micro-batch time."""
    return (
        df.withColumn("_source", F.lit(source))
        .withColumn("_source_file", F.col("_metadata.file_path"))
        .withColumn("_ingested_at", F.current_timestamp())
        .withColumn("ingestion_date", F.current_date())
    )


def with_expectations(df: DataFrame, expectations: Mapping[str, str], policy: str = "warn",
                      metrics_name: str = "expectations") -> DataFrame:
    """Row expectations inside the stream (T4); violation counts per micro-batch
    are published as observed metrics of the query progress."""
    metrics = [F.count_if(~F.coalesce(F.expr(sql), F.lit(False))).alias(name)
               for name, sql in expectations.items()]
    observed = df.observe(metrics_name, F.count(F.lit(1)).alias("rows"), *metrics)
    kept, _ = apply_expectations(observed, expectations, policy)
    return kept


def drop_redelivered(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Rows delivered again are dropped, across micro-batches (P8 in a stream).

    The state holds the keys seen, one entry each, until the watermark (latest
    ``event_time`` less ``delay``) has passed them; a copy that comes later than that
    is late data. ``delay`` must cover how far apart deliveries of one row may be.
    """
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def start_file_sink(df: DataFrame, path: str, checkpoint: str, trigger: str = "availableNow",
                    partition_by: Sequence[str] = ("ingestion_date",), query_name: str | None = None
                    ) -> StreamingQuery:
    """Append a stream to a parquet folder, exactly once per file."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=trigger)
    return w.start()


def bronze_batch_writer(table_root: str, partition_by: Sequence[str] = ("ingestion_date",)):
    """A ``foreachBatch`` function that stamps ``_batch_id`` on every row and
    writes the micro-batch under its own ``batch=<id>`` folder (overwrite):
    a replayed batch replaces its own output, so the table stays exactly-once."""

    def process(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn("_batch_id", F.lit(f"{batch_id:012d}"))
        w = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{table_root.rstrip('/')}/batch={batch_id:012d}")

    return process


def start_bronze_batches(df: DataFrame, table_root: str, checkpoint: str, trigger: str = "availableNow",
                         partition_by: Sequence[str] = ("ingestion_date",)) -> StreamingQuery:
    """Stream into a Bronze table with ``_batch_id`` lineage."""
    w = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        bronze_batch_writer(table_root, partition_by))
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=trigger)
    return w.start()
