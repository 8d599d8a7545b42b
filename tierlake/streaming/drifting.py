"""Streams of landing files whose columns change (T3, C1-C3 in a stream).

A file stream has one fixed schema, and a file with another header stops it. Here
the stream carries only the names of new files; each micro-batch reads them with
the batch readers, by their own headers and the contract. A new column goes on
and is remembered, a missing required one stops the stream before anything of
that micro-batch is written. The schemas a stream has had are a table:

    <schemas>/version=<n>      (batch, columns as DDL, drift messages)

The written table is read with the newest of them, so no footer is merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierlake.sources import tables
from tierlake.sources.contracts import conform_to_contract
from tierlake.sources.landing import read_files
from tierlake.sources.specs import SourceSpec

_FILES = "path string, modificationTime timestamp, length long, content binary"   # of Spark's binaryFile source


class SchemaLog:
    """The schemas of one stream, oldest first; a version is written once and never changed."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> DataFrame | None:
        if not tables.exists(self.spark, self.root):
            return None
        return self.spark.read.schema("batch long, ddl string, drift array<string>, version int").parquet(self.root)

    def newest(self) -> tuple[int, T.StructType | None]:
        known = self.versions()
        row = known.orderBy(F.desc("version")).first() if known is not None else None
        return (row["version"], T.StructType.fromDDL(row["ddl"])) if row else (0, None)

    def remember(self, schema: T.StructType, batch: int, drift: list[str]) -> T.StructType:
        """The known schema with the columns of ``schema`` that it lacks; a new version if there are any."""
        version, known = self.newest()
        merged = T.StructType(list(known.fields) if known else [])
        new = [f for f in schema.fields if f.name not in merged.names]
        for f in new:
            merged = merged.add(f.name, f.dataType)
        if new:
            self.spark.createDataFrame([(batch, merged.toDDL(), drift)], "batch long, ddl string, drift array<string>") \
                .coalesce(1).write.mode("overwrite").parquet(f"{self.root}/version={version + 1}")
        return merged


def drifting_batch_writer(spec: SourceSpec, table_root: str, log: SchemaLog):
    """A ``foreachBatch`` function over file names; a replayed batch replaces its own output."""

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files = sorted(r["path"] for r in batch.select("path").collect())   # one row per new file
        if not files:
            return
        rows, drift = read_files(spark, files, spec.file_format, spec.contract, spec.name)
        if spec.contract:
            rows = conform_to_contract(rows, spec.contract)
        schema = log.remember(rows.schema, batch_id, drift)
        rows = rows.select(*[F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                             for f in schema.fields])
        rows.write.mode("overwrite").parquet(f"{table_root.rstrip('/')}/batch={batch_id:012d}")

    return process


def start_drifting_stream(spark: SparkSession, path: str, spec: SourceSpec, table_root: str, schema_root: str,
                          checkpoint: str, max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Ingest what has landed under ``path`` and stop; files are taken once (the checkpoint knows them)."""
    names = (spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", max_files_per_trigger).load(path).select("path"))
    return (names.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(drifting_batch_writer(spec, table_root, SchemaLog(spark, schema_root))).start())


def read_drifting(spark: SparkSession, table_root: str, schema_root: str) -> DataFrame | None:
    """The table of a stream by its newest schema; columns that came later are NULL in earlier rows."""
    _, schema = SchemaLog(spark, schema_root).newest()
    return None if schema is None else spark.read.schema(schema).parquet(table_root).drop("batch")
