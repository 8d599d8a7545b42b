"""Batch readers for landing files.

* Files are found and their first lines read by Spark jobs; the driver opens
  none of them, it only holds one path per file it is about to read.
* CSV files of one directory can carry different headers (a column added or
  dropped over time). One Spark CSV read parses every file with ONE header, by
  position, and silently shifts values. Files are therefore grouped by their
  header line, each group is read with its own header, and the groups are
  unioned by column name.
* JSON lines are parsed into VARIANT; the columns of each file are discovered by
  a distributed schema aggregate, so columns outside the contract are kept.
* With a contract, values are read as text first and converted afterwards. What
  does not convert, and lines that do not fit their header, stay in the column
  ``_rescued``: pairs of column and raw text (``_line`` for a whole line).
"""

from __future__ import annotations

import csv
import io
import re
from collections import OrderedDict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.sources.contracts import RESCUED, describe_drift, field_type, typed_text
from tierlake.sources.specs import Contract

FORMATS = ("csv", "json", "parquet")
LINE = "_line"                  # name under which a whole line is rescued
_CORRUPT = "_unfit_line"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def _decoded(file_path: Column) -> Column:
    """A ``_metadata.file_path`` (percent-encoded) as a path that a reader takes."""
    return F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))


def landing_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, file, length, modified) of every file under ``path``, without opening one.

    ``file`` is the name the readers record as ``_source_file``. Hidden, ``_`` and
    empty files are left out; a missing folder has no files.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], "path string, file string, length long, modified timestamp")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select(_decoded(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_size").alias("length"),
                        F.col("_metadata.file_modification_time").alias("modified")).where("length > 0")


def list_files(spark: SparkSession, path: str, suffix: str | None = None) -> list[str]:
    """Paths of the data files under ``path``, sorted."""
    found = landing_files(spark, path)
    if suffix:
        found = found.where(F.col("path").endswith(suffix))
    return sorted(r["path"] for r in found.select("path").collect())


def first_lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(path, line): the first line that is not blank of every file, found by a Spark job."""
    lines = spark.read.text(list(files)).select(
        F.col("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    # a file's first block is read by one task, in order
    head = lines.withColumn("at", F.monotonically_increasing_id()).where("start = 0 AND trim(value) <> ''")
    return head.groupBy("file").agg(F.min_by("value", "at").alias("line")).select(
        _decoded(F.col("file")).alias("path"), F.regexp_replace("line", "^\\ufeff", "").alias("line"))


def header_groups(spark: SparkSession, files: Sequence[str], sep: str = ",") -> "OrderedDict[tuple, list[str]]":
    """Files grouped by their parsed header line, in the order of each group's first file."""
    if not files:
        return OrderedDict()
    grouped = first_lines(spark, files).groupBy("line").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    groups: OrderedDict[tuple, list[str]] = OrderedDict()
    for row in sorted(grouped, key=lambda r: r["paths"][0]):
        header = tuple(h.strip() for h in next(csv.reader(io.StringIO(row["line"]), delimiter=sep), []))
        groups.setdefault(header, []).extend(row["paths"])
    return groups


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _named(where: str, groups: dict, files: Sequence[str]) -> str:
    return where if len(groups) == 1 else f"{where} ({len(files)} files like {files[0]})"


def _rescuing(df: DataFrame, contract: Contract, line: Column) -> DataFrame:
    """Text columns as the contract's types; what does not convert goes to ``_rescued``."""
    typed, lost = [], [F.when(line.isNotNull(), F.struct(F.lit(LINE).alias("column"), line.alias("raw")))]
    props = contract.get("properties", {})
    for c in df.columns:
        if c in (_CORRUPT, "_source_file"):
            continue
        if c in props and not isinstance(field_type(props[c]), T.StringType):
            value = typed_text(_column(c), props[c])
            typed.append(value.alias(c))
            lost.append(F.when(_column(c).isNotNull() & value.isNull(),
                               F.struct(F.lit(c).alias("column"), _column(c).alias("raw"))))
        else:
            typed.append(_column(c))
    kept = F.filter(F.array(*lost), lambda x: x.isNotNull())
    return df.select(*typed, "_source_file", F.when(F.size(kept) > 0, kept).alias(RESCUED))


def _read_csv(spark: SparkSession, files: Sequence[str], contract: Contract | None, where: str,
              sep: str = ",") -> tuple[DataFrame, list[str]]:
    parts, drift = [], []
    groups = header_groups(spark, files, sep)
    for header, group in groups.items():
        if contract is not None:
            drift += describe_drift(header, contract, _named(where, groups, group))
    for header, group in groups.items():
        reader = spark.read.option("header", "true").option("sep", sep)
        if contract is not None:
            text = T.StructType([T.StructField(c, T.StringType()) for c in (*header, _CORRUPT)])
            reader = (reader.schema(text).option("enforceSchema", "false")
                      .option("columnNameOfCorruptRecord", _CORRUPT))
        else:
            reader = reader.option("inferSchema", "true")
        df = reader.csv(group)
        parts.append(df.select(*[_column(c) for c in df.columns],
                               F.col("_metadata.file_path").alias("_source_file")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return (out if contract is None else _rescuing(out, contract, F.col(_CORRUPT))), drift


def json_columns(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(path, columns): the top-level names that occur in each file of JSON lines, sorted.

    Every record is parsed into VARIANT; a file's schema is one aggregate, combined map-side.
    """
    lines = spark.read.text(list(files)).select(F.try_parse_json("value").alias("v"), F.col("_metadata.file_path").alias("file"))
    shape = F.schema_of_variant_agg(F.when(_is_object("v"), F.col("v")))
    found = lines.groupBy("file").agg(shape.alias("shape")).collect()   # one row per file
    rows = [(r["file"], sorted(_object_names(r["shape"]))) for r in found]
    return spark.createDataFrame(rows, "file string, columns array<string>").select(
        _decoded(F.col("file")).alias("path"), "columns")


def _is_object(v: str) -> Column:
    return F.schema_of_variant(v).startswith("OBJECT<")


def _object_names(shape: str | None) -> list[str]:
    """Names at the top level of a variant schema such as ``OBJECT<a: BIGINT, `b c`: STRING>``."""
    if not shape or not shape.startswith("OBJECT<"):
        return []
    fields = T._parse_datatype_string(re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda m: m[1] or "STRUCT<", shape))
    return fields.names


def _read_json(spark: SparkSession, files: Sequence[str], contract: Contract | None,
               where: str) -> tuple[DataFrame, list[str]]:
    if contract is None:
        df = spark.read.json(list(files))
        return df.withColumn("_source_file", F.col("_metadata.file_path")), []
    groups: OrderedDict[tuple, list[str]] = OrderedDict()
    for r in sorted(json_columns(spark, files).collect()):
        groups.setdefault(tuple(r["columns"]), []).append(r["path"])
    drift = []
    for columns, group in groups.items():
        drift += describe_drift(columns, contract, _named(where, groups, group))
    names = list(dict.fromkeys([*contract.get("properties", {}), *sorted({c for g in groups for c in g})]))
    names = [c for c in names if any(c in g for g in groups)]
    lines = spark.read.text(list(files)).where("trim(value) <> ''").select(
        "value", F.col("_metadata.file_path").alias("_source_file"), F.try_parse_json("value").alias("_v"))
    text = lines.select(*[_text_of("_v", c).alias(c) for c in names], "_source_file",
                        F.when(~F.coalesce(_is_object("_v"), F.lit(False)), F.col("value")).alias(_CORRUPT))
    return _rescuing(text, contract, F.col(_CORRUPT)), drift


def _text_of(v: str, name: str) -> Column:
    """A member of an object as text; lists and objects as JSON."""
    if "'" in name and '"' in name:   # a path can't spell both quotes
        return F.element_at(F.col(v).try_cast("map<string, variant>"), F.lit(name)).try_cast("string")
    quote = '"' if "'" in name else "'"
    return F.try_variant_get(v, f"$[{quote}{name}{quote}]", "string")


def read_files(spark: SparkSession, files: Sequence[str], file_format: str, contract: Contract | None = None,
               where: str = "landing") -> tuple[DataFrame, list[str]]:
    """The named files as (rows with ``_source_file``, drift messages against the contract).

    A file without a required column raises ``SchemaBreak``, however many others have it.
    """
    if file_format not in FORMATS:
        raise ValueError(f"Unsupported file format: {file_format}")
    if file_format == "csv":
        return _read_csv(spark, files, contract, where)
    if file_format == "json":
        return _read_json(spark, files, contract, where)
    df = spark.read.option("mergeSchema", "true").parquet(*files)
    drift = describe_drift(df.columns, contract, where) if contract else []
    return df.withColumn("_source_file", F.col("_metadata.file_path")), drift


def read_landing(spark: SparkSession, path: str, file_format: str,
                 contract: Contract | None = None) -> DataFrame:
    """Read a landing directory in ``file_format`` (S1-S4) with ``_source_file``.

    Drift is not judged here (see ``read_files``): whatever columns there are, are read.
    """
    if file_format not in FORMATS:
        raise ValueError(f"Unsupported file format: {file_format}")
    files = list_files(spark, path)
    if not files:
        raise FileNotFoundError(f"no landing files under {path}")
    lenient = {**contract, "required": []} if contract else None
    return read_files(spark, files, file_format, lenient)[0]
