"""Helpers shared by the operators: tables, scratch tables, components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.session import scratch_path

# Word rule of the contracts: runs of anything but ASCII white space. On UTF-8
# bytes, ``bytes.split()`` separates at exactly these six characters.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor costs a re-read of files, not a recompute.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def stored_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``stored``, dealt by ``key`` once: joins on it move only the other side.

    The files are a bucketed table, as many buckets as shuffle partitions.
    """
    spark = df.sparkSession
    path, buckets = scratch_path(spark, name), int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = f"scratch_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).option("path", path).saveAsTable(held)
    out = spark.table(held)
    out._scratch, out._table = path, held
    return out


def drop_stored(*frames: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more: all that came from them is stored itself."""
    for df in frames:
        path = getattr(df, "_scratch", None)
        if path is None:
            continue
        if getattr(df, "_table", None):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._table}")
        jvm = df.sparkSession.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


# Bounds of one batch sent to a Python worker. Texts may be long and an executor
# runs several workers; by rows alone a batch could hold many times its share.
BATCH_BOUNDS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
                "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def bounded_batches(spark: SparkSession) -> None:
    """Bound the batches of Python workers, where the session sets no bounds itself."""
    for name, value in BATCH_BOUNDS.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def spare(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (input columns may clash)."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = "_" + name
    return name


def room_for(df: DataFrame, added: list[str], *used: str) -> tuple:
    """``df`` with its columns named like ``added`` ones renamed by leading
    underscores, so that nothing of the input is lost; then the names that the
    ``used`` columns have now."""
    taken = {c.lower() for c in added}
    now = {}
    for c in df.columns:
        if c.lower() in taken:
            name = "_" + c
            while name.lower() in {x.lower() for x in df.columns} | taken:
                name = "_" + name
            df, now[c.lower()] = df.withColumnRenamed(c, name), name
    return df, *(now.get(u.lower(), u) for u in used)


def in_order(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` (stored) with its rows ordered by ``order``, nulls first, in each ``group``.

    Adds long columns: row (unique, rising in the order), before (row of the
    group's row before, null for its first) and nth (place in the group, from 1).
    Rows are dealt to tasks by ranges of (group, order), so a group of any size
    is spread over tasks; only the sizes of the groups cut by a border between
    two tasks are added up, at most two rows a task.
    """
    ranged = (df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
              .withColumn("row", F.monotonically_increasing_id()))
    ranged = stored(ranged, "in-order")
    part = F.shiftright("row", 33)
    runs = ranged.groupBy(group, part.alias("part")).agg(
        F.min("row").alias("first"), F.max("row").alias("last"), F.count(F.lit(1)).alias("n"))
    # a group seen by one task needs nothing from others; those of several tasks are few (at most two a task)
    several = runs.withColumn("parts", F.count(F.lit(1)).over(Window.partitionBy(group))).where("parts > 1")
    ahead = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = several.select("first", F.max("last").over(ahead).alias("tail"),
                           F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    starts = runs.select(group, "part", "first").join(carry, "first", "left").select(
        F.col(group).alias("_g"), F.col("part").alias("_p"), "first", "tail", F.coalesce("ahead", F.lit(0)).alias("ahead"))
    out = ranged.join(starts, (F.col(group) == F.col("_g")) & (part == F.col("_p")))
    return out.select(*df.columns, "row", F.when(F.col("row") == F.col("first"), F.col("tail")).otherwise(
        F.col("row") - 1).alias("before"), (F.col("row") - F.col("first") + 1 + F.col("ahead")).alias("nth"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(src, dst) links -> (node, component = smallest reachable node).

    Alternating large-star and small-star steps. Every step is one grouped
    minimum (combined map-side, so a hub does not gather its neighbours in one
    task) and one join; the number of rounds grows with the logarithm of the
    longest chain. Each round's links are checkpointed in the shared folder.
    Raises if the links are not settled after ``max_rounds``.
    """
    links = (edges.select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
             .where("hi <> lo").distinct().checkpoint())
    for _ in range(max_rounds):
        # large star: every neighbour above a node is tied to the node's minimum
        both = links.select(F.col("hi").alias("n"), F.col("lo").alias("m")).union(
            links.select(F.col("lo").alias("n"), F.col("hi").alias("m")))
        low = both.groupBy("n").agg(F.min("m").alias("least")).select(
            "n", F.least("n", "least").alias("least"))
        large = (both.join(low, "n").where("m > n")
                 .select(F.col("m").alias("hi"), F.col("least").alias("lo")).distinct())
        # small star: a node and all its smaller neighbours are tied to the least
        least = large.groupBy("hi").agg(F.min("lo").alias("least"))
        small = (large.join(least, "hi")
                 .select(F.explode(F.array(F.struct(F.col("hi").alias("hi"), F.col("least").alias("lo")),
                                           F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo")))).alias("e"))
                 .select("e.*").where("hi <> lo").distinct().checkpoint())
        settled = _same(links, small)
        links = small
        if settled:
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
                links.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()
    raise RuntimeError(f"links not settled after {max_rounds} rounds")


def _same(a: DataFrame, b: DataFrame) -> bool:
    """Whether two small link sets are equal: count and two order-free sums."""
    def mark(df: DataFrame):
        h = F.xxhash64("hi", "lo")
        return df.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")),
                      F.bit_xor(h)).first()
    return tuple(mark(a)) == tuple(mark(b))
