"""De-duplication by key with a total, repeatable order.

``dropDuplicates([key])`` keeps an arbitrary row. Here the kept row is the
greatest by ``order_by`` and then by every other column, so two runs (or a
retried task) keep the same row. It is one aggregation: ``max`` over a struct
is combined map-side (partial aggregation), so a key holding a third of the
rows is reduced to one row per input partition before the shuffle -- a
window with ``row_number`` would instead send all of those rows to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tierlake.session import scratch_path

# so many repeated keys are sent to every task (a few MB); with more, all rows are dealt by key
FEW_KEYS = 100_000


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    keys = list(keys)
    order_by = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    if not order_by and not rest:
        return df.select(*keys).distinct()
    packed = F.struct(*[F.col(c) for c in order_by + rest])
    best = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col("_best").getField(c).alias(c) for c in df.columns])


def repeated_keys(df: DataFrame, key: str) -> tuple[DataFrame, int]:
    """The values of ``key`` (NULL is one) that more than one row has, stored, and their number.
    A job that shuffles the keys alone."""
    spark = df.sparkSession
    repeated = df.groupBy(key).count().where("count > 1").select(key)
    path = scratch_path(spark, "repeated-keys")
    seen = Observation()
    repeated.observe(seen, F.count(F.lit(1)).alias("keys")).write.parquet(path)
    stored = spark.read.schema(repeated.schema).parquet(path)
    try:
        return stored, int(seen.get["keys"])
    except Py4JJavaError:   # not reported where AQE replaced an empty plan
        return stored, stored.count()


def dedupe_stored(df: DataFrame, key: str, order_by: Sequence[str] = (), few: int = FEW_KEYS) -> DataFrame:
    """The rows of ``dedupe_latest(df, [key], order_by)``, for a stored ``df``: it is read twice.

    The repeated keys are looked for first; where there are few, only their rows are
    de-duplicated and the others, each the only row of its key, are not shuffled at all.
    """
    repeated, n = repeated_keys(df, key)
    if n > few:
        return dedupe_latest(df, [key], order_by)
    if n == 0:
        return df
    # at most ``few`` values, whatever the size of the table
    repeated = F.broadcast(repeated.withColumnRenamed(key, "_repeated"))
    same = F.col(key).eqNullSafe(F.col("_repeated"))
    again = dedupe_latest(df.join(repeated, same, "left_semi"), [key], order_by)
    return df.join(repeated, same, "left_anti").unionByName(again)
