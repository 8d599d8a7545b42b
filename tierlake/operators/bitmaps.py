"""Exact distinct counts that can be merged (A3).

A set of ids is kept as bitmaps over a dense numbering: one 4 KB bitmap per
32,768 numbers. Bitmaps of days are OR-ed into months and years, so a coarser
exact count reads the stored daily bitmaps and never the fact again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NUMBER, BUCKET, BITMAP = "_number", "bucket", "ids"


def number_values(df: DataFrame, column: str) -> DataFrame:
    """(value, _number): the distinct values of ``column`` numbered 0, 1, 2... in their order.

    Ranges of values are numbered side by side; only the sizes of the ranges (one
    row a task) are added up. NULL is no value. The result is checkpointed: the
    numbering must be the same wherever it is used.
    """
    ranged = (df.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct()
              .repartitionByRange("value").sortWithinPartitions("value")
              .withColumn("_at", F.monotonically_increasing_id()).checkpoint())
    part = F.shiftright("_at", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))   # one row a task
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_ahead"))
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(F.broadcast(offsets), part == F.col("_part")).select(
        "value", (within + F.col("_ahead")).alias(NUMBER))


def value_bitmaps(df: DataFrame, keys: Sequence[str | Column], column: str, numbers: DataFrame) -> DataFrame:
    """Per key and number range, the bitmap of the values of ``column``; NULL adds nothing."""
    named = df.join(numbers, F.col(column) == F.col("value"))
    return (named.groupBy(*keys, F.bitmap_bucket_number(NUMBER).alias(BUCKET))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias(BITMAP)))


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of finer keys as bitmaps of coarser ones."""
    return bitmaps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def count_bitmaps(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The exact number of distinct values per key."""
    return merge_bitmaps(bitmaps, keys).groupBy(*keys).agg(F.sum(F.bitmap_count(BITMAP)).alias(name))
