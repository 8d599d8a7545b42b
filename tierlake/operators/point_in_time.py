"""Point-in-time lookup: the dimension version that was valid when a fact happened.

A version is valid in ``[from, to)``; an open one has no end. A range join by
itself compares every fact of a key with every version of it. Here time is cut
into buckets of equal length: a version is listed in each bucket it touches
within the facts' time span, a fact falls into one, and both meet in an
equi-join on (key, bucket) with the exact bounds checked behind it. A key with a
large share of the facts is dealt over its buckets, and within a bucket AQE
splits it further (plain equi-join, facts preserved).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BUCKET = "_bucket"


def lookup_valid(facts: DataFrame, versions: DataFrame, key: str, at: str, valid_from: str, valid_to: str,
                 columns: list[str], buckets: int = 64) -> DataFrame:
    """``facts`` with ``columns`` of the version of ``key`` that is valid at ``at``.

    Facts without a key, a time or a valid version keep NULLs. Versions of a key must
    not overlap. ``valid_to`` NULL means still valid. ``buckets``: number of equal cuts of
    the facts' time span; a version is listed at most that often.
    """
    def second(c: str):
        return F.unix_micros(F.col(c).cast("timestamp"))

    span = facts.agg(F.min(second(at)).alias("low"), F.max(second(at)).alias("high")).first()
    if span["low"] is None:
        return facts.select("*", *[F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in columns])
    low, high = span["low"], span["high"]
    width = (high - low) // buckets + 1
    first = F.greatest(second(valid_from), F.lit(low))
    last = F.least(F.coalesce(second(valid_to) - 1, F.lit(high)), F.lit(high))
    listed = versions.where(F.col(key).isNotNull() & (first <= last)).select(
        F.col(key).alias("_key"), second(valid_from).alias("_from"), second(valid_to).alias("_to"),
        *[F.col(c).alias("_v_" + c) for c in columns],
        F.explode(F.sequence(F.floor((first - low) / width), F.floor((last - low) / width))).alias(_BUCKET))
    placed = facts.withColumn("_at", second(at)).withColumn("_fact_bucket", F.floor((F.col("_at") - low) / width))
    hit = ((placed[key] == listed["_key"]) & (placed["_fact_bucket"] == listed[_BUCKET]) & (listed["_from"] <= placed["_at"])
           & (listed["_to"].isNull() | (placed["_at"] < listed["_to"])))
    return placed.join(listed, hit, "left").select(
        *[placed[c] for c in facts.columns], *[listed["_v_" + c].alias(c) for c in columns])
