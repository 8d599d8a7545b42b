"""Star-schema join of a fact with a dimension.

The fact side is the big one. Dimensions are joined without a broadcast hint:
Spark (and AQE at runtime, from measured sizes) broadcasts a dimension only
when it is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise plans
a sort-merge join, so a dimension that grows with the data is never forced
into executor memory.

Skew: a NULL key of a left join never matches, but Spark still hashes all
NULL keys to one reducer. ``left_join_dim`` gives those rows a spread-out
tag instead (the dimension side always carries tag 0, so matches are
unchanged). Hot non-NULL keys are split by AQE's skew-join handling, which
supports a skewed preserved side of a left outer join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_KEY_BUCKETS = 256
_KEY, _TAG, _DIM_TAG = "_dim_key", "_null_key_tag", "_dim_tag"


def left_join_dim(fact: DataFrame, dim: DataFrame, key: str,
                  null_buckets: int = NULL_KEY_BUCKETS, spread_by: Sequence[str] = ()) -> DataFrame:
    """``fact LEFT JOIN dim USING (key)``; ``dim`` must be unique on ``key``.

    NULL keys are spread by a second join key: tag 0 for every non-NULL key on both
    sides, 1..null_buckets (a hash of the row, or of its columns ``spread_by``: the join
    then needs no others) for a NULL fact key. A NULL-key fact
    row matches nothing, whatever its tag. The dimension's tag is computed from its
    key, so the optimizer can't fold it to a constant and drop the second key; and as
    the keys are plain columns it still sees that a de-duplicated dimension has one
    row per key, and drops the join where none of its columns is used.

    With ``null_buckets=0`` the key is the only join key.
    """
    right = dim.filter(F.col(key).isNotNull()).withColumnRenamed(key, _KEY)
    rest = [right[c] for c in right.columns if c != _KEY]
    if not null_buckets:
        return fact.join(right, fact[key] == right[_KEY], "left").select(*[fact[c] for c in fact.columns], *rest)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by or fact.columns]), F.lit(null_buckets)) + 1
    left = fact.withColumn(_TAG, F.when(F.col(key).isNull(), spread).otherwise(F.lit(0).cast("long")))
    right = right.withColumn(_DIM_TAG, F.pmod(F.xxhash64(_KEY), F.lit(1)))   # always 0
    out = left.join(right, (left[key] == right[_KEY]) & (left[_TAG] == right[_DIM_TAG]), "left")
    return out.select(*[left[c] for c in fact.columns], *[right[c] for c in dim.columns if c != key])
