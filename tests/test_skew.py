"""Skew: a third of the rows on one key (or on NULL) must not land in one task."""

import contextlib

from pyspark.sql import functions as F

from tierlake.operators.dedupe import dedupe_latest
from tierlake.operators.joins import left_join_dim


@contextlib.contextmanager
def confs(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _fact(spark, n=30_000):
    # a third NULL keys, a third on key 1, the rest spread over 2..1000
    k = (F.when(F.col("id") % 3 == 0, F.lit(None))
         .when(F.col("id") % 3 == 1, F.lit(1))
         .otherwise(F.col("id") % 999 + 2)).cast("long")
    return spark.range(n).select(k.alias("k"), F.col("id").alias("amount"))


def _dim(spark):
    return spark.range(1, 1001).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name"))


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def _max_share_of_null_rows(df):
    per = (df.filter(F.col("k").isNull()).groupBy(F.spark_partition_id().alias("p")).count()
           .agg(F.max("count"), F.sum("count")).first())
    return per[0] / per[1]


def test_null_keys_are_spread_over_reducers(spark):
    with confs(spark, **NO_BROADCAST):
        fact, dim = _fact(spark), _dim(spark)
        spread = left_join_dim(fact, dim, "k")
        plain = fact.join(dim, "k", "left")
        assert spread.count() == plain.count() == 30_000
        assert _max_share_of_null_rows(plain) == 1.0          # all NULL keys in one task
        assert _max_share_of_null_rows(spread) < 0.5          # spread over the reducers
        assert spread.filter(F.col("k").isNull() & F.col("name").isNotNull()).count() == 0


def test_hot_key_is_split_by_aqe(spark):
    with confs(spark, **NO_BROADCAST, **{
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }):
        out = left_join_dim(_fact(spark), _dim(spark), "k")
        assert len(out.collect()) == 30_000
        plan = out._jdf.queryExecution().executedPlan().toString()   # the final adaptive plan
        assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan


def test_dedupe_combines_map_side(spark):
    df = _fact(spark).withColumn("v", F.col("amount") % 7)
    out = dedupe_latest(df, ["k"], ["amount"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    got = {r.k: r.amount for r in out.collect()}
    assert got[1] == max(i for i in range(30_000) if i % 3 == 1)
    assert got[None] == 29_997
