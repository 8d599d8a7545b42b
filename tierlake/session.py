"""Spark session settings and shared-storage locations.

The library never creates its own cluster resources: a caller hands in a
``SparkSession``. ``local_session`` is only for tests, the bench and the
examples; on a cluster the session comes from the platform.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of the library relies on. They are plan-level, not
# cluster sizing: AQE re-plans joins from runtime sizes (broadcast only when
# the measured side is under the threshold), coalesces small shuffle
# partitions and splits skewed ones.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast decided at run time from the measured size of the materialized
    # side; beyond it the join stays sort-merge
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tierlake") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIERLAKE_DRIVER_MEMORY", "8g"))
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the plan-level defaults on an existing session (runtime confs only)."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files are deleted as soon as the action that wrote them ends.

    Otherwise they stay until the driver's JVM collects its garbage, so a chain of jobs
    holds the shuffles of all of them. For jobs that store their results: a DataFrame
    that is run again shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only when neither is set -- a laptop or a test -- a
    fresh local folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tierlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir.

    Used for intermediate tables that cut lineage or stage files; it lives
    on the same shared storage as checkpoints, never on an executor's disk.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tierlake/{name}-{uuid.uuid4().hex[:12]}"
