"""Headline queries at one scale factor; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 BENCH_RUNS=5 python bench.py

Each query is forced to completion with the ``noop`` sink (no collect to
the driver): one warm-up, then the median of BENCH_RUNS timed runs. The
end-to-end layered run (files -> bronze -> silver -> gold with checks) is
timed once, since it writes a new lake each time.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tierlake import catalog  # noqa: E402
from tierlake.session import local_session  # noqa: E402

HEADLINE = (
    "fact_sales",                   # de-dup (partial aggregation) + exact money measures
    "obt_sales",                    # star join, 3 dimensions, NULL-key spreading
    "agg_daily_sales",              # flagship: OBT -> daily KPIs
    "agg_monthly_sales_reference",  # daily -> monthly (reference semantics)
    "agg_monthly_sales_exact",      # monthly recomputed from OBT (exact distinct)
    "expect_bronze_sales",          # 12 rules: one fused aggregate + one group-by
    "expect_report",                # all 11 rule sets over every layer
    "scd2_from_feed",               # ordered change feed -> versions (skew-safe)
    "scd2_merge_null_safe",         # snapshot merge into SCD2
    "snapshot_changes",             # change set between snapshots
    "upsert_insert_only",           # insert-only merge
    "kpi_cohort",                   # cohort retention
    "kpi_clv",                      # customer lifetime value
)


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    spark = local_session(cpus, shuffle_partitions=partitions, app_name="tierlake-bench")
    queries = {}
    for name in HEADLINE:
        q = catalog.QUERIES[name]
        run_noop(q(spark, sf_dir))  # warm-up
        times = [timed(lambda: run_noop(q(spark, sf_dir))) for _ in range(runs)]
        queries[name] = round(statistics.median(times), 3)
    queries["lake_end_to_end"] = round(timed(lambda: catalog.run_lake(spark, sf_dir)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": float(m.group(1)) if m else sf_dir,
        "runs": runs,
        "spark": spark.version,
        "cores": cpus,
        "shuffle_partitions": partitions,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
