"""tierlake: layered (bronze / silver / gold) retail lakehouse operators for Spark.

Every operator is a DataFrame -> DataFrame function built from Spark's
built-in expressions; the same code runs on a laptop sample and a cluster.
The most used entry points are re-exported here.
"""

from tierlake.operators.changes import snapshot_changes
from tierlake.operators.dedupe import dedupe_latest
from tierlake.operators.expectations import (
    CRITICAL, WARNING, Expectations, QualityError, apply_expectations, apply_row_policies,
    assert_no_critical,
)
from tierlake.operators.joins import left_join_dim
from tierlake.operators.scd2 import (
    current_rows, scd2_from_feed, scd2_initial, scd2_merge, scd2_merge_current,
)
from tierlake.operators.upsert import rows_to_insert, upsert_insert_only
from tierlake.plans.layers import RunContext, run_bronze, run_gold, run_layers, run_silver
from tierlake.plans.rules import RULE_SETS, build_checker
from tierlake.session import apply_defaults, local_session

__version__ = "0.1.0"

__all__ = [
    "CRITICAL", "WARNING", "Expectations", "QualityError", "RULE_SETS", "RunContext",
    "apply_defaults", "apply_expectations", "apply_row_policies", "assert_no_critical",
    "build_checker", "current_rows", "dedupe_latest", "left_join_dim", "local_session",
    "rows_to_insert", "run_bronze", "run_gold", "run_layers", "run_silver", "scd2_from_feed",
    "scd2_initial", "scd2_merge", "scd2_merge_current", "snapshot_changes", "upsert_insert_only",
]
