"""Row-level changes between two snapshots of a keyed table.

The reference turned on a change feed on its tables without a consumer; here
the change set is computed: one full outer join on the key, NULL-safe
comparison of the remaining columns, one output row per inserted, updated or
deleted key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str],
                     compare: Sequence[str] | None = None) -> DataFrame:
    """Changes from ``old`` to ``new`` (both unique on ``keys``).

    Output: the key, ``change_type`` and the other columns (new values for
    inserts and updates, old values for deletes). Rows with a NULL key are
    not tracked.
    """
    keys = list(keys)
    # a NULL key identifies no row: such rows are not tracked (and would all
    # hash to one reducer of the join)
    known = lambda df: df.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    old, new = known(old), known(new)
    cols = [c for c in new.columns if c not in keys]
    compare = list(compare) if compare is not None else [c for c in cols if c in old.columns]
    o = old.select(*[F.col(c).alias("o_" + c) for c in keys + [c for c in cols if c in old.columns]])
    n = new.select(*[F.col(c).alias("n_" + c) for c in keys + cols])
    cond = None
    for k in keys:
        c = F.col("o_" + k) == F.col("n_" + k)
        cond = c if cond is None else cond & c
    j = o.join(n, cond, "full_outer")
    in_old = F.col("o_" + keys[0]).isNotNull()
    in_new = F.col("n_" + keys[0]).isNotNull()
    differs = F.lit(False)
    for c in compare:
        differs = differs | ~F.col("o_" + c).eqNullSafe(F.col("n_" + c))
    kind = (F.when(in_old & ~in_new, F.lit(DELETE))
            .when(~in_old & in_new, F.lit(INSERT))
            .when(differs, F.lit(UPDATE)))
    side = lambda c: F.when(in_new, F.col("n_" + c)).otherwise(
        F.col("o_" + c) if c in old.columns else F.lit(None))
    out = j.select(*[side(c).alias(c) for c in keys], kind.alias("change_type"),
                   *[side(c).alias(c) for c in cols])
    return out.filter(F.col("change_type").isNotNull())
