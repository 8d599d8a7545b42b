"""Roll-ups kept up to date from changes (S17 -> A1, A2).

Sums could be corrected by differences, distinct counts and averages can not: a
removed row may or may not have been a customer's last. So the groups that a
change touches, by its old or its new values, are dropped and computed anew
from the rows of those groups only; all others are carried over as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def touched_groups(old: DataFrame, new: DataFrame, row_key: str, group: Sequence[str]) -> DataFrame:
    """Distinct groups in which rows differ between two states of a keyed table.

    A row counts by its content: a hash per row on either side, compared by one full
    outer join on the key that carries nothing but the hash and the group.
    """
    def mark(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(row_key).alias(f"{name}_key"), F.xxhash64(*sorted(df.columns)).alias(f"{name}_mark"),
                         F.struct(*group).alias(f"{name}_group"))

    joined = mark(old, "o").join(mark(new, "n"), F.col("o_key") == F.col("n_key"), "full_outer")
    changed = joined.where(~F.col("o_mark").eqNullSafe(F.col("n_mark")))
    return changed.select(F.explode(F.array("o_group", "n_group")).alias("g")).where("g IS NOT NULL").select("g.*").distinct()


def refresh_rollup(rollup: DataFrame, rows: DataFrame, touched: DataFrame, group: Sequence[str],
                   aggregate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rollup`` after a change: groups in ``touched`` recomputed from ``rows``, the rest untouched.

    ``rollup`` holds one row per group of ``group`` columns; NULL is a group value like any other.
    """
    marks = touched.select(*[F.col(c).alias("_t_" + c) for c in group])

    def same(df: DataFrame):
        cond = None
        for c in group:
            one = df[c].eqNullSafe(marks["_t_" + c])
            cond = one if cond is None else cond & one
        return cond

    kept = rollup.join(marks, same(rollup), "left_anti")
    anew = aggregate(rows.join(marks, same(rows), "left_semi"))
    return kept.unionByName(anew.select(*rollup.columns))
