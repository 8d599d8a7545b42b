"""Rule results from states that can be merged.

The state of a rule set over some rows is small and additive: a count per row
rule, the number of rows, and for a uniqueness rule a count per value. A table
that grows by partitions keeps one state per partition; a run evaluates only the
partitions it has not seen and adds the states up. Referential rules depend on
another table and are evaluated on the whole, not from states.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.operators.expectations import Rule, _failing, _row
from tierlake.sources import tables

STATE = "rule int, value string, n long"   # rule: place in the rule set, -1 for the number of rows


def _checked(rules: list[Rule]) -> None:
    wrong = [r.name for r in rules if r.kind not in ("row", "row_count_min", "unique")]
    if wrong:
        raise ValueError(f"not evaluated from states: {', '.join(wrong)}")


def rule_state(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The state of ``rules`` over ``df``: one aggregate for all counters, one group-by per uniqueness rule."""
    _checked(rules)
    row_rules = [(i, r) for i, r in enumerate(rules) if r.kind == "row"]
    counted = df.agg(F.count(F.lit(1)).alias("_all"), *[F.count_if(_failing(df, r)).alias(f"_r{i}") for i, r in row_rules])
    none = F.lit(None).cast("string").alias("value")
    entry = lambda i, c: F.struct(F.lit(i).alias("rule"), none, F.col(c).cast("long").alias("n"))
    out = counted.select(F.inline(F.array(entry(-1, "_all"), *[entry(i, f"_r{i}") for i, _ in row_rules])))
    for i, r in enumerate(rules):
        if r.kind == "unique":
            out = out.unionByName(df.groupBy(F.col(r.column).cast("string").alias("value")).agg(
                F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("rule"), "value", "n"))
    return out


def merge_states(states: DataFrame) -> DataFrame:
    """States of disjoint rows as the state of all of them."""
    return states.groupBy("rule", "value").agg(F.sum("n").alias("n"))


def results_of(state: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rule results (as of a direct evaluation) from a state; it need not be merged before."""
    merged = merge_states(state)
    # a value that stands n times is n - 1 rows too many; the other counters hold one entry per rule
    unique = [i for i, r in enumerate(rules) if r.kind == "unique"]
    worth = F.when(F.col("rule").isin(unique), F.col("n") - 1).otherwise(F.col("n")) if unique else F.col("n")
    total = merged.groupBy("rule").agg(F.sum(worth).alias("n")).agg(F.map_from_entries(
        F.collect_list(F.struct("rule", "n"))).alias("m"))   # one entry per rule
    count = lambda i: F.coalesce(F.element_at("m", F.lit(i)), F.lit(0))
    structs = [_row(r, F.greatest(F.lit(r.min_rows) - count(-1), F.lit(0)) if r.kind == "row_count_min" else count(i))
               for i, r in enumerate(rules)]
    return total.select(F.inline(F.array(*structs)))


def evaluate_new(spark: SparkSession, root: str, parts: Mapping[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """Results over all partitions ever evaluated; only those of ``parts`` without a stored state are read."""
    for name, df in parts.items():
        path = f"{root.rstrip('/')}/part={name}"
        if not tables.exists(spark, f"{path}/_SUCCESS"):
            rule_state(df, rules).write.mode("overwrite").parquet(path)
    return results_of(spark.read.schema(STATE).parquet(f"{root.rstrip('/')}/part=*"), rules)
