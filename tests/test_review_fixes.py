"""Faults found in review, each held by a small case."""

import datetime as dt
from decimal import Decimal

import pytest

from tierlake.operators.expectations import Expectations
from tierlake.operators.scd2 import scd2_merge
from tierlake.plans.silver import SALES_COLUMNS, build_fact_sales
from tierlake.session import ensure_checkpoint_dir
from tierlake.sources import contracts as C
from tierlake.sources import tables


def _fact(spark, price, quantity, discount):
    given = {"transaction_id": 1, "quantity": quantity, "unit_price": price, "discount_pct": discount,
             "transaction_date": "2024-01-01 00:00:00"}
    cols = [*SALES_COLUMNS, "_ingested_at", "_source_file"]
    kinds = {"transaction_id": "long", "quantity": "int", "unit_price": "decimal(38,10)", "discount_pct": "decimal(38,10)"}
    row = tuple(given.get(c) for c in dict.fromkeys(cols))
    schema = ", ".join(f"`{c}` {kinds.get(c, 'string')}" for c in dict.fromkeys(cols))
    return build_fact_sales(spark.createDataFrame([row], schema)).first()


def test_prices_are_rounded_after_multiplying(spark):
    assert _fact(spark, Decimal("0.0349"), 1000, None).gross_amount == Decimal("34.90")


def test_large_amounts_are_kept(spark):
    assert _fact(spark, Decimal("9000000000"), 2, None).net_amount == Decimal("18000000000.00")


def test_discounts_keep_their_decimals(spark):
    row = _fact(spark, Decimal("1000"), 1, Decimal("12.345"))
    assert row.discount_amount == Decimal("123.45") and row.discount_pct == Decimal("12.345")


def test_versions_keep_null_keys_and_lost_columns(spark):
    first = spark.createDataFrame([(1, "a", "x"), (None, "n", "y")], "k int, v string, extra string")
    second = spark.createDataFrame([(1, "b"), (None, "n")], "k int, v string")
    one = scd2_merge(None, first, "k", ["v"], "2024-01-01")
    two = scd2_merge(one, second, "k", ["v"], "2024-02-01")
    again = scd2_merge(two, second, "k", ["v"], "2024-03-01")
    assert two.where("k is null").count() == again.where("k is null").count() == 1
    assert {(r.v, r.extra) for r in two.collect()} == {("a", "x"), ("b", None), ("n", "y")}


def test_replay_reads_the_state_before_the_run(spark, tmp_root):
    schema = "k int, v string, scd_is_current boolean"
    tables.write_versions_run(spark.createDataFrame([(1, "a", True)], schema), tmp_root, "r1")
    tables.write_versions_run(spark.createDataFrame([(1, "a", False), (1, "b", True)], schema), tmp_root, "r2")
    assert [r.v for r in tables.read_current_versions(spark, tmp_root, before="r2").collect()] == ["a"]
    assert tables.read_current_versions(spark, tmp_root, before="r1") is None


def test_drift_names_every_column():
    contract = {"required": ["a"], "properties": {"a": {"type": "integer"}, "b": {"type": "string"}}}
    assert C.drift_rows(["a", "c"], contract) == [("b", "omitted"), ("c", "added")]
    with pytest.raises(C.SchemaBreak):
        C.describe_drift(["b"], contract, "f1")


def test_a_text_that_is_no_number_fails_its_own_rule_only(spark):
    df = spark.createDataFrame([("abc", 1), ("5", 2)], "t string, n int")
    report = Expectations("s").expect_column_min("t", 1).expect_no_nulls("n").run(df)
    assert [(r["failed_count"], r["passed"]) for r in report.results] == [(1, False), (0, True)]


def test_one_name_with_two_severities_gives_two_results(spark):
    df = spark.createDataFrame([(None,)], "n int")
    report = Expectations("s").expect_no_nulls("n", "CRITICAL").expect_no_nulls("n", "WARNING").run(df)
    assert [r["severity"] for r in report.results] == ["CRITICAL", "WARNING"]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(type("S", (), {"sparkContext": Context()})())
