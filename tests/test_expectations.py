"""Rule behaviours: one base row, one field overridden per case (explicit schemas)."""

import pytest
from pyspark.sql import types as T

from tierlake.operators import expectations as X
from tierlake.plans.rules import build_checker

SALES_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("discount_pct", T.DoubleType()),
    T.StructField("channel", T.StringType()),
    T.StructField("payment_method", T.StringType()),
])
BASE_SALE = dict(transaction_id="TXN-00001", product_id="PRD-1001", quantity=2, unit_price=29.99,
                 discount_pct=0.0, channel="in_store", payment_method="credit_card")

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("loyalty_tier", T.StringType()),
    T.StructField("loyalty_points", T.LongType()),
])
BASE_CUSTOMER = dict(customer_id="CUST-001", email="ana@mail.test", loyalty_tier="Gold", loyalty_points=500)

FACT_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("date_id", T.IntegerType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("net_amount", T.DoubleType()),
    T.StructField("gross_amount", T.DoubleType()),
    T.StructField("discount_pct", T.DoubleType()),
])
BASE_FACT = dict(transaction_id="TXN-00001", product_id="PRD-1001", date_id=20240101, quantity=2,
                 net_amount=55.00, gross_amount=59.98, discount_pct=0.0)

DIM_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("loyalty_tier", T.StringType()),
    T.StructField("loyalty_points", T.LongType()),
    T.StructField("scd_effective_from", T.DateType()),
    T.StructField("scd_effective_to", T.DateType()),
    T.StructField("scd_is_current", T.BooleanType()),
])


def frame(spark, schema, base, *overrides):
    rows = [tuple({**base, **o}[f.name] for f in schema.fields) for o in (overrides or ({},))]
    return spark.createDataFrame(rows, schema)


def failed(report):
    return {r["rule_name"]: r for r in report.results if not r["passed"]}


def test_valid_sale_passes_every_rule(spark):
    report = build_checker("bronze.sales").run(frame(spark, SALES_SCHEMA, BASE_SALE))
    assert report.passed and not failed(report)
    assert len(report.results) == 12


@pytest.mark.parametrize("override, rule", [
    ({"transaction_id": None}, "no_nulls:transaction_id"),
    ({"channel": "telegram"}, "values_in_set:channel"),
    ({"quantity": -1}, "min_value:quantity>=1"),
    ({"discount_pct": 110.0}, "max_value:discount_pct<=100"),
])
def test_bronze_sales_critical_failures(spark, override, rule):
    report = build_checker("bronze.sales").run(frame(spark, SALES_SCHEMA, BASE_SALE, override))
    bad = failed(report)
    assert rule in bad and bad[rule]["severity"] == X.CRITICAL and bad[rule]["failed_count"] == 1
    assert not report.passed
    with pytest.raises(X.QualityError):
        X.assert_no_critical(report)


def test_duplicate_transaction_fails_unique(spark):
    report = build_checker("bronze.sales").run(frame(spark, SALES_SCHEMA, BASE_SALE, {}, {}))
    assert failed(report)["unique:transaction_id"]["failed_count"] == 1


def test_unknown_tier_is_only_a_warning(spark):
    report = build_checker("bronze.customers").run(
        frame(spark, CUSTOMER_SCHEMA, BASE_CUSTOMER, {"loyalty_tier": "Diamond"}))
    assert report.passed
    assert [w["rule_name"] for w in report.warnings] == ["values_in_set:loyalty_tier"]
    X.assert_no_critical(report)


def test_customer_without_id_is_critical(spark):
    report = build_checker("bronze.customers").run(
        frame(spark, CUSTOMER_SCHEMA, BASE_CUSTOMER, {"customer_id": None}))
    assert "no_nulls:customer_id" in failed(report)


@pytest.mark.parametrize("override, rule", [
    ({}, None),
    ({"date_id": None}, "no_nulls:date_id"),
    ({"net_amount": -1.0}, "min_value:net_amount>=0"),
])
def test_silver_fact_rules(spark, override, rule):
    report = build_checker("silver.fact_sales").run(frame(spark, FACT_SCHEMA, BASE_FACT, override))
    if rule is None:
        assert report.passed
    else:
        assert rule in failed(report) and not report.passed


def test_silver_customer_scd_rules(spark):
    import datetime as dt
    base = dict(customer_id="CUST-1", loyalty_tier="Gold", loyalty_points=10,
                scd_effective_from=dt.date(2024, 1, 1), scd_effective_to=dt.date(9999, 12, 31),
                scd_is_current=True)
    ok = build_checker("silver.dim_customer").run(frame(spark, DIM_CUSTOMER_SCHEMA, base))
    assert ok.passed
    bad = build_checker("silver.dim_customer").run(
        frame(spark, DIM_CUSTOMER_SCHEMA, base, {"scd_effective_from": None}))
    assert "no_nulls:scd_effective_from" in failed(bad)


def test_null_passes_set_min_and_max(spark):
    df = frame(spark, SALES_SCHEMA, BASE_SALE, {"channel": None, "discount_pct": None})
    chk = (X.Expectations("t").expect_values_in_set("channel", ["in_store"])
           .expect_column_min("discount_pct", 0).expect_column_max("discount_pct", 100))
    assert chk.run(df).passed


def test_two_null_keys_are_one_surplus_value(spark):
    df = frame(spark, SALES_SCHEMA, BASE_SALE, {"transaction_id": None}, {"transaction_id": None}, {})
    res = X.Expectations("t").expect_unique("transaction_id").run(df)
    assert res.results[0]["failed_count"] == 1


def test_missing_column_is_recorded_not_raised(spark):
    df = frame(spark, SALES_SCHEMA, BASE_SALE)
    rep = X.Expectations("t").expect_no_nulls("nope").expect_no_nulls("product_id").run(df)
    by = {r["rule_name"]: r for r in rep.results}
    assert not by["no_nulls:nope"]["passed"] and by["no_nulls:nope"]["failed_count"] == 0
    assert "not found" in by["no_nulls:nope"]["details"]
    assert by["no_nulls:product_id"]["passed"]


def test_orphan_reference_is_a_warning(spark):
    df = frame(spark, SALES_SCHEMA, BASE_SALE, {}, {"product_id": "PRD-9"}, {"product_id": None})
    ref = spark.createDataFrame([("PRD-1001",), (None,)], "product_id string")
    rep = X.Expectations("t").expect_referential_integrity("product_id", ref, "product_id").run(df)
    r = rep.results[0]
    assert r["rule_name"] == "ref_integrity:product_id->product_id"
    assert r["severity"] == X.WARNING and r["failed_count"] == 1 and rep.passed


def test_empty_table_row_count(spark):
    df = spark.createDataFrame([], SALES_SCHEMA)
    rep = X.Expectations("t").expect_row_count_min(3).run(df)
    assert rep.results[0]["failed_count"] == 3 and not rep.passed


def test_row_rules_are_one_aggregate(spark):
    """All row rules and the row count share one scan and one (single-row) exchange."""
    df = frame(spark, SALES_SCHEMA, BASE_SALE)
    chk = build_checker("bronze.sales")
    chk.rules = [r for r in chk.rules if r.kind != "unique"]
    plan = chk.results(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_report_summary(spark):
    rep = build_checker("bronze.sales").run(frame(spark, SALES_SCHEMA, BASE_SALE, {"channel": "x"}))
    s = rep.summary()
    assert s["total_rules"] == 12 and s["passed_rules"] == 11 and s["critical_failures"] == 1
    assert s["overall_passed"] is False


def test_row_policies(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, v double")
    rules = {"non_negative": "v >= 0"}
    kept, bad = X.apply_expectations(df, rules, "drop")
    assert sorted(r.id for r in kept.collect()) == [1]
    assert sorted(r.id for r in bad.collect()) == [2, 3]
    warn_kept, _ = X.apply_expectations(df, rules, "warn")
    assert warn_kept.count() == 3
    counts = {r.expectation: r.violations for r in X.violation_counts(df, rules).collect()}
    assert counts == {"non_negative": 2}
    failing, _ = X.apply_expectations(df, rules, "fail")
    with pytest.raises(Exception, match="expectation failed"):
        failing.collect()
    ok, _ = X.apply_expectations(df.filter("id = 1"), rules, "fail")
    assert ok.count() == 1


def test_custom_sql_rule_and_bad_sql(spark):
    df = frame(spark, SALES_SCHEMA, BASE_SALE, {}, {"quantity": 0})
    rep = X.Expectations("t").expect("positive_qty", "quantity > 0").expect("broken", "no_such_col > 0").run(df)
    by = {r["rule_name"]: r for r in rep.results}
    assert by["positive_qty"]["failed_count"] == 1
    assert not by["broken"]["passed"] and by["broken"]["details"]


def test_a_predicate_that_raises_fails_alone(spark):
    df = spark.createDataFrame([("1", 5), ("x", -1)], "a string, b int")
    report = (X.Expectations("t").expect("number", "CAST(a AS INT) > 0").expect_column_min("b", 0).expect("short", "length(a) < 2")).run(df)
    got = {r["rule_name"]: (r["passed"], r["failed_count"], r["details"]) for r in report.results}
    assert got["number"][:2] == (False, 0) and "CAST_INVALID_INPUT" in got["number"][2]
    assert got["short"][:2] == (True, 0) and [v[:2] for k, v in got.items() if k.startswith("min_value")] == [(False, 1)]
