import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.retail_fixture import EXPECTED_FACT, EXPECTED_MARGIN, write_landing
from tierlake.operators.expectations import QualityError
from tierlake.plans import gold, layers as L, runlog, silver

AS_OF = dt.datetime(2024, 1, 3, 6, 0)


@pytest.fixture
def ctx(spark, tmp_root):
    landing = write_landing(os.path.join(tmp_root, "landing"))
    return L.RunContext(spark, landing, os.path.join(tmp_root, "lake"), run_id="r0001", as_of=AS_OF)


def test_bronze_ingest_is_idempotent_and_keeps_lineage(ctx):
    first = L.run_bronze(ctx)
    assert {r["source"]: r["rows_written"] for r in first} == {
        "sales": 5, "customers": 3, "products": 3, "stores": 2, "inventory": 3}
    assert first[0]["rows_read"] == 5 and first[0]["drift_messages"] == []
    assert any("omitted" in m for m in first[1]["drift_messages"])
    again = L.run_bronze(L.RunContext(ctx.spark, ctx.landing_root, ctx.lake_root, run_id="r0002", as_of=AS_OF))
    assert all(r["rows_written"] == 0 for r in again)
    sales = L.bronze_table(ctx, "sales")
    assert sales.count() == 5
    row = sales.filter("transaction_id = 'TXN-1'").first()
    assert row._source == "sales" and row._batch_id == "r0001" and row._source_file.endswith("sales_20240101.csv")
    assert row.ingestion_date == AS_OF.date()


def test_new_file_with_same_key_is_inserted(ctx, spark):
    L.run_bronze(ctx)
    write_landing(ctx.landing_root, with_day2=True)
    rec = L.ingest_source(L.RunContext(spark, ctx.landing_root, ctx.lake_root, run_id="r0002", as_of=AS_OF),
                          L.SOURCES["sales"])
    assert rec["rows_written"] == 1
    assert L.bronze_table(ctx, "sales").filter("transaction_id = 'TXN-4'").count() == 2


def test_whole_run_values(ctx, spark):
    L.run_layers(ctx, halt=False)
    fact = L.silver_table(ctx, "fact_sales")
    got = {r.transaction_id: (str(r.gross_amount), str(r.discount_amount), str(r.net_amount)) for r in fact.collect()}
    assert got == EXPECTED_FACT
    assert fact.filter("transaction_id = 'TXN-5'").first().discount_pct == Decimal("0.00")
    prod = L.silver_table(ctx, "dim_product")
    assert {r.product_id: (str(r.margin_pct) if r.margin_pct is not None else None)
            for r in prod.collect()} == EXPECTED_MARGIN
    cust = {r.customer_id: r for r in L.silver_table(ctx, "dim_customer").collect()}
    assert cust["CUST-2"].email is None and cust["CUST-2"].loyalty_tier == "Bronze"
    assert cust["CUST-2"].loyalty_points == 0 and cust["CUST-1"].scd_is_current
    inv = {r.inventory_id: r for r in L.silver_table(ctx, "dim_inventory").collect()}
    assert [inv[k].stock_status for k in ("INV-1", "INV-2", "INV-3")] == ["out_of_stock", "low_stock", "in_stock"]
    assert inv["INV-3"].available_qty == 40

    obt = L.gold_table(ctx, "obt_sales")
    assert obt.count() == fact.count()
    o = {r.transaction_id: r for r in obt.collect()}
    assert o["TXN-4"].customer_name is None and o["TXN-3"].store_name is None
    assert o["TXN-3"].customer_name == "Bruno" and o["TXN-1"].customer_name == "Ana Lima"
    daily = L.gold_table(ctx, "agg_daily_sales")
    monthly = L.gold_table(ctx, "agg_monthly_sales")
    total = lambda df, c: df.agg(F.sum(c)).first()[0]
    assert total(fact, "net_amount") == total(daily, "total_net_revenue") == total(monthly, "total_net_revenue") \
        == Decimal("547.44")
    assert daily.count() == 4
    assert gold.agg_daily_sales(obt, grain="instant").count() == 5

    runs = spark.read.parquet(f"{ctx.lake_root}/{runlog.PIPELINE_RUNS}")
    assert runs.count() == 5 + 6 + 8
    log = spark.read.parquet(f"{ctx.lake_root}/{runlog.QUALITY_LOG}")
    assert log.count() == 72 + 14   # rule results + row-policy results
    drops = log.filter("description = 'row policy'").collect()
    assert {r.rule_name for r in drops} >= {'valid_store_id', 'non_negative_net_amount', 'positive_quantity'}
    assert all(r.failed_count == 0 for r in drops)
    assert log.filter("source = 'silver.dim_customer' AND NOT passed").count() == 0


def test_critical_failure_halts(spark, tmp_root):
    landing = write_landing(os.path.join(tmp_root, "landing"))
    with open(os.path.join(landing, "sales", "sales_20240101.csv"), "a") as fh:
        fh.write("TXN-9,ORD-9,2024-01-03 09:00:00,STR-1,CUST-1,PRD-1,1,5.00,0,credit_card,telegram\n")
    ctx = L.RunContext(spark, landing, os.path.join(tmp_root, "lake"), run_id="r1", as_of=AS_OF)
    with pytest.raises(QualityError, match="values_in_set:channel"):
        L.run_layers(ctx, halt=True)
    assert spark.read.parquet(f"{ctx.lake_root}/{runlog.PIPELINE_RUNS}").count() == 5
    assert not os.path.exists(os.path.join(ctx.lake_root, "silver"))


def test_scd2_across_runs(spark, tmp_root):
    landing = write_landing(os.path.join(tmp_root, "landing"))
    lake = os.path.join(tmp_root, "lake")
    ctx1 = L.RunContext(spark, landing, lake, run_id="r1", as_of=AS_OF)
    L.run_layers(ctx1, ("bronze", "silver"), halt=False)
    # the customer file is delivered again with a changed tier
    p = os.path.join(landing, "customers", "customers_20240105.csv")
    with open(p, "w") as fh:
        fh.write("customer_id,first_name,last_name,email,loyalty_tier,loyalty_points,registration_date,city,state\n"
                 "CUST-1,Ana,Lima,ana@mail.test,Platinum,900,2023-01-10,Recife,PE\n")
    ctx2 = L.RunContext(spark, landing, lake, run_id="r2", as_of=dt.datetime(2024, 1, 5, 6, 0))
    L.run_layers(ctx2, ("bronze", "silver"), halt=False)
    dim = L.silver_table(ctx2, "dim_customer").filter("customer_id = 'CUST-1'")
    rows = sorted((r.loyalty_tier, r.scd_is_current, str(r.scd_effective_to)) for r in dim.collect())
    assert rows == [("Gold", False, "2024-01-05"), ("Platinum", True, "9999-12-31")]


def test_dim_date(spark):
    d = silver.build_dim_date(spark)
    assert d.count() == 4018
    r = {x.date_id: x for x in d.filter("date_id IN (20210101, 20240107, 20240108)").collect()}
    assert r[20210101].week_of_year == 53
    assert r[20240107].day_of_week == 1 and r[20240107].is_weekend and r[20240107].day_name == "Sunday"
    assert not r[20240108].is_weekend and r[20240108].year_month == "2024-01" and r[20240108].month_name == "January"


def test_no_python_in_plans(ctx, spark):
    L.run_layers(ctx, halt=False)
    obt = L.gold_table(ctx, "obt_sales")
    for df in (gold.agg_daily_sales(obt), gold.agg_monthly_sales_exact(obt)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "EvalPython" not in plan


def test_history_is_appended_not_rewritten(spark, tmp_root):
    from tierlake.sources import tables
    landing = write_landing(os.path.join(tmp_root, "landing"))
    lake = os.path.join(tmp_root, "lake")
    L.run_layers(L.RunContext(spark, landing, lake, run_id="r1", as_of=AS_OF), ("bronze", "silver"), halt=False)
    with open(os.path.join(landing, "customers", "customers_20240105.csv"), "w") as fh:
        fh.write("customer_id,first_name,last_name,email,loyalty_tier,loyalty_points,registration_date,city,state\n"
                 "CUST-3,Caio,Reis,caio@mail.test,Gold,20,2023-03-12,Olinda,PE\n")
    ctx2 = L.RunContext(spark, landing, lake, run_id="r2", as_of=dt.datetime(2024, 1, 5, 6, 0))
    L.run_layers(ctx2, ("bronze", "silver"), halt=False)
    root = ctx2.path("silver", "dim_customer")
    # run 2 wrote only the version it closed, next to the full current part
    closed = spark.read.parquet(f"{root}/run=r2/scd_is_current=false")
    assert [(r.customer_id, r.loyalty_tier) for r in closed.collect()] == [("CUST-3", "Silver")]
    assert not os.path.exists(f"{root}/run=r1/scd_is_current=false")
    assert tables.read_current_versions(spark, root).count() == 3
    assert tables.read_versions(spark, root).count() == 4


def test_filters_prune_the_stored_obt(ctx, spark):
    from tierlake.plans import kpis
    L.run_layers(ctx, halt=False)
    obt = L.gold_table(ctx, "obt_sales")
    f = kpis.filter_sales(obt, "2024-01-02", "2024-01-31", categories=["Food"])
    assert [r.transaction_id for r in f.collect()] == ["TXN-4"]
    scan = f._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "transaction_date" in scan


def test_row_policies_drop_and_fail(spark):
    from tierlake.operators.expectations import apply_row_policies
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (None, 3.0)], "transaction_id int, net_amount double")
    kept, obs = apply_row_policies(df, (("warn", "has_id", "transaction_id IS NOT NULL"),
                                        ("drop", "non_negative", "net_amount >= 0")), "t_policies")
    assert sorted(r.net_amount for r in kept.collect()) == [3.0, 5.0]
    assert obs.get["has_id"] == 1 and obs.get["non_negative"] == 1 and obs.get["_rows"] == 3
    failing, _ = apply_row_policies(df, (("fail", "has_id", "transaction_id IS NOT NULL"),), "t_fail")
    with pytest.raises(Exception, match="expectation failed: has_id"):
        failing.collect()


def test_referential_checks_on_silver(spark, tmp_root):
    landing = write_landing(os.path.join(tmp_root, "landing"))
    with open(os.path.join(landing, "sales", "sales_20240101.csv"), "a") as fh:
        fh.write("TXN-9,ORD-9,2024-01-03 09:00:00,STR-9,CUST-1,PRD-1,1,5.00,0,cash,in_store\n")
    ctx = L.RunContext(spark, landing, os.path.join(tmp_root, "lake"), run_id="r1", as_of=AS_OF,
                       referential_checks=True)
    L.run_layers(ctx, ("bronze", "silver"), halt=True)   # orphans are warnings: no halt
    log = spark.read.parquet(f"{ctx.lake_root}/_quality_log").filter("rule_name LIKE 'ref_integrity:%'")
    got = {r.rule_name: (r.severity, r.failed_count) for r in log.collect()}
    assert got == {"ref_integrity:store_id->store_id": ("WARNING", 1),
                   "ref_integrity:customer_id->customer_id": ("WARNING", 0),
                   "ref_integrity:product_id->product_id": ("WARNING", 0)}


def test_customer_sketches_roll_up(spark, tmp_root):
    landing = write_landing(os.path.join(tmp_root, "landing"))
    ctx = L.RunContext(spark, landing, os.path.join(tmp_root, "lake"), run_id="r1", as_of=AS_OF,
                       customer_sketches=True)
    L.run_layers(ctx, halt=False)
    assert "customer_sketch" in L.gold_table(ctx, "agg_daily_sales").columns
    monthly = L.gold_table(ctx, "agg_monthly_sales")
    exact = gold.agg_monthly_sales_exact(L.gold_table(ctx, "obt_sales"))
    keys = ["store_id", "product_category", "channel"]
    got = {tuple(r[k] for k in keys): r.approx_distinct_customers for r in monthly.collect()}
    want = {tuple(r[k] for k in keys): r.distinct_customers for r in exact.collect()}
    assert got == want          # tiny sets: the sketch is exact


def test_dropped_rows_go_to_quarantine(spark, tmp_root):
    landing = write_landing(os.path.join(tmp_root, "landing"))
    with open(os.path.join(landing, "sales", "sales_20240101.csv"), "a") as fh:
        fh.write("TXN-8,ORD-8,2024-01-03 09:00:00,STR-1,CUST-1,PRD-1,1,10.00,110,cash,in_store\n")
    ctx = L.RunContext(spark, landing, os.path.join(tmp_root, "lake"), run_id="r1", as_of=AS_OF)
    L.run_layers(ctx, ("bronze", "silver"), halt=False)
    fact = L.silver_table(ctx, "fact_sales")
    assert fact.filter("transaction_id = 'TXN-8'").count() == 0 and fact.count() == 5
    q = spark.read.parquet(ctx.path("quarantine", "silver.fact_sales") + "/snapshot=r1")
    rows = q.collect()
    assert [r.transaction_id for r in rows] == ["TXN-8"]
    assert rows[0]._failed_expectations == ["non_negative_net_amount"]
    assert not os.path.exists(ctx.path("quarantine", "silver.dim_store"))   # nothing dropped there


def test_a_failed_step_is_logged_with_those_before_it(spark, tmp_root):
    landing = write_landing(os.path.join(tmp_root, "landing"))
    with open(os.path.join(landing, "products", "products_20240102.csv"), "w") as fh:
        fh.write("product_id,product_name\nPRD-9,Half a header\n")   # required columns are gone
    ctx = L.RunContext(spark, landing, os.path.join(tmp_root, "lake"), run_id="r1", as_of=AS_OF)
    with pytest.raises(RuntimeError, match="products"):
        L.run_layers(ctx, halt=False)
    runs = spark.read.parquet(f"{ctx.lake_root}/{runlog.PIPELINE_RUNS}").collect()
    got = {r.source: (r.status, r.rows_written) for r in runs}
    assert got == {"sales": ("success", 5), "customers": ("success", 3), "products": ("failed", None)}
    assert "unit_price" in next(r.error for r in runs if r.source == "products")


def test_only_empty_input_counts_as_no_violations(spark):
    from pyspark.sql import Observation
    none = spark.range(10).where("id > 100").join(spark.range(5), "id")
    obs = Observation("t_none")
    none.observe(obs, F.count(F.lit(1)).alias("rows")).join(spark.range(3), "id").collect()
    assert L._metrics(obs, none.isEmpty) == {} and L._rows(obs, none.count) == 0
    lost = Observation("t_lost")
    none.observe(lost, F.count(F.lit(1)).alias("rows")).join(spark.range(3), "id").collect()
    with pytest.raises(RuntimeError, match="no metrics"):
        L._metrics(lost, lambda: False)
