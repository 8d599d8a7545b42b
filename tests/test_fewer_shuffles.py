"""Shuffles that were left out: same rows, fewer of them moved or written."""

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from tests.retail_fixture import write_landing
from tierlake import catalog
from tierlake.operators.joins import left_join_dim
from tierlake.plans import gold, layers as L

DAILY_ROW = ("t date, year int, month int, year_month string, transaction_date timestamp, store_id long, store_name string, "
             "store_region string, product_category string, channel string, transaction_id long, customer_id long, "
             "quantity int, gross_amount decimal(24,2), discount_amount decimal(24,2), net_amount decimal(24,2), "
             "margin_pct decimal(12,2)")


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def write_sales(spark, root: str) -> str:
    """Two orders over two years, one line delivered twice."""
    lines = [(1, 10, 20, 1, 2.0, 5.0, 0.1, "A"), (1, 11, 21, 2, 1.0, 7.0, 0.0, "R"), (1, 10, 20, 1, 2.0, 5.0, 0.1, "A"),
             (2, 12, 30, 1, 0.0, 9.0, 0.0, "N")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_returnflag string").write.parquet(f"{root}/lineitem.parquet")
    orders = [(1, 7, dt.datetime(1997, 5, 1), "1-URGENT"), (2, 8, dt.datetime(1998, 6, 1), "5-LOW")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string") \
        .write.parquet(f"{root}/orders.parquet")
    return root


def test_spread_null_keys_leave_an_unused_dimension_out(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d"), (9, "e")], "k long, v string")
    dim = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (None, "z")], "k long, name string")
    dim = dim.groupBy("k").agg(F.max("name").alias("name"))
    out = left_join_dim(fact, dim, "k")
    assert sorted((r.v, r.name) for r in out.collect()) == [("a", "x"), ("b", "y"), ("c", None), ("d", None), ("e", None)]
    assert "Join" in plan(out) and "Join" not in plan(out.select("v"))


def test_the_tag_stays_a_join_key(spark):
    fact = spark.createDataFrame([(None, "c")], "k long, v string")
    dim = spark.createDataFrame([(1, "x")], "k long, name string").groupBy("k").agg(F.max("name").alias("name"))
    text = plan(left_join_dim(fact, dim, "k"))
    join = next(line for line in text.splitlines() if "Join" in line)
    assert "_null_key_tag" in join and "_dim_tag" in join


def test_rollups_deal_rows_by_all_keys(spark):
    """A join by store would else decide how the aggregate lies: sales without a store in one task."""
    row = (dt.date(2024, 1, 1), 2024, 1, "2024-01", dt.datetime(2024, 1, 1, 9), None, None, None, "C", "web",
           1, 5, 2, Decimal(9), Decimal(1), Decimal(8), Decimal(3))
    rows = [row, row[:10] + (2, 5) + row[12:], row[:10] + (3, 6) + row[12:]]
    obt = spark.createDataFrame(rows, DAILY_ROW).drop("t")
    daily = gold.agg_daily_sales(obt, transactions_unique=True)
    for df in (daily, gold.agg_monthly_sales_exact(obt, transactions_unique=True)):
        assert "RepartitionByExpression" in plan(df) and "Expand" not in plan(df)
    ordered = gold.agg_daily_sales(obt, transactions_unique=True, ordered=True)
    assert ordered.collect() == daily.collect()
    assert [(r.num_transactions, r.num_customers, r.total_units) for r in daily.collect()] == [(3, 2, 6)]


def test_gold_shuffles_no_table_twice(spark, tmp_root, monkeypatch):
    landing, lake = write_landing(os.path.join(tmp_root, "landing")), os.path.join(tmp_root, "lake")
    ctx = L.RunContext(spark, landing, lake, run_id="r1", as_of=dt.datetime(2024, 1, 3))
    L.run_bronze(ctx)
    L.run_silver(ctx)
    seen, real = {}, L.tables.write_snapshot

    def write(df, root, *args, **more):
        seen[os.path.basename(root)] = (more.get("rebalance", True), plan(df))
        return real(df, root, *args, **more)
    monkeypatch.setattr(L.tables, "write_snapshot", write)
    L.run_gold(ctx)
    for name in ("fact_sales", "agg_daily_sales", "agg_monthly_sales"):
        again, text = seen[name]
        assert not again and "Expand" not in text
    assert L.gold_table(ctx, "fact_sales").count() == L.silver_table(ctx, "fact_sales").count()
    daily = L.gold_table(ctx, "agg_daily_sales").drop("_gold_loaded_at")
    expected = gold.agg_daily_sales(L.gold_table(ctx, "obt_sales"))
    assert sorted(map(str, daily.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))


def test_incremental_rules_join_the_sales_once(spark, tmp_root, monkeypatch):
    seen, real = [], catalog.evaluate_new

    def evaluate(spark_, root, parts, rules):
        seen.append({name: plan(df) for name, df in parts.items()})
        return real(spark_, root, parts, rules)
    monkeypatch.setattr(catalog, "evaluate_new", evaluate)
    out = {r.rule_name: r.failed_count for r in catalog.q_expect_incremental(spark, write_sales(spark, tmp_root)).collect()}
    assert [sorted(p) for p in seen] == [["1997"], ["1997", "1998"]]
    assert not any("Join" in text for parts in seen for text in parts.values())
    assert (out["unique:transaction_id"], out["min_value:quantity>=1"], out["values_in_set:channel"]) == (1, 1, 4)


def test_changes_are_read_from_one_copy_of_the_sales(spark, tmp_root, monkeypatch):
    seen, real = [], catalog.touched_groups

    def touched(old, new, *args):
        seen.append({os.path.basename(os.path.dirname(f)) for df in (old, new) for f in df.inputFiles()})
        return real(old, new, *args)
    monkeypatch.setattr(catalog, "touched_groups", touched)
    rows = catalog.q_daily_after_changes(spark, write_sales(spark, tmp_root)).collect()
    assert seen == [{"final"}, {"final"}]
    assert sorted((r.channel, r.num_transactions, r.total_units) for r in rows) == [("A", 1, 2), ("N", 1, 0), ("R", 1, 1)]
