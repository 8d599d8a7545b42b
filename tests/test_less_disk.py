"""Layer runs that shuffle and write less: same rows."""

import datetime as dt
import os
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.retail_fixture import EXPECTED_FACT, write_landing
from tests.test_fewer_shuffles import DAILY_ROW, plan, write_sales
from tierlake import catalog
from tierlake.operators.dedupe import dedupe_latest, dedupe_stored
from tierlake.operators.joins import left_join_dim
from tierlake.plans import gold, layers as L, silver
from tierlake.session import SHUFFLE_CLEANUP, shuffles_dropped
from tierlake.sources import retail_view as RV, tables


def lines(df) -> list[str]:
    return sorted(map(str, df.collect()))


def files(root: str) -> list[str]:
    return [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.startswith("part-")]


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_sales_are_dealt_by_order_once(spark, tmp_root, broadcast):
    write_sales(spark, tmp_root)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in kept:
            spark.conf.set(k, broadcast)
        dealt = RV.sales(spark, tmp_root, by_order=True)
        assert lines(dealt) == lines(RV.sales(spark, tmp_root))
        final = dealt._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert final.count("Exchange hashpartitioning") == (2 if broadcast == "-1" else 1)
        at = dealt.select("order_id", F.spark_partition_id().alias("task")).distinct()
        assert sorted(r.order_id for r in at.collect()) == [1, 2]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_sales_land_compressed_in_year_folders(spark, tmp_root, monkeypatch):
    src = write_sales(spark, os.path.join(tmp_root, "src"))
    for name, key in (("customers", "customer_id"), ("products", "product_id"), ("stores", "store_id")):
        monkeypatch.setattr(RV, name, lambda s, d, key=key: s.createDataFrame([(1, "x")], f"{key} long, name string"))
    monkeypatch.setattr(RV, "inventory", lambda s, d: s.createDataFrame(
        [(1, 1, 1)], "inventory_id long, store_id long, product_id long"))
    RV.write_landing(spark, src, os.path.join(tmp_root, "landing"))
    found = files(os.path.join(tmp_root, "landing", "sales"))
    assert {os.path.basename(os.path.dirname(f)) for f in found} == {"_year=1997", "_year=1998"}
    assert all(f.endswith(".csv.gz") for f in found)
    rows = spark.read.option("header", "true").csv(os.path.join(tmp_root, "landing", "sales"))
    assert sorted((r.transaction_id, r._year, r.unit_price) for r in rows.collect()) == [
        ("TXN-101", 1997, "5.0"), ("TXN-101", 1997, "5.0"), ("TXN-102", 1997, "7.0"), ("TXN-201", 1998, "9.0")]
    at = rows.groupBy("transaction_id").agg(F.count_distinct("_metadata.file_path").alias("n"))
    assert {r.n for r in at.collect()} == {1}


def test_tables_are_stored_with_zstd(spark, tmp_root):
    df = spark.createDataFrame([("a", True)], "k string, scd_is_current boolean")
    tables.write_snapshot(df, f"{tmp_root}/s", "r1")
    tables.append(df, f"{tmp_root}/a")
    tables.write_versions_run(df, f"{tmp_root}/v", "r1")
    for name in "sav":
        found = files(f"{tmp_root}/{name}")
        assert found and all(f.endswith(".zstd.parquet") for f in found)


def test_what_a_load_has_in_common_is_not_shuffled(spark, tmp_root, monkeypatch):
    landing, lake = write_landing(os.path.join(tmp_root, "landing")), os.path.join(tmp_root, "lake")
    seen, real = [], L.rows_to_insert

    def insert(target, incoming, *args):
        seen.append(incoming.columns)
        return real(target, incoming, *args)
    monkeypatch.setattr(L, "rows_to_insert", insert)
    ctx = L.RunContext(spark, landing, lake, run_id="r1", as_of=dt.datetime(2024, 1, 3))
    L.ingest_source(ctx, L.SOURCES["sales"])
    assert not {"_source", "_batch_id", "_ingested_at", "ingestion_date"} & set(seen[0])
    assert "_source_file" in seen[0]
    rows = L.bronze_table(ctx, "sales").collect()
    assert len(rows) == 5
    assert {(r._source, r._batch_id, r._ingested_at, r.ingestion_date) for r in rows} == {
        ("sales", "r1", dt.datetime(2024, 1, 3), dt.date(2024, 1, 3))}


@pytest.mark.parametrize("few", [0, 1, 100])
def test_stored_rows_are_deduplicated_by_their_repeated_keys(spark, few):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, None), (None, 1, "p"), (None, 2, "q"), ("c", 5, "w"), ("c", 5, "v")]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    once = df.where("k = 'b'")
    for stored in (df, once):
        assert lines(dedupe_stored(stored, "k", ["at"], few)) == lines(dedupe_latest(stored, ["k"], ["at"]))
    assert "Aggregate" not in plan(dedupe_stored(once, "k", ["at"], few))
    text = plan(dedupe_stored(df, "k", ["at"], few))
    assert ("Join LeftAnti" in text) == (few == 100)


def test_the_fact_is_dealt_by_date_before_its_measures(spark, tmp_root):
    landing, lake = write_landing(os.path.join(tmp_root, "landing"), with_day2=True), os.path.join(tmp_root, "lake")
    ctx = L.RunContext(spark, landing, lake, run_id="r1", as_of=dt.datetime(2024, 1, 3))
    L.run_bronze(ctx)
    sales = L.bronze_table(ctx, "sales")
    assert sales.count() == 6   # TXN-4 in two files
    plain, dealt = silver.build_fact_sales(sales), silver.build_fact_sales(sales, stored=True, by_date=True)
    assert lines(plain) == lines(dealt)
    text = plan(dealt)
    assert text.index("gross_amount") < text.index("RebalancePartitions")
    below = text[text.index("RebalancePartitions"):]
    assert "gross_amount" not in below and "LeftAnti" in below
    L.run_silver(ctx)
    stored = {r.transaction_id: tuple(str(r[c]) for c in ("gross_amount", "discount_amount", "net_amount"))
              for r in L.silver_table(ctx, "fact_sales").collect()}
    assert stored == EXPECTED_FACT


def test_the_wide_table_is_dealt_by_month_before_its_calendar(spark, tmp_root):
    landing, lake = write_landing(os.path.join(tmp_root, "landing")), os.path.join(tmp_root, "lake")
    ctx = L.RunContext(spark, landing, lake, run_id="r1", as_of=dt.datetime(2024, 1, 3))
    L.run_bronze(ctx)
    L.run_silver(ctx)
    parts = [L.silver_table(ctx, n) for n in ("fact_sales", "dim_store", "dim_customer", "dim_product")]
    plain, dealt = gold.build_obt_sales(*parts), gold.build_obt_sales(*parts, by_month=True)
    assert dealt.columns == plain.columns and lines(plain) == lines(dealt)
    below = plan(dealt)
    below = below[below.index("RebalancePartitions"):]
    assert "store_name" in below and "day_name" not in below


def test_unique_transactions_are_dealt_as_a_flag(spark):
    row = (dt.date(2024, 1, 1), 2024, 1, "2024-01", dt.datetime(2024, 1, 1, 9), None, None, None, "C", "web",
           1, 5, 2, Decimal(9), Decimal(1), Decimal(8), Decimal(3))
    obt = spark.createDataFrame([row, row[:10] + (None, 6) + row[12:]], DAILY_ROW).drop("t")
    daily = gold.agg_daily_sales(obt, transactions_unique=True)
    assert [(r.num_transactions, r.num_customers, r.total_units) for r in daily.collect()] == [(1, 2, 4)]
    text = plan(daily)
    assert "isnotnull(transaction_id" in text[text.index("RepartitionByExpression"):].split("LogicalRDD")[0]


def test_joins_in_a_row_leave_unused_columns_and_dimensions_out(spark):
    fact = spark.createDataFrame([(1, 1, 7, "a"), (2, None, None, "b"), (3, 2, 9, "c")], "t long, k long, m long, v string")
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "k long, name string").groupBy("k").agg(F.max("name").alias("name"))
    other = spark.createDataFrame([(7, "p"), (8, "q")], "m long, place string").groupBy("m").agg(F.max("place").alias("place"))
    out = left_join_dim(left_join_dim(fact, dim, "k", spread_by=["t"]), other, "m", spread_by=["t"])
    assert lines(out) == lines(left_join_dim(left_join_dim(fact, dim, "k"), other, "m"))
    text = plan(out.select("t", "place"))
    assert text.count("Join") == 1 and "v#" not in text.split("LogicalRDD")[0]


def test_the_report_stores_what_its_rules_read(spark, tmp_root, monkeypatch):
    write_sales(spark, tmp_root)
    for name, rows, schema in (
            ("nation", [(1, "BRAZIL", 1)], "n_nationkey int, n_name string, n_regionkey int"),
            ("region", [(1, "AMERICA")], "r_regionkey int, r_name string"),
            ("customer", [(7, "C#7", 1, "Gold", 5.0), (8, "C#8", 1, "Gold", 5.0)],
             "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double"),
            ("supplier", [(21, "S#21", 1, 5.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
            ("part", [(10, "p", "T", 3, "B", 9.0), (11, "q", "T", 30, "B", 8.0), (12, "r", "U", 12, "B", 7.0)],
             "p_partkey long, p_name string, p_type string, p_size int, p_brand string, p_retailprice double")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_root}/{name}.parquet")
    root = os.path.join(tmp_root, "inputs")
    monkeypatch.setattr(catalog, "scratch_path", lambda s, name: root)
    out = {r.source: r for r in catalog.q_expect_report(spark, tmp_root).collect()}
    assert sorted(os.listdir(root)) == ["fact", "obt", "sales"]
    assert all(f.endswith(".zstd.parquet") for f in files(root))
    stored = spark.read.parquet(f"{root}/obt")
    assert not {"customer_name", "product_name", "order_id", "unit_price"} & set(stored.columns)
    assert stored.count() == 3 and set(gold.DAILY_INPUTS) | {"product_id"} == set(stored.columns)
    assert len(out) == 11
    # TXN 201 has quantity 0, TXN 101 is there twice; channels and payment methods are the driver's
    assert {s: (r.critical_failures, r.warnings) for s, r in out.items() if s in ("bronze.sales", "silver.fact_sales",
            "gold.obt_sales", "gold.agg_daily_sales")} == {"bronze.sales": (4, 0), "silver.fact_sales": (1, 0),
                                                           "gold.obt_sales": (1, 0), "gold.agg_daily_sales": (0, 0)}


def shuffle_files(spark) -> set[str]:
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    kept = env.blockManager().diskBlockManager().getAllFiles()
    return {kept.apply(i).getName() for i in range(kept.size()) if kept.apply(i).getName().startswith("shuffle_")}


def test_shuffles_are_dropped_with_their_action(spark, tmp_root):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    with shuffles_dropped(spark):
        df.groupBy("k").count().write.parquet(f"{tmp_root}/a")
        for _ in range(50):   # deleted in the background
            if not shuffle_files(spark) - before:
                break
            time.sleep(0.1)
        assert not shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
    with pytest.raises(ValueError), shuffles_dropped(spark):
        raise ValueError
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting


def test_a_layer_run_drops_its_shuffles(spark, tmp_root, monkeypatch):
    seen = []
    monkeypatch.setattr(L, "run_bronze", lambda ctx: seen.append(spark.conf.get(SHUFFLE_CLEANUP)))
    monkeypatch.setattr(L, "check_layer", lambda ctx, layer: seen.append(spark.conf.get(SHUFFLE_CLEANUP)) or [])
    L.run_layers(L.RunContext(spark, tmp_root, tmp_root), layers=("bronze",))
    assert seen == ["true", "true"] and spark.conf.get(SHUFFLE_CLEANUP) != "true"


def test_the_wide_table_is_stored_behind_large_dimensions(spark, tmp_root, monkeypatch):
    landing = write_landing(os.path.join(tmp_root, "landing"))
    stored, dropped, real = [], [], L.tables.drop
    monkeypatch.setattr(L, "scratch_path", lambda s, name: stored.append(name) or os.path.join(tmp_root, name))
    monkeypatch.setattr(L.tables, "drop", lambda s, path: dropped.append(os.path.basename(path)) or real(s, path))
    tables_of = []
    for run, large in (("plain", 10**9), ("split", 0)):
        monkeypatch.setattr(L, "LARGE_DIM", large)
        ctx = L.RunContext(spark, landing, os.path.join(tmp_root, run), run_id="r1", as_of=dt.datetime(2024, 1, 3))
        L.run_bronze(ctx)
        L.run_silver(ctx)
        L.run_gold(ctx)
        tables_of.append([lines(L.gold_table(ctx, "obt_sales").select(*gold.OBT_COLUMNS)), L.gold_table(ctx, "obt_sales").columns,
                          lines(L.gold_table(ctx, "agg_daily_sales"))])
    assert tables_of[0] == tables_of[1] and len(tables_of[0][0]) == 5
    assert stored == ["wide-product_id", "wide-customer_id"] == dropped
    assert not [n for n in os.listdir(tmp_root) if n.startswith("wide-")]
