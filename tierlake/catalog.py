"""Registered queries: one per operator family, over the driver's tables.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads the whole tables
through ``retail_view``; ``ORACLE_SQL`` holds the DuckDB statement that must
return the same rows. Load stamps are left out (they are run-time values).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as _T

from tierlake import oracle as O
from tierlake.operators import bitmaps as B, expectations as X
from tierlake.operators.changes import snapshot_changes
from tierlake.operators.dedupe import dedupe_latest
from tierlake.operators.point_in_time import lookup_valid
from tierlake.operators.rule_states import evaluate_new
from tierlake.operators.scd2 import current_rows, scd2_from_feed, scd2_initial, scd2_merge
from tierlake.operators.upsert import upsert_insert_only
from tierlake.plans import gold, kpis as K, layers as L, runlog as R, silver
from tierlake.plans.incremental import refresh_rollup, touched_groups
from tierlake.plans.rules import RULE_SETS, build_checker
from tierlake.session import scratch_path, shuffles_dropped
from tierlake.sources import contracts as C, retail_view as RV, tables as TB
from tierlake.sources.landing import list_files, read_files, read_landing
from tierlake.sources.lineage import add_lineage
from tierlake.sources.specs import CUSTOMERS_CONTRACT, SourceSpec
from tierlake.streaming import ingest as S
from tierlake.streaming.drifting import read_drifting, start_drifting_stream
from tierlake.streaming.scd2_stream import BUCKET, read_versioned, start_scd2_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- silver


def fact_sales_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.build_fact_sales(RV.sales(spark, sf_dir))


def current_dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Store, customer and product dimensions as after a first load."""
    return (
        silver.build_dim_store(RV.stores(spark, sf_dir)),
        silver.build_dim_customer(RV.customers(spark, sf_dir)),
        silver.build_dim_product(RV.products(spark, sf_dir)),
    )


def obt_df(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """The wide table; queries over it carry only the dimensions they use, unless it is wanted ``whole``."""
    store, customer, product = current_dims(spark, sf_dir)
    return gold.build_obt_sales(fact_sales_df(spark, sf_dir), store, customer, product, spread_nulls=whole)


@register("fact_sales", O.with_ctes("fact") + "SELECT * FROM fact")
def q_fact_sales(spark, sf_dir):
    return fact_sales_df(spark, sf_dir)


@register("dim_store", O.with_ctes("dim_store") + "SELECT * FROM dim_store")
def q_dim_store(spark, sf_dir):
    return silver.build_dim_store(RV.stores(spark, sf_dir))


@register("dim_customer_clean", O.with_ctes("dim_customer") + "SELECT * FROM dim_customer")
def q_dim_customer(spark, sf_dir):
    return silver.build_dim_customer(RV.customers(spark, sf_dir))


@register("dim_product_margin", O.with_ctes("dim_product") + "SELECT * FROM dim_product")
def q_dim_product(spark, sf_dir):
    return silver.build_dim_product(RV.products(spark, sf_dir))


@register("dim_inventory_status", O.with_ctes("inventory") + """
SELECT *, CASE WHEN quantity_on_hand <= 0 THEN 'out_of_stock'
               WHEN quantity_on_hand <= reorder_point THEN 'low_stock'
               ELSE 'in_stock' END AS stock_status,
       quantity_on_hand - quantity_reserved AS available_qty
FROM inventory""")
def q_dim_inventory(spark, sf_dir):
    return silver.build_dim_inventory(RV.inventory(spark, sf_dir))


@register("dim_date", """
WITH span AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders),
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date FROM span)
SELECT date,
       CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_id,
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CAST(day(date) AS INTEGER) AS day, CAST(quarter(date) AS INTEGER) AS quarter,
       CAST(weekofyear(date) AS INTEGER) AS week_of_year,
       CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
       dayname(date) AS day_name, monthname(date) AS month_name,
       dayofweek(date) IN (0, 6) AS is_weekend, strftime(date, '%Y-%m') AS year_month
FROM days""")
def q_dim_date(spark, sf_dir):
    return silver.build_dim_date_spanning(RV.table(spark, sf_dir, "orders"), "o_orderdate")


# ---------------------------------------------------------------- gold


@register("gold_fact_sales", O.with_ctes("fact") + """
SELECT transaction_id, order_id, date_id, store_id, customer_id, product_id, quantity,
       unit_price, discount_pct, gross_amount, discount_amount, net_amount, payment_method, channel
FROM fact""")
def q_gold_fact(spark, sf_dir):
    return gold.gold_fact_sales(fact_sales_df(spark, sf_dir))


@register("obt_sales", O.with_ctes("obt") + "SELECT * FROM obt")
def q_obt(spark, sf_dir):
    return obt_df(spark, sf_dir, whole=True)


_DAILY_SQL = """
SELECT year, month, year_month, {tdate} AS transaction_date, store_id, store_name, store_region,
       product_category, channel,
       count(DISTINCT transaction_id) AS num_transactions,
       count(DISTINCT customer_id) AS num_customers,
       CAST(sum(quantity) AS BIGINT) AS total_units,
       CAST(sum(gross_amount) AS DECIMAL(22,2)) AS total_gross,
       CAST(sum(discount_amount) AS DECIMAL(22,2)) AS total_discount,
       CAST(sum(net_amount) AS DECIMAL(22,2)) AS total_net_revenue,
       CAST(sum(net_amount) AS DOUBLE) / count(net_amount) AS avg_order_value,
       CAST(sum(margin_pct) AS DOUBLE) / count(margin_pct) AS avg_margin_pct
FROM obt
GROUP BY year, month, year_month, {tdate}, store_id, store_name, store_region, product_category, channel"""


@register("agg_daily_sales", O.with_ctes("obt") + _DAILY_SQL.format(tdate="CAST(transaction_date AS DATE)"))
def q_daily(spark, sf_dir):
    return gold.agg_daily_sales(obt_df(spark, sf_dir), grain="day", transactions_unique=True)


@register("agg_daily_sales_instant", O.with_ctes("obt") + _DAILY_SQL.format(tdate="transaction_date"))
def q_daily_instant(spark, sf_dir):
    return gold.agg_daily_sales(obt_df(spark, sf_dir), grain="instant", transactions_unique=True)


@register("agg_monthly_sales_reference", O.with_ctes("obt", extra="daily AS (" + _DAILY_SQL.format(
    tdate="CAST(transaction_date AS DATE)") + ")") + """
SELECT year, month, year_month, store_id, store_name, store_region, product_category, channel,
       CAST(sum(num_transactions) AS BIGINT) AS num_transactions,
       CAST(sum(num_customers) AS BIGINT) AS num_customers,
       CAST(sum(total_units) AS BIGINT) AS total_units,
       CAST(sum(total_gross) AS DECIMAL(32,2)) AS total_gross,
       CAST(sum(total_discount) AS DECIMAL(32,2)) AS total_discount,
       CAST(sum(total_net_revenue) AS DECIMAL(32,2)) AS total_net_revenue,
       round(avg(avg_order_value), 6) AS avg_order_value,
       round(avg(avg_margin_pct), 6) AS avg_margin_pct
FROM daily
GROUP BY year, month, year_month, store_id, store_name, store_region, product_category, channel""")
def q_monthly_reference(spark, sf_dir):
    # averages of averages are sums of doubles: rounded to 6 places so the
    # cross-check does not depend on the engines' summation order
    out = gold.agg_monthly_sales(gold.agg_daily_sales(obt_df(spark, sf_dir), transactions_unique=True))
    return out.withColumn("avg_order_value", F.round("avg_order_value", 6)) \
              .withColumn("avg_margin_pct", F.round("avg_margin_pct", 6))


@register("agg_monthly_sales_exact", O.with_ctes("obt") + """
SELECT year, month, year_month, store_id, store_name, store_region, product_category, channel,
       count(DISTINCT transaction_id) AS num_transactions,
       count(DISTINCT customer_id) AS distinct_customers,
       CAST(sum(quantity) AS BIGINT) AS total_units,
       CAST(sum(gross_amount) AS DECIMAL(22,2)) AS total_gross,
       CAST(sum(discount_amount) AS DECIMAL(22,2)) AS total_discount,
       CAST(sum(net_amount) AS DECIMAL(22,2)) AS total_net_revenue,
       CAST(sum(net_amount) AS DOUBLE) / count(net_amount) AS avg_order_value,
       CAST(sum(margin_pct) AS DOUBLE) / count(margin_pct) AS avg_margin_pct
FROM obt
GROUP BY year, month, year_month, store_id, store_name, store_region, product_category, channel""")
def q_monthly_exact(spark, sf_dir):
    return gold.agg_monthly_sales_exact(obt_df(spark, sf_dir), transactions_unique=True)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales KPIs: Bronze-shaped input -> Silver -> OBT -> roll-up."""
    return q_daily(spark, sf_dir)


# ---------------------------------------------------------------- expectations


RUN_DATE = "2024-01-01"

O.SILVER_CTES["dim_customer_scd"] = f"""
dim_customer_scd AS (
  SELECT *, DATE '{RUN_DATE}' AS scd_effective_from, DATE '9999-12-31' AS scd_effective_to,
         true AS scd_is_current FROM dim_customer)"""
O.SILVER_CTES["dim_product_scd"] = f"""
dim_product_scd AS (
  SELECT *, DATE '{RUN_DATE}' AS scd_effective_from, DATE '9999-12-31' AS scd_effective_to,
         true AS scd_is_current FROM dim_product)"""
O._DEPENDS["dim_customer_scd"] = ("customers", "dim_customer")
O._DEPENDS["dim_product_scd"] = ("products", "dim_product")

# rule set -> (Spark input, SQL relation name, CTEs it needs)
RULE_INPUTS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str, tuple[str, ...], str]] = {
    "bronze.sales": (RV.sales, "sales", ("sales",), ""),
    "bronze.customers": (RV.customers, "customers", ("customers",), ""),
    "bronze.products": (RV.products, "products", ("products",), ""),
    "bronze.stores": (RV.stores, "stores", ("stores",), ""),
    "bronze.inventory": (RV.inventory, "inventory", ("inventory",), ""),
    "silver.fact_sales": (fact_sales_df, "fact", ("fact",), ""),
    "silver.dim_customer": (
        lambda s, d: scd2_initial(silver.build_dim_customer(RV.customers(s, d)), RUN_DATE),
        "dim_customer_scd", ("dim_customer_scd",), ""),
    "silver.dim_product": (
        lambda s, d: scd2_initial(silver.build_dim_product(RV.products(s, d)), RUN_DATE),
        "dim_product_scd", ("dim_product_scd",), ""),
    "silver.dim_store": (lambda s, d: current_dims(s, d)[0], "dim_store", ("dim_store",), ""),
    "gold.obt_sales": (obt_df, "obt", ("obt",), ""),
    "gold.agg_daily_sales": (
        lambda s, d: gold.agg_daily_sales(obt_df(s, d)), "daily", ("obt",),
        "daily AS (" + _DAILY_SQL.format(tdate="CAST(transaction_date AS DATE)") + ")"),
}

RESULT_COLUMNS = ("rule_name", "severity", "passed", "failed_count")


def _rules_query(set_name: str) -> Query:
    fn, _, _, _ = RULE_INPUTS[set_name]

    def q(spark, sf_dir):
        return build_checker(set_name).results(fn(spark, sf_dir)).select(*RESULT_COLUMNS)
    q.__doc__ = f"Rule results of the {set_name} rule set (fused evaluation)."
    return q


for _set in RULE_SETS:
    _fn, _rel, _ctes, _extra = RULE_INPUTS[_set]
    _sql = O.with_ctes(*_ctes, extra=_extra) + O.rule_set_sql(_rel, RULE_SETS[_set][1])
    register("expect_" + _set.replace(".", "_"), _sql)(_rules_query(_set))


def _report_sql() -> str:
    ctes, extra = [], []
    for s in RULE_SETS:
        ctes += list(RULE_INPUTS[s][2])
        if RULE_INPUTS[s][3] and RULE_INPUTS[s][3] not in extra:
            extra.append(RULE_INPUTS[s][3])
    layers = []
    for s, (layer, rules) in RULE_SETS.items():
        layers.append(f"SELECT '{s}' AS source, '{layer}' AS layer, * FROM ("
                      + O.rule_set_sql(RULE_INPUTS[s][1], rules) + ")")
    return O.with_ctes(*dict.fromkeys(ctes), extra=",".join(extra)) + """
SELECT source, layer, count(*) AS total_rules, count_if(passed) AS passed_rules,
       count_if(NOT passed AND severity = 'CRITICAL') AS critical_failures,
       count_if(NOT passed AND severity <> 'CRITICAL') AS warnings,
       count_if(NOT passed AND severity = 'CRITICAL') = 0 AS overall_passed
FROM (""" + "\nUNION ALL\n".join(layers) + ") GROUP BY source, layer"


@register("expect_report", _report_sql())
def q_expect_report(spark, sf_dir):
    """Summary per checked table (E11) over every rule set.

    Inputs that several rule sets share are built once and written: the sales, the fact
    from them, the wide table from the fact, of which the columns that its rules and the
    roll-up read. The roll-up is read by one rule set only, in one pass."""
    root = scratch_path(spark, "report-inputs")

    def kept(name: str, df: DataFrame) -> DataFrame:
        df.write.options(**TB.CODEC).parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    store, customer, product = current_dims(spark, sf_dir)
    read = {*gold.DAILY_INPUTS, *(r.column for r in build_checker("gold.obt_sales").rules)}
    with shuffles_dropped(spark):
        sales = kept("sales", RV.sales(spark, sf_dir))
        fact = kept("fact", silver.build_fact_sales(sales))
        obt = gold.build_obt_sales(fact, store, customer, product)
        obt = kept("obt", obt.select(*[c for c in obt.columns if c in read]))
    built = {"bronze.sales": sales, "silver.fact_sales": fact, "silver.dim_store": store, "gold.obt_sales": obt,
             "gold.agg_daily_sales": gold.agg_daily_sales(obt, transactions_unique=True)}   # by the fact
    parts = []
    for s, (layer, _) in RULE_SETS.items():
        df = built[s] if s in built else RULE_INPUTS[s][0](spark, sf_dir)
        parts.append(X.summarize(build_checker(s).results(df), s, layer).drop("run_id"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("expect_incremental", O.with_ctes("sales") + O.rule_set_sql("sales", RULE_SETS["bronze.sales"][1]))
def q_expect_incremental(spark, sf_dir):
    """The sales rules from merged states of yearly partitions, delivered in two runs: the second
    run evaluates only the years that are new (E10, E11)."""
    root = scratch_path(spark, "rule-states")
    rules = build_checker("bronze.sales").rules
    # delivered as a folder a year: a run joins nothing and reads its own years only
    sales = RV.sales(spark, sf_dir).select(*dict.fromkeys(r.column for r in rules if r.column),
                                           F.year("transaction_date").alias("_year"))
    landed = scratch_path(spark, "sales-by-year")
    sales.where("_year IS NOT NULL").write.partitionBy("_year").parquet(landed)
    sales = spark.read.schema(sales.schema).parquet(landed)
    years = [r[0] for r in sales.select("_year").distinct().orderBy("_year").collect()]   # one row a year
    of = lambda ys: {str(y): sales.where(F.col("_year") == y) for y in ys}
    evaluate_new(spark, root, of(years[:len(years) // 2]), rules)
    return evaluate_new(spark, root, of(years), rules).select(*RESULT_COLUMNS)


@register("expect_ref_integrity", O.with_ctes("fact", "dim_product", "dim_customer") + """
SELECT 'ref_integrity:product_id->product_id' AS rule_name, 'WARNING' AS severity,
       count(*) AS failed_count, count(*) = 0 AS passed
FROM fact f WHERE f.product_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_product p WHERE p.is_active AND p.product_id = f.product_id)
UNION ALL
SELECT 'ref_integrity:customer_id->customer_id', 'WARNING', count(*), count(*) = 0
FROM fact f WHERE f.customer_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = f.customer_id)""")
def q_ref_integrity(spark, sf_dir):
    """Sales of products missing from the active catalogue, and of unknown customers."""
    _, customers, products = current_dims(spark, sf_dir)
    chk = (X.Expectations("silver.fact_sales", layer="silver")
           .expect_referential_integrity("product_id", products.filter("is_active"), "product_id")
           .expect_referential_integrity("customer_id", customers, "customer_id"))
    return chk.results(fact_sales_df(spark, sf_dir)).select(*RESULT_COLUMNS)


# Row expectations of the event table used by the policy queries.
EVENT_EXPECTATIONS = {
    "non_negative_value": "value >= 0",
    "value_under_50": "value < 50",
    "not_error": "event_type <> 'error'",
}
_EVENT_VALID = " AND ".join(f"COALESCE({sql}, false)" for sql in EVENT_EXPECTATIONS.values())


@register("rows_kept_after_drop", f"SELECT * FROM events WHERE {_EVENT_VALID}")
def q_rows_kept(spark, sf_dir):
    """Drop policy (E18): only rows meeting every expectation are kept."""
    kept, _ = X.apply_expectations(RV.events(spark, sf_dir), EVENT_EXPECTATIONS, "drop")
    return kept


@register("rows_quarantined", "SELECT *, list_filter([" + ", ".join(
    f"CASE WHEN NOT COALESCE({sql}, false) THEN '{name}' END" for name, sql in EVENT_EXPECTATIONS.items()
) + f"], lambda x: x IS NOT NULL) AS _failed_expectations FROM events WHERE NOT ({_EVENT_VALID})")
def q_rows_quarantined(spark, sf_dir):
    """Rows violating an expectation with the names of the violated ones."""
    _, bad = X.apply_expectations(RV.events(spark, sf_dir), EVENT_EXPECTATIONS, "warn")
    return bad


@register("expectation_violations", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS expectation, count_if(NOT COALESCE({sql}, false)) AS violations FROM events"
    for name, sql in EVENT_EXPECTATIONS.items()))
def q_violations(spark, sf_dir):
    """Warn policy metrics (E17, T4): violation count per expectation, rows kept."""
    return X.violation_counts(RV.events(spark, sf_dir), EVENT_EXPECTATIONS)


# ---------------------------------------------------------------- SCD2, changes, upsert, lineage



MERGE_DATE = "2024-02-01"

_FEED_SQL = """
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value,
         lag(event_type) OVER w AS prev_type, row_number() OVER w AS rn
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT * FROM e WHERE rn = 1 OR prev_type IS DISTINCT FROM event_type),
v AS (
  SELECT event_id, ts, user_id, event_type, value, ts AS scd_effective_from,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS scd_effective_to
  FROM s)
SELECT *, scd_effective_to IS NULL AS scd_is_current FROM v"""


def feed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_from_feed(RV.events(spark, sf_dir), keys=["user_id"], sequence_by=["ts", "event_id"],
                          tracked=["event_type"], except_columns=["props"])


@register("scd2_from_feed", _FEED_SQL)
def q_scd2_feed(spark, sf_dir):
    """Ordered change feed -> versions (V3, V4): a user's event type history."""
    return feed_versions(spark, sf_dir)


@register("current_versions", _FEED_SQL.replace("SELECT *, scd_effective_to IS NULL AS scd_is_current FROM v",
                                                "SELECT *, true AS scd_is_current FROM v WHERE scd_effective_to IS NULL"))
def q_current_versions(spark, sf_dir):
    """Current version per key."""
    return current_rows(feed_versions(spark, sf_dir))


O.RETAIL_CTES["customers2"] = """
customers2 AS (
  SELECT * REPLACE (CASE WHEN customer_id % 7 = 0 THEN loyalty_points + 100 ELSE loyalty_points END AS loyalty_points,
                    CASE WHEN customer_id % 19 = 0 THEN NULL ELSE city END AS city)
  FROM customers WHERE customer_id % 23 <> 0
  UNION ALL
  SELECT * REPLACE (customer_id + 10000000 AS customer_id) FROM customers WHERE customer_id % 29 = 0)"""
O.SILVER_CTES["dim_customer2"] = O.SILVER_CTES["dim_customer"].replace(
    "dim_customer AS (", "dim_customer2 AS (").replace("FROM customers\n", "FROM customers2\n")
O._DEPENDS["customers2"] = ("customers",)
O._DEPENDS["dim_customer2"] = ("customers2",)


def _merge_sql(null_safe: bool) -> str:
    from tierlake.plans.silver import CUSTOMER_TRACKED, CUSTOMER_COLUMNS
    if null_safe:
        diff = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in CUSTOMER_TRACKED)
    else:
        diff = " OR ".join(f"COALESCE(t.{c} <> s.{c}, false)" for c in CUSTOMER_TRACKED)
    cols_t = ", ".join(f"t.{c}" for c in CUSTOMER_COLUMNS)
    cols_s = ", ".join(f"s.{c}" for c in CUSTOMER_COLUMNS)
    return O.with_ctes("dim_customer", "dim_customer2") + f"""
SELECT {cols_t}, DATE '{RUN_DATE}' AS scd_effective_from,
       CASE WHEN s.customer_id IS NOT NULL AND ({diff}) THEN DATE '{MERGE_DATE}' ELSE DATE '9999-12-31' END
         AS scd_effective_to,
       NOT (s.customer_id IS NOT NULL AND ({diff})) AS scd_is_current
FROM dim_customer t LEFT JOIN dim_customer2 s ON t.customer_id = s.customer_id
UNION ALL
SELECT {cols_s}, DATE '{MERGE_DATE}', DATE '9999-12-31', true
FROM dim_customer2 s LEFT JOIN dim_customer t ON t.customer_id = s.customer_id
WHERE t.customer_id IS NULL OR ({diff})"""


def _merged(spark: SparkSession, sf_dir: str, null_safe: bool) -> DataFrame:
    from tierlake.plans.silver import CUSTOMER_TRACKED
    first = scd2_initial(silver.build_dim_customer(RV.customers(spark, sf_dir)), RUN_DATE)
    second = silver.build_dim_customer(RV.customer_snapshot_2(spark, sf_dir))
    return scd2_merge(first, second, "customer_id", CUSTOMER_TRACKED, MERGE_DATE, null_safe=null_safe)


@register("scd2_merge_null_safe", _merge_sql(True))
def q_scd2_merge(spark, sf_dir):
    """Snapshot merge into an SCD2 customer dimension, NULL-safe change test (V1, V1a-c, V5)."""
    return _merged(spark, sf_dir, True)


@register("scd2_merge_reference", _merge_sql(False))
def q_scd2_merge_ref(spark, sf_dir):
    """Same merge with a plain <> change test: NULL transitions are not changes (Q9)."""
    return _merged(spark, sf_dir, False)


def _changes_sql() -> str:
    from tierlake.plans.silver import CUSTOMER_COLUMNS
    rest = [c for c in CUSTOMER_COLUMNS if c != "customer_id"]
    diff = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in rest)
    pick = ", ".join(f"CASE WHEN n.customer_id IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in rest)
    return O.with_ctes("dim_customer", "dim_customer2") + f"""
SELECT COALESCE(n.customer_id, o.customer_id) AS customer_id,
       CASE WHEN n.customer_id IS NULL THEN 'delete' WHEN o.customer_id IS NULL THEN 'insert'
            ELSE 'update' END AS change_type, {pick}
FROM dim_customer o FULL OUTER JOIN dim_customer2 n ON o.customer_id = n.customer_id
WHERE o.customer_id IS NULL OR n.customer_id IS NULL OR ({diff})"""


@register("snapshot_changes", _changes_sql())
def q_snapshot_changes(spark, sf_dir):
    """Insert / update / delete rows between two customer snapshots."""
    old = silver.build_dim_customer(RV.customers(spark, sf_dir))
    new = silver.build_dim_customer(RV.customer_snapshot_2(spark, sf_dir))
    return snapshot_changes(old, new, ["customer_id"])


def _orders_landed(spark: SparkSession, sf_dir: str, first_year: int, last_year: int) -> DataFrame:
    """Orders as delivered in yearly files; the file name is part of the merge key."""
    o = RV.table(spark, sf_dir, "orders")
    y = F.year("o_orderdate")
    return (o.filter((y >= first_year) & (y <= last_year))
            .withColumn("_source_file", F.concat(F.lit("orders/"), y.cast("string"), F.lit(".csv"))))


_ORDERS_LANDED = ("SELECT *, 'orders/' || CAST(year(o_orderdate) AS VARCHAR) || '.csv' AS _source_file "
                  "FROM orders WHERE year(o_orderdate) BETWEEN {a} AND {b}")


@register("upsert_insert_only", f"""
WITH t AS ({_ORDERS_LANDED.format(a=1900, b=1998)}),
     s AS ({_ORDERS_LANDED.format(a=1998, b=2100)})
SELECT * FROM t
UNION ALL
SELECT * FROM s WHERE NOT EXISTS (
  SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey AND t._source_file = s._source_file)""")
def q_upsert(spark, sf_dir):
    """Insert-only merge on (key, file): a re-delivered yearly file adds nothing."""
    target = _orders_landed(spark, sf_dir, 1900, 1998)
    incoming = _orders_landed(spark, sf_dir, 1998, 2100)
    return upsert_insert_only(target, incoming, ["o_orderkey", "_source_file"])


@register("bronze_lineage", """
SELECT *, 'orders' AS _source, 'orders.parquet' AS _source_file, 'batch-0001' AS _batch_id,
       TIMESTAMP '2024-01-01 06:30:00' AS _ingested_at, DATE '2024-01-01' AS ingestion_date
FROM orders""")
def q_lineage(spark, sf_dir):
    """Lineage columns with the real input file of every row."""
    o = RV.table(spark, sf_dir, "orders")
    out = add_lineage(o, "orders", "batch-0001", _dt.datetime(2024, 1, 1, 6, 30))
    # the file name (not the storage-specific prefix) is compared
    return out.withColumn("_source_file", F.regexp_extract("_source_file", r"([^/]+)$", 1)) \
              .withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp_ntz"))


@register("dedupe_latest", """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
  l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
  l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""")
def q_dedupe(spark, sf_dir):
    """Latest shipment per (order, line) with a total tie-break (P8, DEC5)."""
    li = RV.table(spark, sf_dir, "lineitem")
    return dedupe_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# ---------------------------------------------------------------- KPIs



@register("kpi_revenue_orders", O.with_ctes("obt") + """
SELECT year, CAST(sum(net_amount) AS DECIMAL(22,2)) AS revenue, count(DISTINCT order_id) AS orders,
       count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units
FROM obt GROUP BY year""")
def q_kpi_revenue(spark, sf_dir):
    """K1: revenue and orders per year."""
    return K.revenue_and_orders(obt_df(spark, sf_dir))


@register("kpi_basket", O.with_ctes("obt") + """
SELECT year, count(*) AS orders,
       CAST(sum(order_net) AS DOUBLE) / count(order_net) AS avg_basket_value,
       CAST(sum(order_units) AS DOUBLE) / count(order_units) AS avg_basket_units
FROM (SELECT year, order_id, sum(net_amount) AS order_net, sum(quantity) AS order_units
      FROM obt GROUP BY year, order_id) GROUP BY year""")
def q_kpi_basket(spark, sf_dir):
    """K2: average basket value and units per order."""
    return K.basket_size(obt_df(spark, sf_dir))


@register("kpi_top_products", O.with_ctes("obt") + """
SELECT product_id, product_name, CAST(sum(net_amount) AS DECIMAL(22,2)) AS revenue,
       CAST(sum(quantity) AS BIGINT) AS units
FROM obt GROUP BY product_id, product_name ORDER BY revenue DESC, product_id ASC LIMIT 10""")
def q_kpi_top_products(spark, sf_dir):
    """K3: ten best-selling products by revenue (top-k report)."""
    return K.top_n(obt_df(spark, sf_dir), "product_id", "product_name", 10)


@register("kpi_top_stores", O.with_ctes("obt") + """
SELECT store_id, store_name, CAST(sum(net_amount) AS DECIMAL(22,2)) AS revenue,
       CAST(sum(quantity) AS BIGINT) AS units
FROM obt GROUP BY store_id, store_name ORDER BY revenue DESC, store_id ASC NULLS FIRST LIMIT 10""")
def q_kpi_top_stores(spark, sf_dir):
    """K3: ten best stores by revenue (online sales form the NULL store)."""
    return K.top_n(obt_df(spark, sf_dir), "store_id", "store_name", 10)


@register("kpi_trend_yoy", O.with_ctes("obt") + """
SELECT year, month, revenue,
       CASE WHEN lag(year) OVER (PARTITION BY month ORDER BY year) = year - 1
            THEN lag(revenue) OVER (PARTITION BY month ORDER BY year) END AS revenue_prev_year,
       lag(revenue) OVER (PARTITION BY year ORDER BY month) AS revenue_prev_month_same_year
FROM (SELECT year, month, CAST(sum(net_amount) AS DECIMAL(22,2)) AS revenue FROM obt GROUP BY year, month)""")
def q_kpi_trend(spark, sf_dir):
    """K4: monthly revenue trend with year-over-year comparison."""
    return K.monthly_trend(obt_df(spark, sf_dir))


_CM_SQL = """
cm AS (SELECT DISTINCT customer_id, CAST(date_trunc('month', transaction_date) AS DATE) AS month_start
       FROM obt WHERE customer_id IS NOT NULL),
firsts AS (SELECT customer_id, min(month_start) AS first_month FROM cm GROUP BY customer_id)"""


@register("kpi_new_returning", O.with_ctes("obt", extra=_CM_SQL) + """
SELECT month_start, count_if(month_start = first_month) AS new_customers,
       count_if(month_start > first_month) AS returning_customers
FROM cm JOIN firsts USING (customer_id) GROUP BY month_start""")
def q_kpi_new_returning(spark, sf_dir):
    """K5: new versus returning customers per month."""
    return K.new_vs_returning(obt_df(spark, sf_dir))


@register("kpi_cohort", O.with_ctes("obt", extra=_CM_SQL) + """
SELECT first_month AS cohort_month,
       CAST((year(month_start) - year(first_month)) * 12 + month(month_start) - month(first_month) AS INTEGER)
         AS months_since,
       count(*) AS active_customers
FROM cm JOIN firsts USING (customer_id) GROUP BY ALL""")
def q_kpi_cohort(spark, sf_dir):
    """K6: cohort retention (first purchase month x months since)."""
    return K.cohort_retention(obt_df(spark, sf_dir))


_INV_SQL = """
inv AS (SELECT *, CASE WHEN quantity_on_hand <= 0 THEN 'out_of_stock'
                       WHEN quantity_on_hand <= reorder_point THEN 'low_stock' ELSE 'in_stock' END AS stock_status,
               quantity_on_hand - quantity_reserved AS available_qty FROM inventory)"""


@register("kpi_low_stock", O.with_ctes("inventory", "dim_product", extra=_INV_SQL) + """
SELECT i.inventory_id, i.store_id, i.product_id, p.product_name, p.category, i.quantity_on_hand,
       i.reorder_point, i.available_qty, i.stock_status
FROM inv i LEFT JOIN dim_product p ON i.product_id = p.product_id
WHERE i.stock_status <> 'in_stock'""")
def q_kpi_low_stock(spark, sf_dir):
    """K7: low / out-of-stock alerts."""
    inv = silver.build_dim_inventory(RV.inventory(spark, sf_dir))
    return K.low_stock_alerts(inv, silver.build_dim_product(RV.products(spark, sf_dir)))


@register("kpi_stock_by_store", O.with_ctes("inventory", extra=_INV_SQL) + """
SELECT store_id, count(*) AS items, count_if(stock_status = 'out_of_stock') AS out_of_stock,
       count_if(stock_status = 'low_stock') AS low_stock, CAST(sum(available_qty) AS BIGINT) AS available_qty
FROM inv GROUP BY store_id""")
def q_kpi_stock_by_store(spark, sf_dir):
    """K7: stock position per store."""
    return K.stock_by_store(silver.build_dim_inventory(RV.inventory(spark, sf_dir)))


@register("kpi_filtered_category_month", O.with_ctes("obt") + """
SELECT product_category, year, month, CAST(sum(net_amount) AS DECIMAL(22,2)) AS revenue
FROM obt
WHERE CAST(transaction_date AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1998-06-30'
  AND product_category IN ('ECONOMY', 'PROMO')
GROUP BY product_category, year, month""")
def q_kpi_filtered(spark, sf_dir):
    """K8: date range and category filters (the filter is the feature)."""
    f = K.filter_sales(obt_df(spark, sf_dir), "1997-01-01", "1998-06-30", categories=["ECONOMY", "PROMO"])
    return f.groupBy("product_category", "year", "month").agg(F.sum("net_amount").alias("revenue"))


@register("kpi_turnover", O.with_ctes("obt", "inventory") + """
SELECT s.product_id, COALESCE(o.units_sold, 0) AS units_sold, s.units_on_hand,
       CASE WHEN s.units_on_hand > 0 THEN CAST(COALESCE(o.units_sold, 0) AS DOUBLE) / s.units_on_hand END AS turnover
FROM (SELECT product_id, CAST(sum(quantity_on_hand) AS BIGINT) AS units_on_hand FROM inventory GROUP BY product_id) s
LEFT JOIN (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units_sold FROM obt GROUP BY product_id) o
  ON s.product_id = o.product_id""")
def q_kpi_turnover(spark, sf_dir):
    """Inventory turnover per product."""
    inv = silver.build_dim_inventory(RV.inventory(spark, sf_dir))
    return K.inventory_turnover(obt_df(spark, sf_dir), inv)


@register("kpi_clv", O.with_ctes("obt") + """
SELECT customer_id, CAST(sum(net_amount) AS DECIMAL(22,2)) AS lifetime_revenue,
       count(DISTINCT order_id) AS orders,
       min(CAST(transaction_date AS DATE)) AS first_purchase, max(CAST(transaction_date AS DATE)) AS last_purchase,
       CAST(sum(net_amount) AS DOUBLE) / count(DISTINCT order_id) AS revenue_per_order
FROM obt WHERE customer_id IS NOT NULL GROUP BY customer_id""")
def q_kpi_clv(spark, sf_dir):
    """Customer lifetime value."""
    return K.customer_lifetime_value(obt_df(spark, sf_dir))


# ---------------------------------------------------------------- landing readers, contracts


# Contract of the orders extract used by the reader round trips.
ORDERS_CONTRACT = {
    "required": ["o_orderkey", "o_custkey", "o_orderdate"],
    "properties": {
        "o_orderkey": {"type": "integer", "minimum": 0},
        "o_custkey": {"type": "integer", "minimum": 0},
        "o_orderstatus": {"type": "string", "enum": ["F", "O", "P"]},
        "o_totalprice": {"type": "number", "minimum": 0},
        "o_orderdate": {"type": "string", "format": "date-time"},
        "o_orderpriority": {"type": "string"},
        "o_note": {"type": ["string", "null"]},
    },
}
_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_NOTE_SQL = "CASE WHEN year(o_orderdate) > 1997 THEN o_orderstatus || '-' || o_orderpriority END AS o_note"


def _orders_two_layouts(spark: SparkSession, sf_dir: str):
    """Orders up to 1997 in the first layout; later ones reordered, with a new column."""
    o = RV.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    y = F.year("o_orderdate")
    early = o.filter(y <= 1997).select(*_ORDER_COLS)
    late = o.filter(y > 1997).select(
        "o_orderpriority", "o_orderkey", "o_orderdate", "o_custkey", "o_totalprice", "o_orderstatus",
        F.concat_ws("-", "o_orderstatus", "o_orderpriority").alias("o_note"))
    return early, late


def _round_trip_out(df: DataFrame) -> DataFrame:
    return df.select(*_ORDER_COLS, "o_note").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


_ROUND_TRIP_SQL = f"SELECT {', '.join(_ORDER_COLS)}, {_NOTE_SQL} FROM orders"


@register("csv_round_trip", _ROUND_TRIP_SQL)
def q_csv_round_trip(spark, sf_dir):
    """CSV files whose headers drifted are read by name, typed by contract."""
    root = scratch_path(spark, "landing-csv")
    early, late = _orders_two_layouts(spark, sf_dir)
    early.write.option("header", "true").csv(f"{root}/orders/layout=1")
    late.write.option("header", "true").csv(f"{root}/orders/layout=2")
    return _round_trip_out(read_landing(spark, f"{root}/orders", "csv", ORDERS_CONTRACT))


@register("json_read", _ROUND_TRIP_SQL)
def q_json_read(spark, sf_dir):
    """JSON landing files read with the contract's schema."""
    root = scratch_path(spark, "landing-json")
    early, late = _orders_two_layouts(spark, sf_dir)
    early.write.json(f"{root}/orders/a")
    late.write.json(f"{root}/orders/b")
    return _round_trip_out(read_landing(spark, f"{root}/orders", "json", ORDERS_CONTRACT))


@register("parquet_read", _ROUND_TRIP_SQL)
def q_parquet_read(spark, sf_dir):
    """Parquet landing files (S3); files of both layouts merged by name."""
    root = scratch_path(spark, "landing-parquet")
    early, late = _orders_two_layouts(spark, sf_dir)
    early.write.parquet(f"{root}/orders/a")
    late.write.parquet(f"{root}/orders/b")
    return _round_trip_out(read_landing(spark, f"{root}/orders", "parquet"))


@register("csv_rescued", """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 10 = 0 THEN 'o_custkey' END AS rescued_column,
       CASE WHEN o_orderkey % 10 = 0 THEN CAST(o_custkey AS VARCHAR) || 'x' END AS rescued_raw
FROM orders""")
def q_csv_rescued(spark, sf_dir):
    """Text that does not convert stays beside its NULL, under its column's name."""
    rows = _bad_customers_landed(spark, sf_dir)
    lost = F.element_at("_rescued", 1)   # one column at most is broken here
    return rows.select("o_orderkey", "o_custkey", lost["column"].alias("rescued_column"), lost["raw"].alias("rescued_raw"))


def _bad_customers_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as CSV, the customer of every tenth key spoilt; read by contract."""
    root = scratch_path(spark, "landing-rescued")
    o = RV.table(spark, sf_dir, "orders").select(*_ORDER_COLS)
    spoilt = F.concat(F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 10 == 0, "x").otherwise(""))
    o.withColumn("o_custkey", spoilt).write.option("header", "true").csv(f"{root}/orders")
    return read_landing(spark, f"{root}/orders", "csv", ORDERS_CONTRACT)


@register("contract_violations_rescued", """
SELECT 'type:o_custkey' AS rule, count_if(o_orderkey % 10 = 0) AS violations FROM orders
UNION ALL SELECT 'required:o_custkey', count_if(o_custkey IS NULL) FROM orders
UNION ALL SELECT 'type:o_orderkey', 0 FROM (SELECT count(*) FROM orders)
UNION ALL SELECT 'type:o_totalprice', 0 FROM (SELECT count(*) FROM orders)""")
def q_contract_rescued(spark, sf_dir):
    """A typed read reports spoilt text as a broken type, not as a missing value."""
    found = C.contract_violations(_bad_customers_landed(spark, sf_dir), ORDERS_CONTRACT)
    return found.where(F.col("rule").startswith("type:o_") & (F.col("rule") != "type:o_orderdate")
                       | (F.col("rule") == "required:o_custkey"))


@register("json_drift", """
SELECT CAST(o_orderdate AS DATE) > DATE '1997-12-31' AS late, count(*) AS row_count,
       count_if(CAST(o_orderdate AS DATE) > DATE '1997-12-31') AS with_extra,
       'orders: columns added: o_extra | orders: columns omitted: o_note' AS late_drift,
       min(CASE WHEN CAST(o_orderdate AS DATE) > DATE '1997-12-31' THEN o_orderpriority END) AS first_extra
FROM orders GROUP BY 1""")
def q_json_drift(spark, sf_dir):
    """JSON lines whose files differ: a column outside the contract is found per file,
    reported and kept (S2, C1-C3)."""
    root = scratch_path(spark, "landing-json-drift")
    o = RV.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    late = F.year("o_orderdate") > 1997
    o.where(~late).select(*_ORDER_COLS).write.json(f"{root}/orders/a")
    o.where(late).select(*_ORDER_COLS, F.col("o_orderpriority").alias("o_extra")).write.json(f"{root}/orders/b")
    rows = read_landing(spark, f"{root}/orders", "json", ORDERS_CONTRACT)
    _, drift = read_files(spark, list_files(spark, f"{root}/orders/b"), "json", ORDERS_CONTRACT, "orders")
    return rows.groupBy((F.year("o_orderdate") > 1997).alias("late")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("o_extra").alias("with_extra"),
        F.lit(" | ".join(drift)).alias("late_drift"), F.min("o_extra").alias("first_extra"))


@register("ingest_ledger", """
SELECT 'r1' AS run_id, count(*) AS rows_read, count(*) AS rows_written, count(*) AS rows_in_bronze
FROM orders WHERE year(o_orderdate) <= 1995
UNION ALL
SELECT 'r2', count(*), count(*), (SELECT count(*) FROM orders) FROM orders WHERE year(o_orderdate) > 1995
UNION ALL
SELECT 'r3', 0, 0, count(*) FROM orders""")
def q_ingest_ledger(spark, sf_dir):
    """Orders delivered in two parts, ingested three times: a run opens only files that
    the ledger does not know, the third opens none (S13, S14)."""
    root = scratch_path(spark, "ingest-ledger")
    o = RV.table(spark, sf_dir, "orders").select(*_ORDER_COLS).withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp"))
    spec = SourceSpec("orders", "orders", "csv", "o_orderkey", (), ORDERS_CONTRACT)
    out = []
    for run, part in (("r1", F.year("o_orderdate") <= 1995), ("r2", F.year("o_orderdate") > 1995), ("r3", None)):
        if part is not None:
            o.where(part).write.mode("append").option("header", "true").csv(f"{root}/landing/orders")
        ctx = L.RunContext(spark, f"{root}/landing", f"{root}/lake", run_id=run, as_of=_dt.datetime(2024, 1, 1, 6, 0))
        done = L.ingest_source(ctx, spec)
        out.append((run, done["rows_read"], done["rows_written"], L.bronze_table(ctx, "orders").count()))
    return spark.createDataFrame(out, "run_id string, rows_read long, rows_written long, rows_in_bronze long")


# ---------------------------------------------------------------- whole layered run


LAKE_TABLES = {
    "bronze": ("sales", "customers", "products", "stores", "inventory"),
    "silver": ("dim_date", "dim_store", "dim_customer", "dim_product", "dim_inventory", "fact_sales"),
    "gold": ("dim_customer", "dim_product", "dim_store", "dim_date", "fact_sales", "obt_sales",
             "agg_daily_sales", "agg_monthly_sales"),
}
LAKE_CALENDAR = ("1990-01-01", "2030-12-31")


_LAKE_RUNS: dict[tuple[str, str], L.RunContext] = {}


def run_lake(spark: SparkSession, sf_dir: str) -> L.RunContext:
    """Landing files from the driver tables, then bronze -> silver -> gold with checks.

    One run per session and input folder; the lake queries read its tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _LAKE_RUNS:
        return _LAKE_RUNS[key]
    root = scratch_path(spark, "lake")
    with shuffles_dropped(spark):
        RV.write_landing(spark, sf_dir, f"{root}/landing")
    last = RV.table(spark, sf_dir, "orders").agg(F.max("o_orderdate").alias("d")).first()["d"]   # one row
    as_of = _dt.datetime(last.year, last.month, last.day, 6) + _dt.timedelta(days=1)   # the morning after the last sale
    ctx = L.RunContext(spark, f"{root}/landing", f"{root}/lake", as_of=as_of,
                       calendar_start=LAKE_CALENDAR[0], calendar_end=LAKE_CALENDAR[1])
    L.run_layers(ctx, halt=False)
    _LAKE_RUNS[key] = ctx
    return ctx


def lake_tables(ctx: L.RunContext) -> dict[str, DataFrame]:
    out = {}
    for layer, names in LAKE_TABLES.items():
        read = {"bronze": L.bronze_table, "silver": L.silver_table, "gold": L.gold_table}[layer]
        for n in names:
            out[f"{layer}.{n}"] = read(ctx, n)
    out[R.QUALITY_LOG] = ctx.spark.read.parquet(f"{ctx.lake_root}/{R.QUALITY_LOG}")
    out[R.PIPELINE_RUNS] = ctx.spark.read.parquet(f"{ctx.lake_root}/{R.PIPELINE_RUNS}")
    return out


# In the lake the ids are prefixed strings, so "latest" duplicates are ordered as text.
O.SILVER_CTES["fact_lake"] = O.SILVER_CTES["fact"].replace("fact_latest", "fl_latest").replace(
    "fact_g", "fl_g").replace("fact_d", "fl_d").replace("fact AS (", "fact_lake AS (").replace(
    "store_id DESC NULLS LAST,\n      customer_id DESC NULLS LAST, product_id DESC NULLS LAST",
    "'STR-' || store_id DESC NULLS LAST,\n      'CUST-' || customer_id DESC NULLS LAST, "
    "'PRD-' || product_id DESC NULLS LAST")
O.SILVER_CTES["obt_lake"] = O.SILVER_CTES["obt"].replace("obt AS (", "obt_lake AS (").replace(
    "FROM fact f", "FROM fact_lake f")
O._DEPENDS["fact_lake"] = ("sales",)
O._DEPENDS["obt_lake"] = ("sales", "customers", "products", "stores", "fact_lake", "dim_customer",
                          "dim_product", "dim_store")
assert "'STR-' || store_id" in O.SILVER_CTES["fact_lake"]


@register("lake_table_counts", O.with_ctes("obt_lake", "inventory") + f"""
SELECT * FROM (VALUES
  ('bronze.sales', (SELECT count(DISTINCT transaction_id) FROM sales)),
  ('bronze.customers', (SELECT count(*) FROM customer)),
  ('bronze.products', (SELECT count(*) FROM part)),
  ('bronze.stores', (SELECT count(*) FROM supplier)),
  ('bronze.inventory', (SELECT count(*) FROM part)),
  ('silver.dim_date', (SELECT CAST(DATE '{LAKE_CALENDAR[1]}' - DATE '{LAKE_CALENDAR[0]}' + 1 AS BIGINT))),
  ('silver.dim_store', (SELECT count(*) FROM supplier)),
  ('silver.dim_customer', (SELECT count(*) FROM customer)),
  ('silver.dim_product', (SELECT count(*) FROM part)),
  ('silver.dim_inventory', (SELECT count(*) FROM part)),
  ('silver.fact_sales', (SELECT count(*) FROM fact_lake)),
  ('gold.dim_customer', (SELECT count(*) FROM customer)),
  ('gold.dim_product', (SELECT count(*) FROM part)),
  ('gold.dim_store', (SELECT count(*) FROM supplier)),
  ('gold.dim_date', (SELECT CAST(DATE '{LAKE_CALENDAR[1]}' - DATE '{LAKE_CALENDAR[0]}' + 1 AS BIGINT))),
  ('gold.fact_sales', (SELECT count(*) FROM fact_lake)),
  ('gold.obt_sales', (SELECT count(*) FROM obt_lake)),
  ('gold.agg_daily_sales', (SELECT count(*) FROM (SELECT DISTINCT year, month, CAST(transaction_date AS DATE),
      store_id, store_name, store_region, product_category, channel FROM obt_lake))),
  ('gold.agg_monthly_sales', (SELECT count(*) FROM (SELECT DISTINCT year, month, store_id, store_name,
      store_region, product_category, channel FROM obt_lake))),
  ('{R.QUALITY_LOG}', 86),
  ('{R.PIPELINE_RUNS}', 19)
) AS t(table_name, row_count)""")
def q_lake_counts(spark, sf_dir):
    """Whole run from landing files to Gold with checks; row count per table."""
    ctx = run_lake(spark, sf_dir)
    return R.table_counts(lake_tables(ctx))


# ---------------------------------------------------------------- streaming



EVENTS_SCHEMA = _T.StructType([
    _T.StructField("event_id", _T.LongType()), _T.StructField("ts", _T.TimestampType()),
    _T.StructField("user_id", _T.LongType()), _T.StructField("event_type", _T.StringType()),
    _T.StructField("value", _T.DoubleType()), _T.StructField("props", _T.StringType()),
])


def _land_events(spark: SparkSession, sf_dir: str, root: str, files: int = 12, mode: str = "error") -> str:
    """Events as CSV files, spread evenly (round robin) over at least ``files``
    files, so each micro-batch holds events from all over the period."""
    path = f"{root}/landing/events"
    n = max(files, spark.sparkContext.defaultParallelism)
    (RV.events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
     .repartition(n).write.mode(mode).option("header", "true")
     .option("timestampFormat", S.TIMESTAMP_FORMAT).csv(path))
    return path


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


@register("stream_ingest", "SELECT *, 'events' AS _source FROM events")
def q_stream_ingest(spark, sf_dir):
    """Triggered file stream into Bronze, run twice: exactly once."""
    root = scratch_path(spark, "stream-ingest")
    landing = _land_events(spark, sf_dir, root)
    for _ in range(2):  # the second run finds no new file and adds nothing
        s = S.landing_stream(spark, landing, EVENTS_SCHEMA, max_files_per_trigger=4)
        s = S.with_expectations(S.with_stream_lineage(s, "events"), EVENT_EXPECTATIONS, "warn")
        S.start_file_sink(s, f"{root}/bronze/events", f"{root}/_checkpoints/events").awaitTermination()
    out = spark.read.parquet(f"{root}/bronze/events")
    return _ntz(out.select(*EVENTS_SCHEMA.names, "_source"), "ts")


@register("stream_scd2", _FEED_SQL)
def q_stream_scd2(spark, sf_dir):
    """Versions maintained by micro-batches arriving out of order (T5); equals the batch result."""
    root = scratch_path(spark, "stream-scd2")
    landing = _land_events(spark, sf_dir, root)
    stream = S.landing_stream(spark, landing, EVENTS_SCHEMA, max_files_per_trigger=4)
    start_scd2_stream(stream, f"{root}/feed", f"{root}/versions", f"{root}/_checkpoints/scd2",
                      keys=["user_id"], sequence_by=["ts", "event_id"], tracked=["event_type"],
                      except_columns=["props"], buckets=16).awaitTermination()
    out = read_versioned(spark, f"{root}/versions").drop(BUCKET)
    return _ntz(out, "ts", "scd_effective_from", "scd_effective_to")


# ---------------------------------------------------------------- contracts on data, sketches


# Contract of the event table (used for the contract checks).
EVENTS_CONTRACT = {
    "required": ["event_id", "ts", "user_id", "event_type"],
    "properties": {
        "event_id": {"type": "integer", "minimum": 0},
        "ts": {"type": "string", "format": "date-time"},
        "user_id": {"type": "integer", "minimum": 0},
        "event_type": {"type": "string", "enum": ["view", "click", "purchase", "signup"]},
        "value": {"type": ["number", "null"], "minimum": 0, "maximum": 100},
        "props": {"type": ["string", "null"], "pattern": r'^\{"k": \d+\}$'},
    },
}


@register("contract_violations_events", """
SELECT 'required:event_id' AS rule, count_if(event_id IS NULL) AS violations FROM events
UNION ALL SELECT 'required:ts', count_if(ts IS NULL) FROM events
UNION ALL SELECT 'required:user_id', count_if(user_id IS NULL) FROM events
UNION ALL SELECT 'required:event_type', count_if(event_type IS NULL) FROM events
UNION ALL SELECT 'minimum:event_id', count_if(event_id < 0) FROM events
UNION ALL SELECT 'type:ts', count_if(ts IS NOT NULL AND TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) IS NULL) FROM events
UNION ALL SELECT 'format:ts', count_if(ts IS NOT NULL AND TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) IS NULL) FROM events
UNION ALL SELECT 'minimum:user_id', count_if(user_id < 0) FROM events
UNION ALL SELECT 'enum:event_type', count_if(event_type NOT IN ('view', 'click', 'purchase', 'signup')) FROM events
UNION ALL SELECT 'minimum:value', count_if(value < 0) FROM events
UNION ALL SELECT 'maximum:value', count_if(value > 100) FROM events
UNION ALL SELECT 'pattern:props', count_if(NOT regexp_matches(props, '^\\{"k": \\d+\\}$')) FROM events""")
def q_contract_events(spark, sf_dir):
    """Declared value rules of a contract counted in one pass."""
    return C.contract_violations(RV.events(spark, sf_dir), EVENTS_CONTRACT)


def customers_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = RV.customers(spark, sf_dir)
    return c.withColumn("customer_id", F.concat(F.lit("CUST-"), F.col("customer_id").cast("string")))


@register("contract_violations_customers", O.with_ctes("customers") + """
SELECT 'required:customer_id' AS rule, count_if(customer_id IS NULL) AS violations FROM customers
UNION ALL SELECT 'required:first_name', count_if(first_name IS NULL) FROM customers
UNION ALL SELECT 'required:last_name', count_if(last_name IS NULL) FROM customers
UNION ALL SELECT 'required:email', count_if(email IS NULL) FROM customers
UNION ALL SELECT 'required:registration_date', count_if(registration_date IS NULL) FROM customers
UNION ALL SELECT 'pattern:customer_id', count_if(NOT regexp_matches('CUST-' || CAST(customer_id AS VARCHAR), '^CUST-\\d+$')) FROM customers
UNION ALL SELECT 'format:email', count_if(NOT regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')) FROM customers
UNION ALL SELECT 'format:date_of_birth', count_if(false) FROM customers
UNION ALL SELECT 'enum:gender', count_if(gender NOT IN ('M', 'F', 'O')) FROM customers
UNION ALL SELECT 'enum:loyalty_tier', count_if(loyalty_tier NOT IN ('Bronze', 'Silver', 'Gold', 'Platinum')) FROM customers
UNION ALL SELECT 'minimum:loyalty_points', count_if(loyalty_points < 0) FROM customers
UNION ALL SELECT 'format:registration_date', count_if(false) FROM customers""")
def q_contract_customers(spark, sf_dir):
    """The customer contract's rules on customers in landing form."""
    return C.contract_violations(customers_landing(spark, sf_dir), CUSTOMERS_CONTRACT)


@register("contract_valid_rows_customers", O.with_ctes("customers") + """
SELECT 'CUST-' || CAST(customer_id AS VARCHAR) AS customer_id, * EXCLUDE (customer_id) FROM customers
WHERE regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')
  AND (loyalty_tier IS NULL OR loyalty_tier IN ('Bronze', 'Silver', 'Gold', 'Platinum'))
  AND (loyalty_points IS NULL OR loyalty_points >= 0)""")
def q_contract_valid(spark, sf_dir):
    """Rows meeting every contract rule; the rest go to a quarantine."""
    valid, _ = C.split_by_contract(customers_landing(spark, sf_dir), CUSTOMERS_CONTRACT)
    return valid


@register("agg_customers_exact_bitmaps", O.with_ctes("fact") + """
SELECT 'month' AS grain, CAST(date_trunc('month', transaction_date) AS DATE) AS period, channel,
       count(DISTINCT customer_id) AS distinct_customers
FROM fact WHERE customer_id IS NOT NULL GROUP BY ALL
UNION ALL
SELECT 'year', CAST(date_trunc('year', transaction_date) AS DATE), channel, count(DISTINCT customer_id)
FROM fact WHERE customer_id IS NOT NULL GROUP BY ALL""")
def q_customers_bitmaps(spark, sf_dir):
    """Exact distinct customers per month and year, merged from daily bitmaps (A3)."""
    fact = fact_sales_df(spark, sf_dir).select("transaction_date", "channel", "customer_id")
    numbers = B.number_values(RV.customers(spark, sf_dir), "customer_id")
    path = scratch_path(spark, "daily-bitmaps")
    B.value_bitmaps(fact, [F.to_date("transaction_date").alias("day"), "channel"], "customer_id", numbers).write.parquet(path)
    daily = spark.read.parquet(path)
    out = [B.count_bitmaps(daily.withColumn("period", F.trunc("day", grain)), ["period", "channel"], "distinct_customers")
           .select(F.lit(grain).alias("grain"), "period", "channel", "distinct_customers") for grain in ("month", "year")]
    return out[0].unionByName(out[1])


def _point_in_time_sql() -> str:
    merged = _merge_sql(True).replace(RUN_DATE, "1996-01-01").replace(MERGE_DATE, "1998-06-01")
    ctes = O.with_ctes("fact", "dim_customer", "dim_customer2")
    return ctes.rstrip() + ", versions AS (" + merged[len(O.with_ctes("dim_customer", "dim_customer2")):] + """)
SELECT f.transaction_id, f.customer_id, v.loyalty_tier, v.loyalty_points, v.scd_effective_from
FROM fact f LEFT JOIN versions v ON f.customer_id = v.customer_id
 AND f.transaction_date >= v.scd_effective_from AND f.transaction_date < v.scd_effective_to"""


@register("fact_point_in_time", _point_in_time_sql())
def q_point_in_time(spark, sf_dir):
    """Sales with the customer version valid at the sale date, not the current one (answers Q5)."""
    from tierlake.plans.silver import CUSTOMER_TRACKED
    first = scd2_initial(silver.build_dim_customer(RV.customers(spark, sf_dir)), "1996-01-01")
    second = silver.build_dim_customer(RV.customer_snapshot_2(spark, sf_dir))
    versions = scd2_merge(first, second, "customer_id", CUSTOMER_TRACKED, "1998-06-01")
    versions = versions.withColumn("valid_to", F.when(~F.col("scd_is_current"), F.col("scd_effective_to")))
    facts = fact_sales_df(spark, sf_dir).select("transaction_id", "customer_id", "transaction_date")
    return lookup_valid(facts, versions, "customer_id", "transaction_date", "scd_effective_from", "valid_to",
                        ["loyalty_tier", "loyalty_points", "scd_effective_from"]).drop("transaction_date")


@register("agg_daily_after_changes", O.with_ctes("fact", extra="""
final AS (
  SELECT * REPLACE (CASE WHEN transaction_id % 13 = 0 THEN CAST(net_amount + 1 AS DECIMAL(24,2)) ELSE net_amount END AS net_amount,
                    CASE WHEN transaction_id % 17 = 0 THEN NULL ELSE store_id END AS store_id)
  FROM fact WHERE NOT (transaction_id % 11 = 0 AND channel = 'R'))""") + """
SELECT CAST(transaction_date AS DATE) AS day, store_id, channel, count(*) AS num_transactions,
       count(DISTINCT customer_id) AS num_customers, CAST(sum(quantity) AS BIGINT) AS total_units,
       CAST(sum(net_amount) AS DECIMAL(34,2)) AS total_net_revenue
FROM final GROUP BY ALL""")
def q_daily_after_changes(spark, sf_dir):
    """A daily roll-up carried through two change sets: new sales and returns, then corrected
    amounts and stores; equals the roll-up of the final rows (S17 -> A1)."""
    group = ["day", "store_id", "channel"]
    root = scratch_path(spark, "daily-changes")
    final = fact_sales_df(spark, sf_dir).withColumn("day", F.to_date("transaction_date")).select(
        "transaction_id", *group, "customer_id", "quantity", "net_amount")
    final.write.parquet(f"{root}/final")   # the states are filters of it: the sales are joined and cleansed once
    final = spark.read.schema(final.schema).parquet(f"{root}/final")
    one = final.where(F.col("transaction_id") % 7 != 0)                                  # the first load
    two = final.where(~((F.col("transaction_id") % 11 == 0) & (F.col("channel") == "R")))   # late sales come, returns go
    three = two.withColumn("net_amount", F.when(F.col("transaction_id") % 13 == 0, (F.col("net_amount") + 1).cast(
        "decimal(24,2)")).otherwise(F.col("net_amount"))).withColumn(
        "store_id", F.when(F.col("transaction_id") % 17 != 0, F.col("store_id")))

    def daily(rows):
        return rows.groupBy(*group).agg(
            F.count(F.lit(1)).alias("num_transactions"), F.count_distinct("customer_id").alias("num_customers"),
            F.sum("quantity").alias("total_units"), F.sum("net_amount").alias("total_net_revenue"))

    states = [one, two, three]
    rollup = daily(states[0])
    for i, (old, new) in enumerate(zip(states, states[1:])):
        rollup.write.parquet(f"{root}/rollup{i}")
        rollup = refresh_rollup(spark.read.parquet(f"{root}/rollup{i}"), new,
                                touched_groups(old, new, "transaction_id", group), group, daily)
    return rollup


@register("stream_drift", _ROUND_TRIP_SQL)
def q_stream_drift(spark, sf_dir):
    """A stream of landing files that gain a column and change their order goes on; the table is
    read by the remembered schema (T3, C2, C3)."""
    root = scratch_path(spark, "stream-drift")
    spec = SourceSpec("orders", "orders", "csv", "o_orderkey", (), ORDERS_CONTRACT)
    for i, part in enumerate(_orders_two_layouts(spark, sf_dir)):
        part.write.option("header", "true").csv(f"{root}/landing/layout={i}")
        start_drifting_stream(spark, f"{root}/landing", spec, f"{root}/bronze", f"{root}/schemas",
                              f"{root}/_checkpoint").awaitTermination()
    return _round_trip_out(read_drifting(spark, f"{root}/bronze", f"{root}/schemas"))


@register("stream_dedupe", "SELECT * FROM events")
def q_stream_dedupe(spark, sf_dir):
    """Every event delivered twice, in different files and micro-batches: each is kept once (P8 in a stream)."""
    root = scratch_path(spark, "stream-dedupe")
    landing = _land_events(spark, sf_dir, root, files=8)
    _land_events(spark, sf_dir, root, files=8, mode="append")
    stream = S.landing_stream(spark, landing, EVENTS_SCHEMA, max_files_per_trigger=4)
    once = S.drop_redelivered(stream, ["event_id"], "ts", "366 days")
    S.start_file_sink(once, f"{root}/bronze/events", f"{root}/_checkpoints/events", partition_by=()).awaitTermination()
    return _ntz(spark.read.parquet(f"{root}/bronze/events"), "ts")


@register("agg_monthly_customers_sketch")
def q_customers_sketch(spark, sf_dir):
    """Approximate distinct customers per month from mergeable daily HLL sketches (A3)."""
    return gold.monthly_customers_from_sketches(gold.daily_customer_sketches(obt_df(spark, sf_dir)))


_LAKE_COUNTS_SQL = ORACLE_SQL["lake_table_counts"]


@register("lake_run_log", f"""
SELECT split_part(table_name, '.', 1) AS layer, split_part(table_name, '.', 2) AS source,
       'success' AS status,
       CASE WHEN table_name = 'bronze.sales' THEN (SELECT count(*) FROM lineitem)
            WHEN table_name LIKE 'bronze.%' THEN row_count END AS rows_read,
       row_count AS rows_written
FROM ({_LAKE_COUNTS_SQL}) WHERE table_name LIKE '%.%'""")
def q_lake_run_log(spark, sf_dir):
    """Run records of the layered run (R1, K10): rows read and written per table."""
    ctx = run_lake(spark, sf_dir)
    runs = spark.read.parquet(f"{ctx.lake_root}/{R.PIPELINE_RUNS}")
    return runs.select("layer", "source", "status", "rows_read", "rows_written")


_LOADED = "date_trunc('day', max(o_orderdate)) + INTERVAL 30 HOUR"


@register("lake_freshness", "\nUNION ALL\n".join(
    f"SELECT 'gold.{t}' AS table_name, CAST({_LOADED} AS TIMESTAMP) AS last_loaded_at FROM orders" for t in LAKE_TABLES["gold"]))
def q_lake_freshness(spark, sf_dir):
    """Last load time per Gold table (K9)."""
    ctx = run_lake(spark, sf_dir)
    out = K.freshness({f"gold.{t}": L.gold_table(ctx, t) for t in LAKE_TABLES["gold"]})
    return out.withColumn("last_loaded_at", F.col("last_loaded_at").cast("timestamp_ntz"))


def _lake_rules_sql() -> str:
    """Rule results of a lake run: the rule sets over the driver's tables, sales without copies of a line."""
    swap = {"sales": "fl_latest", "fact": "fact_lake", "obt": "obt_lake"}
    daily = RULE_INPUTS["gold.agg_daily_sales"][3].replace("FROM obt\n", "FROM obt_lake\n")
    ctes = dict.fromkeys(["fact_lake", "obt_lake", *(c for s in RULE_SETS for c in RULE_INPUTS[s][2] if c not in swap)])
    sets = [f"SELECT '{s}' AS source, '{layer}' AS layer, * FROM ("
            + O.rule_set_sql(swap.get(RULE_INPUTS[s][1], RULE_INPUTS[s][1]), rules) + ")"
            for s, (layer, rules) in RULE_SETS.items()]
    return O.with_ctes(*ctes, extra=daily).rstrip() + ", results AS (" + "\nUNION ALL\n".join(sets) + ")"


@register("lake_failure_trend", _lake_rules_sql() + """
SELECT (SELECT CAST(date_trunc('day', max(o_orderdate)) + INTERVAL 30 HOUR AS DATE) FROM orders) AS day, layer, count(*) AS rules, count_if(NOT passed) AS failed,
       count_if(NOT passed) / count(*) AS failure_rate
FROM results GROUP BY layer""")
def q_lake_failure_trend(spark, sf_dir):
    """Failed-rule share per day and layer from the quality log."""
    ctx = run_lake(spark, sf_dir)
    log = spark.read.parquet(f"{ctx.lake_root}/{R.QUALITY_LOG}")
    return K.failure_rate_trend(log.where("description <> 'row policy'"))


@register("lake_critical_failures", _lake_rules_sql() + """
SELECT layer, source, rule_name, failed_count FROM results WHERE NOT passed AND severity = 'CRITICAL'""")
def q_lake_critical(spark, sf_dir):
    """The CRITICAL failure feed of the quality log."""
    ctx = run_lake(spark, sf_dir)
    log = spark.read.parquet(f"{ctx.lake_root}/{R.QUALITY_LOG}")
    return K.critical_failures(log).select("layer", "source", "rule_name", "failed_count")


@register("agg_instant_events", """
SELECT ts AS period, event_type, count(*) AS events, count(DISTINCT user_id) AS distinct_users,
       round(sum(value), 6) AS total_value
FROM events GROUP BY ts, event_type""")
def q_events_instant(spark, sf_dir):
    """Roll-up keyed by the raw timestamp: one group per instant (A1 at instant grain, Q1)."""
    out = gold.events_by_grain(RV.events(spark, sf_dir), "instant")
    return out.withColumn("total_value", F.round("total_value", 6))


@register("agg_daily_events", """
SELECT CAST(ts AS DATE) AS period, event_type, count(*) AS events, count(DISTINCT user_id) AS distinct_users,
       round(sum(value), 6) AS total_value
FROM events GROUP BY CAST(ts AS DATE), event_type""")
def q_events_daily(spark, sf_dir):
    """The same roll-up at day grain (A1); sums of doubles rounded for the cross-check."""
    out = gold.events_by_grain(RV.events(spark, sf_dir), "day")
    return out.withColumn("total_value", F.round("total_value", 6))


@register("lake_run_history", f"""
SELECT split_part(table_name, '.', 1) AS layer, CAST(sum(row_count) AS BIGINT) AS rows_written,
       CAST(0 AS BIGINT) AS failed_steps
FROM ({_LAKE_COUNTS_SQL}) WHERE table_name LIKE '%.%' GROUP BY 1""")
def q_lake_run_history(spark, sf_dir):
    """Run history per layer (K10): rows written and failed steps (run id left out)."""
    ctx = run_lake(spark, sf_dir)
    runs = spark.read.parquet(f"{ctx.lake_root}/{R.PIPELINE_RUNS}")
    return R.run_history(runs).groupBy("layer").agg(
        F.sum("rows_written").alias("rows_written"), F.sum("failed_steps").alias("failed_steps"))


@register("landing_layouts", f"""
SELECT 1 AS layout,
       'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS header,
       'orders: columns omitted: o_note' AS drift,
       count(*) AS row_count
FROM orders WHERE year(o_orderdate) <= 1997
UNION ALL
SELECT 2, 'o_orderpriority,o_orderkey,o_orderdate,o_custkey,o_totalprice,o_orderstatus,o_note', '', count(*)
FROM orders WHERE year(o_orderdate) > 1997""")
def q_landing_layouts(spark, sf_dir):
    """Header layouts found in a landing folder, their drift against the contract
    and the rows read with each (S1, C1-C3): headers are file metadata, rows are
    counted by Spark over the whole files."""
    from tierlake.sources.landing import header_groups
    root = scratch_path(spark, "landing-layouts")
    early, late = _orders_two_layouts(spark, sf_dir)
    early.write.option("header", "true").csv(f"{root}/orders/layout=1")
    late.write.option("header", "true").csv(f"{root}/orders/layout=2")
    files = list_files(spark, f"{root}/orders")
    layouts = []
    for i, (header, group) in enumerate(header_groups(spark, files).items(), start=1):
        drift = " | ".join(C.describe_drift(header, ORDERS_CONTRACT, "orders"))
        layouts += [(f, i, ",".join(header), drift) for f in group]
    meta = spark.createDataFrame(layouts, "_source_file string, layout int, header string, drift string")
    rows = read_landing(spark, f"{root}/orders", "csv", ORDERS_CONTRACT).groupBy("_source_file").count()
    return (rows.join(meta, "_source_file").groupBy("layout", "header", "drift")
            .agg(F.sum("count").alias("row_count")))
