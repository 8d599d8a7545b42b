"""Dashboard KPI queries over the Gold tables.

All are aggregations of the OBT (or of inventory); windows only run over
already-aggregated rows and are partitioned (no single-task global window).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions import measures as M


def revenue_and_orders(obt: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    """K1: revenue, distinct orders, lines and units per group."""
    return obt.groupBy(*by).agg(
        F.sum("net_amount").alias("revenue"),
        F.count_distinct("order_id").alias("orders"),
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("units"),
    )


def basket_size(obt: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    """K2: average basket per ORDER (not per line, the fix for Q4)."""
    per_order = obt.groupBy(*by, "order_id").agg(
        F.sum("net_amount").alias("order_net"), F.sum("quantity").alias("order_units"))
    return per_order.groupBy(*by).agg(
        F.count(F.lit(1)).alias("orders"),
        M.ratio_avg(F.sum("order_net"), F.count("order_net")).alias("avg_basket_value"),
        M.ratio_avg(F.sum("order_units"), F.count("order_units")).alias("avg_basket_units"),
    )


def top_n(obt: DataFrame, key: str, label: str | None, n: int = 10) -> DataFrame:
    """K3: the n best keys by revenue; ties broken by key (a top-k report)."""
    cols = [key] + ([label] if label else [])
    ranked = obt.groupBy(*cols).agg(F.sum("net_amount").alias("revenue"),
                                    F.sum("quantity").alias("units"))
    return ranked.orderBy(F.col("revenue").desc(), F.col(key).asc()).limit(n)


def monthly_trend(obt: DataFrame) -> DataFrame:
    """K4: monthly revenue with month-over-month and year-over-year change.

    The YoY lag is partitioned by calendar month (12 partitions of yearly
    rows) and the MoM lag by year, so no window runs in a single task.
    """
    m = obt.groupBy("year", "month").agg(F.sum("net_amount").alias("revenue"))
    prev_year = F.lag("revenue").over(Window.partitionBy("month").orderBy("year"))
    yoy_gap = F.lag("year").over(Window.partitionBy("month").orderBy("year"))
    prev_month = F.lag("revenue").over(Window.partitionBy("year").orderBy("month"))
    return m.select(
        "year", "month", "revenue",
        F.when(yoy_gap == F.col("year") - 1, prev_year).alias("revenue_prev_year"),
        prev_month.alias("revenue_prev_month_same_year"),
    )


def _customer_months(obt: DataFrame) -> DataFrame:
    return (obt.filter(F.col("customer_id").isNotNull())
            .select("customer_id", F.trunc(F.to_date("transaction_date"), "month").alias("month_start"))
            .distinct())


def new_vs_returning(obt: DataFrame) -> DataFrame:
    """K5: per month, customers buying for the first time vs returning."""
    cm = _customer_months(obt)
    first = cm.groupBy("customer_id").agg(F.min("month_start").alias("first_month"))
    j = cm.join(first, "customer_id")
    return j.groupBy("month_start").agg(
        F.count_if(F.col("month_start") == F.col("first_month")).alias("new_customers"),
        F.count_if(F.col("month_start") > F.col("first_month")).alias("returning_customers"),
    )


def cohort_retention(obt: DataFrame) -> DataFrame:
    """K6: active customers by first-purchase month and months since then."""
    cm = _customer_months(obt)
    first = cm.groupBy("customer_id").agg(F.min("month_start").alias("cohort_month"))
    j = cm.join(first, "customer_id")
    since = F.months_between("month_start", "cohort_month").cast(T.IntegerType())
    return j.groupBy("cohort_month", since.alias("months_since")).agg(
        F.count(F.lit(1)).alias("active_customers"))


def low_stock_alerts(dim_inventory: DataFrame, dim_product: DataFrame) -> DataFrame:
    """K7: inventory rows that are low or out of stock, with the product name."""
    alerts = dim_inventory.filter(F.col("stock_status") != "in_stock")
    names = dim_product.select("product_id", "product_name", "category")
    return alerts.join(names, "product_id", "left").select(
        "inventory_id", "store_id", "product_id", "product_name", "category",
        "quantity_on_hand", "reorder_point", "available_qty", "stock_status")


def stock_by_store(dim_inventory: DataFrame) -> DataFrame:
    """K7: stock position per store."""
    return dim_inventory.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.col("stock_status") == "out_of_stock").alias("out_of_stock"),
        F.count_if(F.col("stock_status") == "low_stock").alias("low_stock"),
        F.sum("available_qty").alias("available_qty"),
    )


def filter_sales(obt: DataFrame, start: str | None = None, end: str | None = None,
                 stores: Sequence | None = None, categories: Sequence[str] | None = None) -> DataFrame:
    """K8: dashboard filters on a date range (inclusive days), stores and categories.

    The date bounds are written so a stored OBT is pruned: a half-open
    timestamp range on ``transaction_date`` (row-group statistics) and the
    equivalent ``year``/``month`` bounds (partition pruning; rows outside the
    calendar have NULL year/month and are kept by the date test alone).
    """
    out = obt
    ts = F.col("transaction_date")
    y, m = F.col("year"), F.col("month")
    if start is not None:
        s = dt.date.fromisoformat(start)
        out = out.filter((ts >= F.lit(s.isoformat()).cast(T.TimestampType()))
                         & (y.isNull() | (y > s.year) | ((y == s.year) & (m >= s.month))))
    if end is not None:
        e = dt.date.fromisoformat(end)
        out = out.filter((ts < F.lit((e + dt.timedelta(days=1)).isoformat()).cast(T.TimestampType()))
                         & (y.isNull() | (y < e.year) | ((y == e.year) & (m <= e.month))))
    if stores is not None:
        out = out.filter(F.col("store_id").isin(list(stores)))
    if categories is not None:
        out = out.filter(F.col("product_category").isin(list(categories)))
    return out


def freshness(tables: dict[str, DataFrame], stamp: str = "_gold_loaded_at") -> DataFrame:
    """K9: last load time per table (one small aggregate per table)."""
    parts = [df.agg(F.max(stamp).alias("last_loaded_at")).select(F.lit(name).alias("table_name"), "last_loaded_at")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def inventory_turnover(obt: DataFrame, dim_inventory: DataFrame) -> DataFrame:
    """Units sold per product over units on hand (NULL when none on hand)."""
    sold = obt.groupBy("product_id").agg(F.sum("quantity").alias("units_sold"))
    stock = dim_inventory.groupBy("product_id").agg(F.sum("quantity_on_hand").alias("units_on_hand"))
    j = stock.join(sold, "product_id", "left").fillna(0, ["units_sold"])
    return j.select("product_id", "units_sold", "units_on_hand",
                    F.when(F.col("units_on_hand") > 0,
                           F.col("units_sold").cast("double") / F.col("units_on_hand")).alias("turnover"))


def customer_lifetime_value(obt: DataFrame) -> DataFrame:
    """Per customer revenue, orders, first/last purchase, value per order."""
    per = obt.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.sum("net_amount").alias("lifetime_revenue"),
        F.count_distinct("order_id").alias("orders"),
        F.min(F.to_date("transaction_date")).alias("first_purchase"),
        F.max(F.to_date("transaction_date")).alias("last_purchase"),
    )
    return per.withColumn("revenue_per_order", M.ratio_avg("lifetime_revenue", "orders"))


def failure_rate_trend(quality_log: DataFrame) -> DataFrame:
    """Share of failed rules per day and layer."""
    return quality_log.groupBy(F.to_date("checked_at").alias("day"), "layer").agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(~F.col("passed")).alias("failed"),
    ).withColumn("failure_rate", F.col("failed") / F.col("rules"))


def critical_failures(quality_log: DataFrame) -> DataFrame:
    """The CRITICAL failure feed."""
    return quality_log.filter((F.col("severity") == "CRITICAL") & ~F.col("passed"))
