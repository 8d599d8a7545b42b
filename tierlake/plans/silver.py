"""Silver layer: cleansed dimensions and the sales fact.

Every builder is ``DataFrame -> DataFrame`` over Bronze-shaped input (the
landing columns, optionally with lineage columns). Load stamps come from an
explicit ``as_of`` so a re-run produces the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions import measures as M
from tierlake.functions.calendar import (
    CALENDAR_COLUMNS, DEFAULT_CALENDAR_END, DEFAULT_CALENDAR_START, calendar_attributes,
)
from tierlake.functions.cleansing import (
    DEFAULT_LOYALTY_TIER, blank_to_null, conform, valid_email,
)
from tierlake.operators.dedupe import dedupe_latest, dedupe_stored

# Lineage columns used as the "latest" order when present (DEC5).
LATEST_ORDER = ("_ingested_at", "_source_file", "_batch_id")

# Column lists of the Silver tables.
STORE_COLUMNS = (
    "store_id", "store_name", "store_type", "city", "state",
    "region", "country", "open_date", "area_sqm", "num_employees", "is_active",
)
CUSTOMER_COLUMNS = (
    "customer_id", "first_name", "last_name", "email",
    "date_of_birth", "gender", "loyalty_tier", "loyalty_points",
    "registration_date", "city", "state", "country", "marketing_opt_in",
)
PRODUCT_COLUMNS = (
    "product_id", "product_name", "category", "subcategory",
    "brand", "sku", "unit_cost", "unit_price", "weight_kg",
    "is_perishable", "is_active", "launch_date", "supplier_id",
)
INVENTORY_COLUMNS = (
    "inventory_id", "store_id", "product_id",
    "quantity_on_hand", "quantity_reserved", "quantity_on_order",
    "reorder_point", "reorder_quantity", "last_restock_date", "last_updated",
)
SALES_COLUMNS = (
    "transaction_id", "order_id", "transaction_date",
    "store_id", "customer_id", "product_id",
    "quantity", "unit_price", "discount_pct", "payment_method", "channel",
)
FACT_COLUMNS = SALES_COLUMNS[:3] + ("date_id",) + SALES_COLUMNS[3:] + (
    "gross_amount", "discount_amount", "net_amount",
)

# Tracked columns of the two versioned dimensions.
CUSTOMER_TRACKED = ("loyalty_tier", "loyalty_points", "email", "city", "state")
PRODUCT_TRACKED = ("unit_price", "unit_cost", "is_active", "category", "subcategory")


def _stamp(df: DataFrame, name: str, as_of: dt.datetime | None) -> DataFrame:
    if as_of is None:
        return df
    return df.withColumn(name, F.lit(as_of).cast(T.TimestampType()))


def _latest(df: DataFrame, key: str, columns: tuple[str, ...], stored: bool = False) -> DataFrame:
    """Project ``columns`` and keep the latest row per key (P1 + P8); for ``stored`` see ``dedupe_stored``."""
    order = [c for c in LATEST_ORDER if c in df.columns]
    present = [c for c in columns if c in df.columns]
    rows = df.select(*present, *order)
    kept = dedupe_stored(rows, key, order) if stored else dedupe_latest(rows, [key], order)
    return kept.select(*present)


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def build_dim_date(spark: SparkSession, start: str | Column = DEFAULT_CALENDAR_START,
                   end: str | Column = DEFAULT_CALENDAR_END) -> DataFrame:
    """One row per day in [start, end]."""
    s = F.to_date(F.lit(start)) if isinstance(start, str) else F.to_date(start)
    e = F.to_date(F.lit(end)) if isinstance(end, str) else F.to_date(end)
    days = spark.range(1).select(F.explode(F.sequence(s, e)).alias("date"))
    attrs = calendar_attributes(F.col("date"))
    return days.select("date", *[attrs[c].alias(c) for c in CALENDAR_COLUMNS])


def build_dim_date_spanning(dates: DataFrame, column: str) -> DataFrame:
    """Calendar covering the min..max of a date column, computed in Spark.

    The span is a one-row aggregate (partial per partition), the day list is
    bounded by the number of days in the span, not by the data volume.
    """
    span = dates.agg(F.min(F.to_date(column)).alias("s"), F.max(F.to_date(column)).alias("e"))
    days = span.select(F.explode(F.sequence("s", "e")).alias("date"))
    attrs = calendar_attributes(F.col("date"))
    return days.select("date", *[attrs[c].alias(c) for c in CALENDAR_COLUMNS])


def build_dim_store(stores: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    out = _latest(stores, "store_id", STORE_COLUMNS)
    return _stamp(out, "_silver_loaded_at", as_of)


def build_dim_customer(customers: DataFrame) -> DataFrame:
    """Cleansed customers (SCD2 applied separately): bad e-mail -> NULL,
    missing tier -> default tier, points -> long with 0 default."""
    out = _latest(customers, "customer_id", CUSTOMER_COLUMNS)
    return (
        out.withColumn("email", valid_email("email"))
        .withColumn("loyalty_tier", F.coalesce(F.col("loyalty_tier"), F.lit(DEFAULT_LOYALTY_TIER)))
        .withColumn("loyalty_points",
                    F.coalesce(F.col("loyalty_points").try_cast(T.LongType()), F.lit(0).cast(T.LongType())))
    )


def build_dim_product(products: DataFrame) -> DataFrame:
    """Cleansed products with catalogue margin (SCD2 applied separately)."""
    out = _latest(products, "product_id", PRODUCT_COLUMNS)
    return (
        out.withColumn("unit_cost", M.to_money("unit_cost"))
        .withColumn("unit_price", M.to_money("unit_price"))
        .withColumn("margin_pct", M.margin_pct("unit_price", "unit_cost"))
    )


def build_dim_inventory(inventory: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Inventory rows with stock status; snapshots accumulate (no de-dup)."""
    present = [c for c in INVENTORY_COLUMNS if c in inventory.columns]
    out = (
        inventory.select(*present)
        .withColumn("stock_status", M.stock_status())
        .withColumn("available_qty", M.available_qty())
    )
    return _stamp(out, "_silver_loaded_at", as_of)


def build_fact_sales(sales: DataFrame, as_of: dt.datetime | None = None, stored: bool = False,
                     by_date: bool = False) -> DataFrame:
    """Cleansed sales lines with exact money measures, one row per transaction.

    ``stored`` sales are read twice instead of shuffled whole (see ``dedupe_stored``).
    ``by_date`` rows lie by ``date_id``, ready to be written into such folders; they are
    dealt before the measures are added, as these are wide.
    """
    latest = _latest(sales, "transaction_id", SALES_COLUMNS, stored)
    types = _types(latest)
    typed = latest.select(
        F.col("transaction_id"),
        F.col("order_id"),
        conform("transaction_date", types["transaction_date"], T.TimestampType()).alias("transaction_date"),
        blank_to_null("store_id", types["store_id"]).alias("store_id"),
        blank_to_null("customer_id", types["customer_id"]).alias("customer_id"),
        F.col("product_id"),
        conform("quantity", types["quantity"], T.IntegerType()).alias("quantity"),
        conform("unit_price", types["unit_price"], M.PRICE).alias("unit_price"),
        F.coalesce(conform("discount_pct", types["discount_pct"], M.RATE),
                   F.lit(0).cast(M.RATE)).alias("discount_pct"),
        F.col("payment_method"),
        F.col("channel"),
    )
    dated = typed.withColumn("date_id", M.date_id("transaction_date"))
    fact = (
        (dated.hint("rebalance", "date_id") if by_date else dated)
        .withColumn("gross_amount", M.gross_amount())
        .withColumn("discount_amount", M.discount_amount())
        .withColumn("net_amount", M.net_amount())
        .select(*FACT_COLUMNS)
    )
    return _stamp(fact, "_silver_loaded_at", as_of)
