"""Rule sets per layer and table (E14-E16), kept as data.

Each entry: (kind, column-or-count, argument, severity). ``build_checker``
turns a set into an ``Expectations`` builder.
"""

from __future__ import annotations

from tierlake.operators.expectations import CRITICAL, WARNING, Expectations

# Enumerations checked by the rules.
CHANNELS = ("in_store", "online", "mobile")
PAYMENT_METHODS = ("credit_card", "debit_card", "cash", "pix", "voucher")
TIERS = ("Bronze", "Silver", "Gold", "Platinum")

# The rule sets of every layer.
RULE_SETS: dict[str, tuple[str, tuple]] = {
    "bronze.sales": ("bronze", (
        ("no_nulls", "transaction_id", None, CRITICAL),
        ("no_nulls", "product_id", None, CRITICAL),
        ("no_nulls", "quantity", None, CRITICAL),
        ("no_nulls", "unit_price", None, CRITICAL),
        ("unique", "transaction_id", None, CRITICAL),
        ("min", "quantity", 1, CRITICAL),
        ("min", "unit_price", 0, CRITICAL),
        ("min", "discount_pct", 0, CRITICAL),
        ("max", "discount_pct", 100, CRITICAL),
        ("in_set", "channel", CHANNELS, CRITICAL),
        ("in_set", "payment_method", PAYMENT_METHODS, CRITICAL),
        ("row_count_min", 1, None, CRITICAL),
    )),
    "bronze.customers": ("bronze", (
        ("no_nulls", "customer_id", None, CRITICAL),
        ("no_nulls", "email", None, CRITICAL),
        ("unique", "customer_id", None, CRITICAL),
        ("in_set", "loyalty_tier", TIERS, WARNING),
        ("min", "loyalty_points", 0, WARNING),
        ("row_count_min", 1, None, CRITICAL),
    )),
    "bronze.products": ("bronze", (
        ("no_nulls", "product_id", None, CRITICAL),
        ("no_nulls", "product_name", None, CRITICAL),
        ("no_nulls", "unit_price", None, CRITICAL),
        ("unique", "product_id", None, CRITICAL),
        ("unique", "sku", None, CRITICAL),
        ("min", "unit_price", 0, CRITICAL),
        ("min", "unit_cost", 0, CRITICAL),
        ("row_count_min", 1, None, CRITICAL),
    )),
    "bronze.stores": ("bronze", (
        ("no_nulls", "store_id", None, CRITICAL),
        ("no_nulls", "store_name", None, CRITICAL),
        ("unique", "store_id", None, CRITICAL),
        ("row_count_min", 1, None, CRITICAL),
    )),
    "bronze.inventory": ("bronze", (
        ("no_nulls", "inventory_id", None, CRITICAL),
        ("no_nulls", "store_id", None, CRITICAL),
        ("no_nulls", "product_id", None, CRITICAL),
        ("min", "quantity_on_hand", 0, CRITICAL),
        ("row_count_min", 1, None, CRITICAL),
    )),
    "silver.fact_sales": ("silver", (
        ("no_nulls", "transaction_id", None, CRITICAL),
        ("no_nulls", "product_id", None, CRITICAL),
        ("no_nulls", "date_id", None, CRITICAL),
        ("unique", "transaction_id", None, CRITICAL),
        ("min", "quantity", 1, CRITICAL),
        ("min", "net_amount", 0, CRITICAL),
        ("min", "gross_amount", 0, CRITICAL),
        ("min", "discount_pct", 0, CRITICAL),
        ("max", "discount_pct", 100, CRITICAL),
        ("row_count_min", 1, None, CRITICAL),
    )),
    "silver.dim_customer": ("silver", (
        ("no_nulls", "customer_id", None, CRITICAL),
        ("no_nulls", "scd_effective_from", None, CRITICAL),
        ("no_nulls", "scd_effective_to", None, CRITICAL),
        ("no_nulls", "scd_is_current", None, CRITICAL),
        ("in_set", "loyalty_tier", TIERS, CRITICAL),
        ("min", "loyalty_points", 0, CRITICAL),
        ("row_count_min", 1, None, CRITICAL),
    )),
    "silver.dim_product": ("silver", (
        ("no_nulls", "product_id", None, CRITICAL),
        ("no_nulls", "product_name", None, CRITICAL),
        ("min", "unit_price", 0, CRITICAL),
        ("min", "unit_cost", 0, CRITICAL),
        ("row_count_min", 1, None, CRITICAL),
    )),
    "silver.dim_store": ("silver", (
        ("no_nulls", "store_id", None, CRITICAL),
        ("unique", "store_id", None, CRITICAL),
        ("row_count_min", 1, None, CRITICAL),
    )),
    "gold.obt_sales": ("gold", (
        ("no_nulls", "transaction_id", None, CRITICAL),
        ("no_nulls", "product_id", None, CRITICAL),
        ("no_nulls", "product_category", None, CRITICAL),
        ("unique", "transaction_id", None, CRITICAL),
        ("min", "net_amount", 0, CRITICAL),
        ("min", "quantity", 1, CRITICAL),
        ("row_count_min", 1, None, CRITICAL),
    )),
    "gold.agg_daily_sales": ("gold", (
        ("no_nulls", "year", None, CRITICAL),
        ("no_nulls", "month", None, CRITICAL),
        ("min", "total_net_revenue", 0, CRITICAL),
        ("min", "num_transactions", 1, CRITICAL),
        ("row_count_min", 1, None, CRITICAL),
    )),
}


def build_checker(name: str, run_id: str = "") -> Expectations:
    layer, rules = RULE_SETS[name]
    chk = Expectations(name, layer=layer, run_id=run_id)
    for kind, col, arg, sev in rules:
        if kind == "no_nulls":
            chk.expect_no_nulls(col, sev)
        elif kind == "unique":
            chk.expect_unique(col, sev)
        elif kind == "min":
            chk.expect_column_min(col, arg, sev)
        elif kind == "max":
            chk.expect_column_max(col, arg, sev)
        elif kind == "in_set":
            chk.expect_values_in_set(col, arg, sev)
        elif kind == "row_count_min":
            chk.expect_row_count_min(col, sev)
        else:
            raise ValueError(kind)
    return chk


# Row policies of the declarative tables (policy, name, valid-row SQL).
ROW_POLICIES: dict[str, tuple[tuple[str, str, str], ...]] = {
    "bronze.sales": (("warn", "non_null_transaction_id", "transaction_id IS NOT NULL"),
                     ("warn", "positive_quantity", "quantity > 0")),
    "bronze.customers": (("warn", "non_null_customer_id", "customer_id IS NOT NULL"),),
    "bronze.products": (("warn", "non_null_product_id", "product_id IS NOT NULL"),),
    "bronze.stores": (("warn", "non_null_store_id", "store_id IS NOT NULL"),),
    "bronze.inventory": (("warn", "non_null_inventory_id", "inventory_id IS NOT NULL"),),
    "silver.dim_store": (("drop", "valid_store_id", "store_id IS NOT NULL"),),
    "silver.dim_customer": (("drop", "valid_customer_id", "customer_id IS NOT NULL"),),
    "silver.dim_product": (("drop", "valid_product_id", "product_id IS NOT NULL"),),
    "silver.dim_inventory": (("drop", "valid_inventory_id", "inventory_id IS NOT NULL"),),
    "silver.fact_sales": (("fail", "non_null_transaction_id", "transaction_id IS NOT NULL"),
                          ("drop", "non_negative_net_amount", "net_amount >= 0")),
    "gold.fact_sales": (("fail", "non_null_transaction_id", "transaction_id IS NOT NULL"),
                        ("fail", "non_negative_net_amount", "net_amount >= 0")),
}
