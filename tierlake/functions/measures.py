"""Derived sales and stock measures as Column expressions (JVM side, codegen).

Money is exact decimal with HALF_UP rounding: a double ``round(x, 2)`` gives
different cents in different engines for values such as 1.005.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)     # whole-cent prices of the derived tables
PERCENT = T.DecimalType(5, 2)
RATIO = T.DecimalType(12, 2)
# Inputs keep six decimals and are rounded to cents once, after multiplying.
# The widths add up to 38 digits, so no product loses a digit.
PRICE = T.DecimalType(18, 6)
RATE = T.DecimalType(10, 6)
AMOUNT = T.DecimalType(24, 2)

_C = Column | str


def _col(c: _C) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c: _C) -> Column:
    """Exact money value; a value that does not fit is NULL, not an error."""
    return _col(c).try_cast(MONEY)


def gross_amount(quantity: _C = "quantity", unit_price: _C = "unit_price") -> Column:
    return F.round(_col(quantity).cast(T.DecimalType(10, 0)) * _col(unit_price), 2).try_cast(AMOUNT)


def discount_amount(gross: _C = "gross_amount", discount_pct: _C = "discount_pct") -> Column:
    # x * pct * 0.01 keeps the product exact (no decimal division)
    return F.round(_col(gross) * _col(discount_pct) * F.lit(0.01).cast(T.DecimalType(2, 2)), 2).try_cast(AMOUNT)


def net_amount(gross: _C = "gross_amount", discount: _C = "discount_amount") -> Column:
    return F.round(_col(gross) - _col(discount), 2).try_cast(AMOUNT)


def margin_pct(unit_price: _C = "unit_price", unit_cost: _C = "unit_cost") -> Column:
    """Catalogue margin in percent, 2 decimals; NULL when the price is 0."""
    price = _col(unit_price).try_cast(PRICE)
    cost = _col(unit_cost).try_cast(PRICE)
    return F.round(F.try_divide((price - cost) * F.lit(100), price), 2).try_cast(RATIO)


def date_id(ts: _C) -> Column:
    """Integer yyyyMMdd of a date or timestamp, by arithmetic (no string formatting)."""
    d = F.to_date(_col(ts))
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


# Stock status labels.
OUT_OF_STOCK = "out_of_stock"
LOW_STOCK = "low_stock"
IN_STOCK = "in_stock"


def stock_status(on_hand: _C = "quantity_on_hand", reorder_point: _C = "reorder_point") -> Column:
    on_hand, reorder_point = _col(on_hand), _col(reorder_point)
    return (
        F.when(on_hand <= 0, F.lit(OUT_OF_STOCK))
        .when(on_hand <= reorder_point, F.lit(LOW_STOCK))
        .otherwise(F.lit(IN_STOCK))
    )


def available_qty(on_hand: _C = "quantity_on_hand", reserved: _C = "quantity_reserved") -> Column:
    return _col(on_hand) - _col(reserved)


def ratio_avg(total: _C, count: _C) -> Column:
    """Average as exact sum / count in double; NULL on an empty group."""
    return F.try_divide(_col(total).cast(T.DoubleType()), _col(count).cast(T.DoubleType()))
