"""Calendar attributes of a date (dimension D2) as Column expressions.

The same expressions build ``dim_date`` and, in the wide table, replace the
join with the calendar: every attribute is a pure function of the date, so
the fact never shuffles for it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierlake.functions.measures import date_id

# Calendar bounds of the generated date dimension.
DEFAULT_CALENDAR_START = "2020-01-01"
DEFAULT_CALENDAR_END = "2030-12-31"

CALENDAR_COLUMNS = (
    "date_id", "year", "month", "day", "quarter", "week_of_year",
    "day_of_week", "day_name", "month_name", "is_weekend", "year_month",
)


def calendar_attributes(d: Column) -> dict[str, Column]:
    """All D2 attributes of date ``d``: ISO week, day_of_week 1 = Sunday."""
    dow = F.dayofweek(d)
    return {
        "date_id": date_id(d),
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "quarter": F.quarter(d),
        "week_of_year": F.weekofyear(d),
        "day_of_week": dow,
        "day_name": F.date_format(d, "EEEE"),
        "month_name": F.date_format(d, "MMMM"),
        "is_weekend": dow.isin(1, 7),
        "year_month": F.date_format(d, "yyyy-MM"),
    }


def within(d: Column, start: str | None, end: str | None) -> Column:
    """True when ``d`` lies in the calendar [start, end]; no bound = open."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (d >= F.to_date(F.lit(start)))
    if end is not None:
        cond = cond & (d <= F.to_date(F.lit(end)))
    return cond
