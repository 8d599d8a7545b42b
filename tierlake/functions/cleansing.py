"""Cleansing expressions for the Silver layer (all built-in Spark functions).

Data-dependent casts use ``try_cast``/``try_to_timestamp`` so that a bad value
becomes NULL (and is then counted by a rule) instead of failing the job under
ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# E-mail validity pattern, default loyalty tier and tiers.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
DEFAULT_LOYALTY_TIER = "Bronze"
LOYALTY_TIERS = ("Bronze", "Silver", "Gold", "Platinum")


def valid_email(c: str = "email") -> Column:
    """The address if it looks like one, else NULL."""
    return F.when(F.col(c).rlike(EMAIL_PATTERN), F.col(c))


def blank_to_null(c: str, dtype: T.DataType) -> Column:
    """Empty string -> NULL for string keys; other types pass unchanged."""
    if isinstance(dtype, T.StringType):
        return F.nullif(F.col(c), F.lit(""))
    return F.col(c)


def conform(c: str, dtype: T.DataType, target: T.DataType) -> Column:
    """Cast a raw column to its Silver type without failing on bad values."""
    if dtype == target:
        return F.col(c)
    if isinstance(target, T.TimestampType) and isinstance(dtype, T.StringType):
        return F.try_to_timestamp(F.col(c))
    return F.col(c).try_cast(target)


def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    """Space-joined name; a NULL part is skipped."""
    return F.concat_ws(" ", F.col(first), F.col(last))
