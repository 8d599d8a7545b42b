"""Schema contracts: drift detection, read schema and value rules.

* ``describe_drift``: missing required column -> ``SchemaBreak``; a new column
  or a missing optional one -> a drift message (additive drift only warns).
* ``contract_schema``: the contract's declared types as a ``StructType`` in
  the order of a file's header, so files are parsed with their own header.
* ``value_rules``: every declared value rule (pattern, format, enum, minimum,
  maximum, required, type) as a boolean Column that is TRUE for a valid value;
  counted in one aggregate or used to split valid rows from a quarantine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.cleansing import EMAIL_PATTERN
from tierlake.sources.specs import Contract

_JSON_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "number": T.DoubleType(),
    "boolean": T.BooleanType(),
}
_FORMAT_TYPES: dict[str, T.DataType] = {"date": T.DateType(), "date-time": T.TimestampType()}


# Column of the landing readers: array of (column, raw) for text that did not convert.
RESCUED = "_rescued"


class SchemaBreak(RuntimeError):
    """A breaking schema change: a required column is missing."""


def _types(prop: dict) -> list[str]:
    t = prop.get("type", "string")
    return list(t) if isinstance(t, list) else [t]


def nullable(prop: dict) -> bool:
    return "null" in _types(prop)


def field_type(prop: dict) -> T.DataType:
    base = next((t for t in _types(prop) if t != "null"), "string")
    if base == "string" and prop.get("format") in _FORMAT_TYPES:
        return _FORMAT_TYPES[prop["format"]]
    return _JSON_TYPES.get(base, T.StringType())


def contract_schema(contract: Contract, columns: Sequence[str] | None = None) -> T.StructType:
    """Read schema; ``columns`` (a file header) fixes order, unknown ones are strings."""
    props = contract.get("properties", {})
    names = list(columns) if columns is not None else list(props)
    return T.StructType([
        T.StructField(c, field_type(props[c]) if c in props else T.StringType(), True) for c in names
    ])


def drift_rows(header: Sequence[str], contract: Contract) -> list[tuple[str, str]]:
    """(column, kind) for every column on which a header and its contract differ.

    Kinds: ``absent`` (required, not delivered), ``omitted`` (optional, not
    delivered), ``added`` (delivered, not declared).
    """
    needed = frozenset(contract.get("required", []))
    known = {**dict.fromkeys(contract.get("properties", {}), "omitted"), **dict.fromkeys(needed, "absent")}
    found = [(c, "added") for c in header if c not in known]
    found += [(c, kind) for c, kind in known.items() if c not in header]
    return sorted(found)


def describe_drift(header: Sequence[str], contract: Contract, where: str) -> list[str]:
    """One line per kind of tolerated drift; an absent column raises ``SchemaBreak``.

    ``where`` names the source or file whose header it is, so one bad file among
    good ones is found when called per header group.
    """
    by_kind: dict[str, list[str]] = {}
    for column, kind in drift_rows(header, contract):
        by_kind.setdefault(kind, []).append(column)
    if "absent" in by_kind:
        raise SchemaBreak(f"{where}: required columns absent: {', '.join(by_kind['absent'])}")
    return [f"{where}: columns {kind}: {', '.join(columns)}" for kind, columns in sorted(by_kind.items())]


def conform_to_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Add every declared column that is missing as a typed NULL (stable layout)."""
    props = contract.get("properties", {})
    out = df
    for c, prop in props.items():
        if c not in df.columns:
            out = out.withColumn(c, F.lit(None).cast(field_type(prop)))
    return out


def _typed(c: str, dtype: T.DataType, prop: dict) -> Column:
    """The value as the contract's type (NULL when it cannot be converted)."""
    if dtype == field_type(prop):
        return F.col(c)
    return typed_text(c, prop)


def typed_text(c: str | Column, prop: dict) -> Column:
    """The text of column ``c`` as the declared type (NULL when it cannot be converted)."""
    want, text = field_type(prop), F.col(c) if isinstance(c, str) else c
    if isinstance(want, T.TimestampType):
        return F.try_to_timestamp(text.cast("string"))
    if isinstance(want, T.DateType):
        return F.try_to_date(text.cast("string"))
    return text.try_cast(want)


def value_rules(df: DataFrame, contract: Contract) -> dict[str, Column]:
    """Rule name -> Column TRUE for a valid row, for the columns present in ``df``."""
    props = contract.get("properties", {})
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    rules: dict[str, Column] = {}

    def lost(c: str) -> Column:
        """The value was there, but its text did not convert: a broken type, not a missing value."""
        if RESCUED not in dtypes:
            return F.lit(False)
        return F.coalesce(F.exists(RESCUED, lambda x: x["column"] == c), F.lit(False))

    for c in contract.get("required", []):
        if c in dtypes:
            rules[f"required:{c}"] = F.col(c).isNotNull() | lost(c)
    for c, prop in props.items():
        if c not in dtypes:
            continue
        v = F.col(c)
        typed = _typed(c, dtypes[c], prop)
        if not isinstance(dtypes[c], type(field_type(prop))):
            rules[f"type:{c}"] = v.isNull() | typed.isNotNull()
        elif RESCUED in dtypes and not isinstance(dtypes[c], T.StringType):
            rules[f"type:{c}"] = ~lost(c)
        if not nullable(prop) and c not in contract.get("required", []):
            rules[f"not_null:{c}"] = v.isNotNull() | lost(c)
        if "pattern" in prop:
            rules[f"pattern:{c}"] = v.isNull() | v.cast("string").rlike(prop["pattern"])
        fmt = prop.get("format")
        if fmt == "email":
            rules[f"format:{c}"] = v.isNull() | v.rlike(EMAIL_PATTERN)
        elif fmt in _FORMAT_TYPES:
            rules[f"format:{c}"] = v.isNull() | typed.isNotNull()
        if "enum" in prop:
            allowed = [x for x in prop["enum"] if x is not None]
            rules[f"enum:{c}"] = v.isNull() | v.isin(allowed)
        if "minimum" in prop:
            rules[f"minimum:{c}"] = v.isNull() | (typed >= F.lit(prop["minimum"]))
        if "maximum" in prop:
            rules[f"maximum:{c}"] = v.isNull() | (typed <= F.lit(prop["maximum"]))
    # a value that is NULL because the rule could not be evaluated is a violation
    return {k: F.coalesce(r, F.lit(False)) for k, r in rules.items()}


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """(rule, violations) for every value rule, all counted in one aggregate."""
    rules = value_rules(df, contract)
    agg = df.agg(*[F.count_if(~r).alias(f"_v{i}") for i, r in enumerate(rules.values())])
    rows = [F.struct(F.lit(name).alias("rule"), F.col(f"_v{i}").alias("violations"))
            for i, name in enumerate(rules)]
    return agg.select(F.inline(F.array(*rows)))


def split_by_contract(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with the names of the broken rules)."""
    rules = value_rules(df, contract)
    broken = F.filter(F.array(*[F.when(~r, F.lit(n)) for n, r in rules.items()]), lambda x: x.isNotNull())
    flagged = df.withColumn("_broken_rules", broken)
    bad = F.size("_broken_rules") > 0
    return flagged.filter(~bad).drop("_broken_rules"), flagged.filter(bad)
