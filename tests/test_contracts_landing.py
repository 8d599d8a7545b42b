import os

import pytest
from pyspark.sql import types as T

from tierlake.sources import contracts as C
from tierlake.sources.landing import header_groups, list_files, read_landing
from tierlake.sources.specs import CUSTOMERS_CONTRACT, SALES_CONTRACT, load_contract


def test_missing_required_column_breaks():
    cols = [c for c in SALES_CONTRACT["properties"] if c != "quantity"]
    with pytest.raises(C.SchemaBreak, match="quantity"):
        C.describe_drift(cols, SALES_CONTRACT, "sales")


def test_new_and_missing_optional_columns_only_warn():
    cols = [c for c in SALES_CONTRACT["properties"] if c != "store_id"] + ["coupon_code"]
    msgs = C.describe_drift(cols, SALES_CONTRACT, "sales")
    assert any("added" in m and "coupon_code" in m for m in msgs)
    assert any("omitted" in m and "store_id" in m for m in msgs)
    assert C.describe_drift(list(SALES_CONTRACT["properties"]), SALES_CONTRACT, "sales") == []


def test_contract_schema_types_follow_header_order():
    s = C.contract_schema(SALES_CONTRACT, ["quantity", "transaction_date", "extra", "unit_price"])
    assert [f.name for f in s.fields] == ["quantity", "transaction_date", "extra", "unit_price"]
    assert [type(f.dataType) for f in s.fields] == [T.LongType, T.TimestampType, T.StringType, T.DoubleType]


def test_conform_adds_typed_null_columns(spark):
    df = spark.createDataFrame([("CUST-1", "a@b.cd")], "customer_id string, email string")
    out = C.conform_to_contract(df, CUSTOMERS_CONTRACT)
    assert set(CUSTOMERS_CONTRACT["properties"]) <= set(out.columns)
    assert dict(out.dtypes)["loyalty_points"] == "bigint"
    assert out.first()["loyalty_points"] is None


def test_value_rules_and_split(spark):
    rows = [("CUST-1", "a@b.cd", "Gold", 5), ("C-2", "bad", "Diamond", -1), ("CUST-3", None, None, None)]
    df = spark.createDataFrame(rows, "customer_id string, email string, loyalty_tier string, loyalty_points long")
    v = {r.rule: r.violations for r in C.contract_violations(df, CUSTOMERS_CONTRACT).collect()}
    assert v["pattern:customer_id"] == 1 and v["format:email"] == 1 and v["enum:loyalty_tier"] == 1
    assert v["minimum:loyalty_points"] == 1 and v["required:email"] == 1
    valid, bad = C.split_by_contract(df, CUSTOMERS_CONTRACT)
    assert [r.customer_id for r in valid.collect()] == ["CUST-1"]
    assert {r.customer_id for r in bad.collect()} == {"C-2", "CUST-3"}


def test_load_contract_from_text_and_file(tmp_root):
    p = os.path.join(tmp_root, "c.json")
    with open(p, "w") as fh:
        fh.write('{"required": ["a"], "properties": {"a": {"type": "integer"}}}')
    assert load_contract(p)["required"] == ["a"]
    assert load_contract('{"properties": {}}') == {"properties": {}}


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_csv_files_with_different_headers_are_read_by_name(spark, tmp_root):
    land = os.path.join(tmp_root, "sales")
    _write(os.path.join(land, "sales_20240101.csv"),
           "transaction_id,order_id,quantity,unit_price\nTXN-1,ORD-1,2,9.99\n")
    # a later file drops a middle column and adds one at the end
    _write(os.path.join(land, "sales_20240102.csv"),
           "transaction_id,quantity,unit_price,coupon\nTXN-2,3,1.50,X\n")
    files = list_files(spark, land)
    assert len(files) == 2 and len(header_groups(spark, files)) == 2
    contract = {"properties": {"transaction_id": {"type": "string"}, "order_id": {"type": "string"},
                               "quantity": {"type": "integer"}, "unit_price": {"type": "number"}}}
    df = read_landing(spark, land, "csv", contract)
    rows = {r.transaction_id: r for r in df.collect()}
    assert rows["TXN-2"].quantity == 3 and rows["TXN-2"].unit_price == 1.5
    assert rows["TXN-2"].order_id is None and rows["TXN-2"].coupon == "X"
    assert rows["TXN-1"].order_id == "ORD-1" and rows["TXN-1"].coupon is None
    assert rows["TXN-1"]._source_file.endswith("sales_20240101.csv")
    # a single Spark read of the folder would parse file 2 with file 1's header
    plain = spark.read.option("header", "true").csv(land).collect()
    assert any(r.order_id == "3" for r in plain)


def test_inferred_types_without_contract(spark, tmp_root):
    land = os.path.join(tmp_root, "stores")
    _write(os.path.join(land, "s.csv"), "store_id,open_date,area_sqm\nSTR-1,2020-01-15,120\n")
    df = read_landing(spark, land, "csv")
    assert dict(df.dtypes)["open_date"] == "date" and dict(df.dtypes)["area_sqm"] == "int"


def test_unsupported_format(spark, tmp_root):
    with pytest.raises(ValueError, match="Unsupported"):
        read_landing(spark, tmp_root, "xml")
