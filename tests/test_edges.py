import datetime as dt
import os

import pytest

from tests.retail_fixture import write_landing
from tierlake.operators.scd2 import current_rows, scd2_initial, scd2_merge
from tierlake.plans import gold, layers as L
from tierlake.sources import contracts as C


def test_directory_source_file_mode(spark, tmp_root):
    """source_file="directory" reproduces a directory-wide _source_file (Q6):
    a later file with the same keys is then not inserted again."""
    landing = write_landing(os.path.join(tmp_root, "landing"))
    lake = os.path.join(tmp_root, "lake")
    ctx = L.RunContext(spark, landing, lake, run_id="r1", as_of=dt.datetime(2024, 1, 3), source_file="directory")
    L.ingest_source(ctx, L.SOURCES["sales"])
    write_landing(landing, with_day2=True)   # TXN-4 again, in a new file
    ctx2 = L.RunContext(spark, landing, lake, run_id="r2", as_of=dt.datetime(2024, 1, 4), source_file="directory")
    rec = L.ingest_source(ctx2, L.SOURCES["sales"])
    assert rec["rows_written"] == 0
    row = L.bronze_table(ctx2, "sales").first()
    assert row._source_file.rstrip("/").endswith("sales")


def test_invalid_grain(spark):
    df = spark.createDataFrame([], "transaction_date timestamp")
    with pytest.raises(ValueError, match="grain"):
        gold.at_grain("transaction_date", "week")


def test_merge_with_new_incoming_column(spark):
    first = scd2_initial(spark.createDataFrame([(1, "Gold")], "id int, tier string"), "2024-01-01")
    second = spark.createDataFrame([(1, "Gold", "x@y.z"), (2, "Silver", None)], "id int, tier string, email string")
    out = scd2_merge(first, second, "id", ["tier"], "2024-02-01")
    rows = sorted((r.id, r.tier, r.email, r.scd_is_current) for r in out.collect())
    # key 1 unchanged on the tracked column: its version stays (email of the old row: NULL)
    assert rows == [(1, "Gold", None, True), (2, "Silver", None, True)]
    assert current_rows(out).count() == 2


def test_type_rules_on_text_input(spark):
    contract = {"required": ["q"], "properties": {"q": {"type": "integer", "minimum": 1},
                                                  "d": {"type": "string", "format": "date"}}}
    df = spark.createDataFrame([("3", "2024-01-02"), ("x", "not a date"), ("0", None)], "q string, d string")
    v = {r.rule: r.violations for r in C.contract_violations(df, contract).collect()}
    assert v["type:q"] == 1 and v["minimum:q"] == 2 and v["format:d"] == 1 and v["type:d"] == 1


def test_bronze_accepts_an_added_column(spark, tmp_root):
    landing = write_landing(os.path.join(tmp_root, "landing"))
    lake = os.path.join(tmp_root, "lake")
    L.ingest_source(L.RunContext(spark, landing, lake, run_id="r1", as_of=dt.datetime(2024, 1, 3)),
                    L.SOURCES["sales"])
    with open(os.path.join(landing, "sales", "sales_20240105.csv"), "w") as fh:
        fh.write("transaction_id,order_id,transaction_date,store_id,customer_id,product_id,quantity,"
                 "unit_price,discount_pct,payment_method,channel,coupon\n"
                 "TXN-6,ORD-6,2024-01-05 09:00:00,STR-1,CUST-1,PRD-1,1,29.99,0,cash,in_store,WELCOME\n"
                 ",ORD-7,2024-01-05 09:05:00,STR-1,CUST-1,PRD-1,1,29.99,0,cash,in_store,\n")
    ctx2 = L.RunContext(spark, landing, lake, run_id="r2", as_of=dt.datetime(2024, 1, 5))
    rec = L.ingest_source(ctx2, L.SOURCES["sales"])
    assert rec["rows_written"] == 2 and any("coupon" in m for m in rec["drift_messages"])
    sales = L.bronze_table(ctx2, "sales")
    assert sales.count() == 7 and sales.filter("coupon = 'WELCOME'").count() == 1
    assert sales.filter("transaction_id IS NULL").count() == 1
    # the same files again: nothing new, the NULL-key row included
    again = L.ingest_source(L.RunContext(spark, landing, lake, run_id="r3", as_of=dt.datetime(2024, 1, 6)),
                            L.SOURCES["sales"])
    assert again["rows_written"] == 0


def test_stream_rejects_a_drifted_header(spark, tmp_root):
    """A streamed CSV whose header differs from the schema fails the stream
    instead of shifting values by position."""
    from pyspark.errors import StreamingQueryException
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from tierlake.streaming import ingest as S

    land = os.path.join(tmp_root, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "a.csv"), "w") as fh:
        fh.write("event_id,value\n1,2.5\n")
    with open(os.path.join(land, "b.csv"), "w") as fh:
        fh.write("value,event_id\n3.5,2\n")   # same columns, other order
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    s = S.landing_stream(spark, land, schema).withColumn("ingestion_date", F.current_date())
    q = S.start_file_sink(s, os.path.join(tmp_root, "out"), os.path.join(tmp_root, "ck"))
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()
