import datetime as dt
import os

from pyspark.sql import functions as F

from tierlake.operators.changes import snapshot_changes
from tierlake.operators.dedupe import dedupe_latest
from tierlake.operators.joins import left_join_dim
from tierlake.operators.upsert import rows_to_insert, upsert_insert_only
from tierlake.sources.lineage import add_lineage
from tierlake.streaming import ingest as S
from tierlake.streaming.scd2_stream import BUCKET, read_versioned, start_scd2_stream
from tierlake.operators.scd2 import scd2_from_feed


def test_dedupe_latest_is_total_and_repeatable(spark):
    rows = [(1, dt.datetime(2024, 1, 1), "a"), (1, dt.datetime(2024, 1, 2), "b"),
            (1, dt.datetime(2024, 1, 2), "c"), (2, None, "z"), (None, None, "n1"), (None, None, "n2")]
    df = spark.createDataFrame(rows, "k int, ts timestamp, v string")
    out = {r.k: r.v for r in dedupe_latest(df, ["k"], ["ts"]).collect()}
    assert out == {1: "c", 2: "z", None: "n2"}


def test_left_join_dim_null_and_missing_keys(spark):
    fact = spark.createDataFrame([(1, 10.0), (None, 5.0), (3, 1.0), (None, 2.0)], "k int, amount double")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    out = sorted(((r.k, r.amount, r.name) for r in left_join_dim(fact, dim, "k").collect()), key=str)
    assert out == sorted([(1, 10.0, "one"), (None, 5.0, None), (3, 1.0, None), (None, 2.0, None)], key=str)
    assert left_join_dim(fact, dim, "k").columns == ["k", "amount", "name"]


def test_insert_only_upsert(spark):
    target = spark.createDataFrame([(1, "f1", "a"), (2, "f1", "b")], "id int, _source_file string, v string")
    incoming = spark.createDataFrame([(1, "f1", "a"), (1, "f2", "a2"), (3, "f2", "c"), (3, "f2", "c")],
                                     "id int, _source_file string, v string")
    new = rows_to_insert(target, incoming, ["id", "_source_file"], F.col("_source_file").isin(["f1", "f2"]))
    assert sorted((r.id, r._source_file) for r in new.collect()) == [(1, "f2"), (3, "f2")]
    after = upsert_insert_only(target, incoming, ["id", "_source_file"])
    again = upsert_insert_only(after, incoming, ["id", "_source_file"])
    assert after.count() == again.count() == 4


def test_snapshot_changes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (4, "d")], "id int, v string")
    out = sorted((r.id, r.change_type, r.v) for r in snapshot_changes(old, new, ["id"]).collect())
    assert out == [(2, "update", "B"), (3, "update", "c"), (4, "insert", "d")]
    gone = snapshot_changes(new, old, ["id"]).filter("change_type = 'delete'").collect()
    assert [(r.id, r.v) for r in gone] == [(4, "d")]


def test_lineage_columns_from_file(spark, tmp_root):
    p = os.path.join(tmp_root, "x")
    spark.createDataFrame([(1,)], "a int").write.parquet(p)
    out = add_lineage(spark.read.parquet(p), "src", "b1", dt.datetime(2024, 5, 6, 7, 8)).first()
    assert out._source == "src" and out._batch_id == "b1" and ".parquet" in out._source_file
    assert out.ingestion_date == dt.date(2024, 5, 6)
    fixed = add_lineage(spark.read.parquet(p), "src", "b1", dt.datetime(2024, 5, 6), source_file="landing/x").first()
    assert fixed._source_file == "landing/x"


EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double"


def _events(spark, n=400):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(minutes=(i * 37) % 997), i % 7 if i % 3 else 0, "abc"[(i * 5) % 3], float(i))
            for i in range(n)]
    return spark.createDataFrame(rows, EVENTS)


def _land(df, path):
    df.repartition(5, "value").write.option("header", "true") \
        .option("timestampFormat", S.TIMESTAMP_FORMAT).csv(path)


def test_stream_ingest_exactly_once(spark, tmp_root):
    src = _events(spark)
    _land(src, f"{tmp_root}/landing")
    for _ in range(2):
        s = S.landing_stream(spark, f"{tmp_root}/landing", src.schema, max_files_per_trigger=2)
        s = S.with_expectations(S.with_stream_lineage(s, "events"), {"positive": "value > 0"}, "warn")
        S.start_file_sink(s, f"{tmp_root}/bronze", f"{tmp_root}/ckpt").awaitTermination()
    out = spark.read.parquet(f"{tmp_root}/bronze")
    assert out.count() == 400
    assert out.select("event_id", "ts", "user_id", "event_type", "value").exceptAll(src).count() == 0


def test_stream_scd2_equals_batch(spark, tmp_root):
    src = _events(spark)
    _land(src, f"{tmp_root}/landing")
    stream = S.landing_stream(spark, f"{tmp_root}/landing", src.schema, max_files_per_trigger=2)
    start_scd2_stream(stream, f"{tmp_root}/feed", f"{tmp_root}/versions", f"{tmp_root}/ckpt",
                      ["user_id"], ["ts", "event_id"], ["event_type"], buckets=4).awaitTermination()
    got = read_versioned(spark, f"{tmp_root}/versions").drop(BUCKET)
    want = scd2_from_feed(src, ["user_id"], ["ts", "event_id"], ["event_type"])
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_stream_bronze_batches_have_batch_ids(spark, tmp_root):
    src = _events(spark)
    _land(src, f"{tmp_root}/landing")
    for _ in range(2):
        s = S.with_stream_lineage(
            S.landing_stream(spark, f"{tmp_root}/landing", src.schema, max_files_per_trigger=2), "events")
        S.start_bronze_batches(s, f"{tmp_root}/bronze", f"{tmp_root}/ckpt").awaitTermination()
    out = spark.read.parquet(f"{tmp_root}/bronze")
    assert out.count() == 400
    assert out.select("_batch_id").distinct().count() == 3   # 5 files, 2 per trigger
    assert out.filter(F.col("_source_file").endswith(".csv")).count() == 400


def test_upsert_keeps_distinct_null_key_rows_and_stays_idempotent(spark):
    schema = "id int, _source_file string, v string"
    incoming = spark.createDataFrame(
        [(None, "f1", "bad1"), (None, "f1", "bad2"), (None, "f1", "bad2"), (1, "f1", "a")], schema)
    first = rows_to_insert(None, incoming, ["id", "_source_file"])
    assert sorted((r.id or 0, r.v) for r in first.collect()) == [(0, "bad1"), (0, "bad2"), (1, "a")]
    # the same file delivered again adds nothing, NULL-key rows included
    again = rows_to_insert(first, incoming, ["id", "_source_file"])
    assert again.count() == 0
    assert first.columns == incoming.columns
