"""Bitmaps, point-in-time lookup, change-driven roll-ups and de-duplication in a stream."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from tierlake.operators import bitmaps as B
from tierlake.operators.point_in_time import lookup_valid
from tierlake.plans.incremental import refresh_rollup, touched_groups
from tierlake.streaming import ingest as S

T0 = dt.datetime(2024, 1, 1)


def test_bitmaps_merge_to_exact_counts(spark):
    rng = random.Random(1)
    rows = [(d, rng.choice("ab"), rng.choice([None, *range(0, 70_000, 7)])) for d in range(6) for _ in range(400)]
    df = spark.createDataFrame(rows, "d int, k string, c long").repartition(5)
    numbers = B.number_values(df, "c")
    seen = sorted((r.value, r._number) for r in numbers.collect())
    assert [n for _, n in seen] == list(range(len(seen))) and [v for v, _ in seen] == sorted({c for *_, c in rows if c is not None})
    daily = B.value_bitmaps(df, ["d", "k"], "c", numbers)
    got = {r.k: r.n for r in B.count_bitmaps(daily, ["k"], "n").collect()}
    assert got == {k: len({c for _, j, c in rows if j == k and c is not None}) for k in "ab"}
    none = df.where("false")
    assert B.count_bitmaps(B.value_bitmaps(none, ["k"], "c", B.number_values(none, "c")), ["k"], "n").count() == 0


def test_point_in_time_equals_brute_force(spark):
    rng = random.Random(2)
    versions, facts = [], []
    for k in range(6):
        cuts = sorted(rng.sample(range(0, 1000), rng.randint(1, 9)))
        for i, a in enumerate(cuts):
            versions.append((k, T0 + dt.timedelta(hours=a), T0 + dt.timedelta(hours=cuts[i + 1]) if i + 1 < len(cuts) else None, f"{k}.{i}"))
    for i in range(900):
        k = rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 9, None])   # one hot key, one without versions
        facts.append((i, k, rng.choice([v[1] for v in versions]) if i % 9 == 0 else T0 + dt.timedelta(hours=rng.uniform(-50, 1100)) if i % 50 else None))
    got = {r.i: r.v for r in lookup_valid(
        spark.createDataFrame(facts, "i int, k int, at timestamp").repartition(4),
        spark.createDataFrame(versions, "k int, a timestamp, b timestamp, v string"), "k", "at", "a", "b", ["v"], buckets=7).collect()}
    want = {i: next((v for kk, a, b, v in versions if kk == k and at is not None and a <= at and (b is None or at < b)), None)
            for i, k, at in facts}
    assert got == want
    empty = spark.createDataFrame([], "i int, k int, at timestamp")
    assert lookup_valid(empty, spark.createDataFrame(versions, "k int, a timestamp, b timestamp, v string"),
                        "k", "at", "a", "b", ["v"]).columns == ["i", "k", "at", "v"]


def test_only_touched_groups_are_recomputed(spark):
    old = [(i, "abc"[i % 3] if i % 7 else None, i % 5) for i in range(60)]
    new = [(i, g, c) for i, g, c in old if i != 4] + [(100, "z", 1)]
    new = [(i, "b" if i == 6 else g, c) for i, g, c in new]   # row 6 moves from a to b
    frame = lambda rows: spark.createDataFrame(rows, "id int, g string, c int")
    count = lambda df: df.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c").alias("d"))
    touched = touched_groups(frame(old), frame(new), "id", ["g"])
    assert {r.g for r in touched.collect()} == {"a", "b", "z"}
    marked = count(frame(old)).withColumn("d", F.when(F.col("g") == "c", F.lit(-1)).otherwise(F.col("d")).cast("long"))
    got = {r.g: (r.n, r.d) for r in refresh_rollup(marked, frame(new), touched, ["g"], count).collect()}
    want = {r.g: (r.n, r.d) for r in count(frame(new)).collect()}
    want["c"] = (want["c"][0], -1)   # carried over, not computed
    assert got == want and None in got


def test_rows_delivered_again_appear_once_across_batches(spark, tmp_root):
    land = os.path.join(tmp_root, "in")
    os.makedirs(land)
    rows = [(i, T0 + dt.timedelta(minutes=i)) for i in range(40)]
    for n, part in enumerate((rows[:20], rows[10:30], rows[:40])):
        with open(os.path.join(land, f"{n}.csv"), "w") as fh:
            fh.write("id,ts\n" + "".join(f"{i},{t.isoformat()}.000000\n" for i, t in part))
    schema = spark.createDataFrame([], "id long, ts timestamp").schema
    once = S.drop_redelivered(S.landing_stream(spark, land, schema, max_files_per_trigger=1), ["id"], "ts", "1 day")
    S.start_file_sink(once, f"{tmp_root}/out", f"{tmp_root}/cp", partition_by=()).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_root}/out").collect()) == list(range(40))


def test_unused_dimensions_are_not_joined(spark):
    from tierlake import catalog
    plan = catalog.QUERIES["kpi_clv"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "supplier" not in plan and "part.parquet" not in plan and plan.count("Join ") == 1   # lines with their orders


def test_rule_states_merge_to_the_direct_result(spark, tmp_root):
    from tierlake.operators import expectations as X
    from tierlake.operators.rule_states import evaluate_new, results_of, rule_state
    rows = [(i % 40 if i % 9 else None, i % 7 - 1, "ab"[i % 2]) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, c string")
    chk = (X.Expectations("t").expect_no_nulls("a").expect_unique("a").expect_column_min("b", 0)
           .expect_row_count_min(1000).expect_values_in_set("c", ["a"]))
    want = {r.rule_name: r.failed_count for r in chk.results(df).collect()}
    assert {r.rule_name: r.failed_count for r in results_of(rule_state(df, chk.rules), chk.rules).collect()} == want
    parts = {str(k): df.where(f"coalesce(a, 0) % 3 = {k}") for k in range(3)}
    evaluate_new(spark, tmp_root + "/s", {"0": parts["0"]}, chk.rules)
    parts["0"] = df.where("raise_error('read again') IS NULL")   # a stored state is not evaluated again
    got = {r.rule_name: r.failed_count for r in evaluate_new(spark, tmp_root + "/s", parts, chk.rules).collect()}
    assert got == want
    none = results_of(rule_state(df.where("false"), chk.rules), chk.rules).collect()
    assert {r.rule_name: r.failed_count for r in none}["row_count_min:1000"] == 1000


def test_a_stream_remembers_its_schemas(spark, tmp_root):
    import pytest
    from tierlake.sources.specs import SourceSpec
    from tierlake.streaming.drifting import SchemaLog, read_drifting, start_drifting_stream
    contract = {"required": ["id"], "properties": {"id": {"type": "string"}, "n": {"type": ["integer", "null"]}}}
    spec = SourceSpec("s", "s", "csv", "id", (), contract)
    land, out, log = (os.path.join(tmp_root, x) for x in ("in", "out", "schemas"))
    os.makedirs(land)

    def deliver(name, text):
        with open(os.path.join(land, name), "w") as fh:
            fh.write(text)
        start_drifting_stream(spark, land, spec, out, log, f"{tmp_root}/cp").awaitTermination()

    deliver("a.csv", "id,n\nx,1\n")
    deliver("b.csv", "extra,id\nmore,y\n")        # an optional column gone, another one new
    deliver("c.csv", "id,n,extra\nz,7q,\n")
    rows = {r.id: (r.n, r.extra, r._rescued) for r in read_drifting(spark, out, log).collect()}
    assert rows["x"] == (1, None, None) and rows["y"][:2] == (None, "more")
    assert rows["z"][0] is None and tuple(rows["z"][2][0]) == ("n", "7q")
    known = {r.version: r.ddl for r in SchemaLog(spark, log).versions().collect()}
    assert sorted(known) == [1, 2] and "extra" not in known[1] and "extra" in known[2]
    with pytest.raises(Exception, match="absent: id"):
        deliver("d.csv", "n\n5\n")
    assert read_drifting(spark, out, log).count() == 3


def test_a_late_event_repairs_its_own_key_only(spark, tmp_root):
    from tierlake.operators.scd2 import scd2_from_feed
    from tierlake.streaming.scd2_stream import BUCKET, read_versioned, scd2_batch_writer
    rng = random.Random(6)
    rows = [(i, rng.choice([0, 0, 0, 1, 2, 3]), rng.randrange(10_000), rng.choice("abc")) for i in range(300)]
    schema = "id int, k int, t int, v string"
    feed, table = f"{tmp_root}/feed", f"{tmp_root}/table"
    write = scd2_batch_writer(feed, table, ["k"], ["t", "id"], ["v"], buckets=4)
    frame = lambda part: spark.createDataFrame(part, schema)
    want = sorted((tuple(r) for r in scd2_from_feed(frame(rows), ["k"], ["t", "id"], ["v"]).collect()), key=str)
    for b in range(4):
        write(frame(rows[b * 70:(b + 1) * 70]), b)
    write(frame([r for r in rows[280:] if r[1] == 1]), 4)      # one key only
    assert {r.k for r in spark.read.parquet(f"{table}/batch={4:012d}").collect()} == {1}
    write(frame([r for r in rows[280:] if r[1] != 1]), 5)
    write(frame([r for r in rows[280:] if r[1] != 1]), 5)      # replayed
    got = read_versioned(spark, table).drop(BUCKET).select("id", "k", "t", "v", "scd_effective_from", "scd_effective_to", "scd_is_current")
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert spark.read.parquet(f"{table}/batch={4:012d}").count() < sum(1 for w in want if w[1] == 1)   # the tail, not all
