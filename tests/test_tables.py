import os

from tierlake.sources import tables


def test_incomplete_snapshot_is_ignored_and_replay_replaces(spark, tmp_root):
    root = os.path.join(tmp_root, "t")
    tables.write_snapshot(spark.createDataFrame([(1,)], "a int"), root, "20240101T000000-a")
    tables.write_snapshot(spark.createDataFrame([(2,), (3,)], "a int"), root, "20240102T000000-b")
    # a run that died while writing: folder without _SUCCESS
    spark.createDataFrame([(9,)], "a int").write.parquet(os.path.join(root, "snapshot=20240103T000000-c"))
    os.remove(os.path.join(root, "snapshot=20240103T000000-c", "_SUCCESS"))
    assert sorted(r.a for r in tables.read_snapshot(spark, root).collect()) == [2, 3]
    # replaying run b overwrites only its own snapshot
    tables.write_snapshot(spark.createDataFrame([(4,)], "a int"), root, "20240102T000000-b")
    assert [r.a for r in tables.read_snapshot(spark, root).collect()] == [4]
    assert len(tables.snapshots(spark, root)) == 2


def test_versions_table_parts(spark, tmp_root):
    root = os.path.join(tmp_root, "v")
    schema = "k int, v string, scd_is_current boolean"
    tables.write_versions_run(spark.createDataFrame([(1, "a", True), (2, "b", True)], schema), root, "r1")
    tables.write_versions_run(spark.createDataFrame([(1, "a", False), (1, "c", True), (2, "b", True)], schema),
                              root, "r2")
    # an unfinished third run is not visible
    spark.createDataFrame([(5, "x", True)], schema).write.partitionBy("scd_is_current") \
        .parquet(os.path.join(root, "run=r3"))
    os.remove(os.path.join(root, "run=r3", "_SUCCESS"))
    cur = sorted((r.k, r.v) for r in tables.read_current_versions(spark, root).collect())
    assert cur == [(1, "c"), (2, "b")]
    allv = sorted((r.k, r.v, r.scd_is_current) for r in tables.read_versions(spark, root).collect())
    assert allv == [(1, "a", False), (1, "c", True), (2, "b", True)]
    # the flag filter prunes the history parts out of the plan
    plan = tables.read_versions(spark, root).filter("scd_is_current")._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "scd_is_current=false" not in plan


def test_an_appended_table_is_read_by_its_kept_schema(spark, tmp_root):
    root = tmp_root + "/t"
    tables.append(spark.createDataFrame([(1, "a", "x")], "i int, s string, p string"), root, ["p"])
    tables.append(spark.createDataFrame([(2, 5.0, "y")], "i int, d double, p string"), root, ["p"])
    got = tables.read_appended(spark, root)
    assert {tuple(r[c] for c in ("i", "s", "d", "p")) for r in got.collect()} == {(1, "a", None, "x"), (2, None, 5.0, "y")}
    assert tables.known_schema(spark, root).names == ["i", "s", "p", "d"]
    old = tmp_root + "/old"   # written before schemas were kept
    spark.createDataFrame([(1, "a")], "i int, s string").write.parquet(old)
    tables.append(spark.createDataFrame([(2, 7)], "i int, n int"), old)
    assert {(r.i, r.s, r.n) for r in tables.read_appended(spark, old).collect()} == {(1, "a", None), (2, None, 7)}


def test_old_snapshots_expire(spark, tmp_root):
    root = tmp_root + "/s"
    for run in ("r1", "r2", "r3"):
        tables.write_snapshot(spark.range(3), root, run)
    gone = tables.expire_snapshots(spark, root, keep=2)
    assert [g.rsplit("=", 1)[1] for g in gone] == ["r1"] and len(tables.snapshots(spark, root)) == 2
    assert tables.read_snapshot(spark, root).count() == 3
