"""Landing reads that lose nothing, and the ledger of ingested files."""

import datetime as dt
import os

import pytest

from tests.retail_fixture import write_landing
from tierlake.plans import layers as L
from tierlake.sources import contracts as C, landing
from tierlake.sources.ledger import FileLedger

AS_OF = dt.datetime(2024, 1, 3, 6, 0)
CONTRACT = {"required": ["id", "n"], "properties": {
    "id": {"type": "string"}, "n": {"type": "integer", "minimum": 0}, "price": {"type": "number"},
    "at": {"type": ["string", "null"], "format": "date-time"}, "ok": {"type": ["boolean", "null"]}}}


def put(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_csv_keeps_text_that_does_not_convert(spark, tmp_root):
    put(tmp_root, "a b/x+1%.csv", "\n﻿id,n,price,at,ok\na,1,2.5,2024-01-01 08:00:00,true\nb,12x,9.9.9,soon,maybe\nc,,,,\n")
    put(tmp_root, "y.csv", "id,n,extra\nd,7,more\ne,8,more,and more\n")
    rows = {r.id: r for r in landing.read_landing(spark, tmp_root, "csv", CONTRACT).collect()}
    assert rows["a"].n == 1 and rows["a"].price == 2.5 and rows["a"].at == dt.datetime(2024, 1, 1, 8) and rows["a"]._rescued is None
    assert rows["b"].n is None and rows["b"].price is None
    assert {(x["column"], x["raw"]) for x in rows["b"]._rescued} == {("n", "12x"), ("price", "9.9.9"), ("at", "soon"), ("ok", "maybe")}
    assert rows["c"]._rescued is None and rows["d"].extra == "more"
    assert [tuple(x) for x in rows["e"]._rescued] == [("_line", "e,8,more,and more")]


def test_spoilt_text_is_a_broken_type_not_a_missing_value(spark, tmp_root):
    put(tmp_root, "x.csv", "id,n,price\na,1,2\nb,12x,\nc,,x\n")
    df = landing.read_landing(spark, tmp_root, "csv", CONTRACT)
    found = {r.rule: r.violations for r in C.contract_violations(df, CONTRACT).collect()}
    assert found["type:n"] == 1 and found["required:n"] == 1 and found["type:price"] == 1 and found["not_null:price"] == 1


def test_json_columns_are_found_per_file(spark, tmp_root):
    put(tmp_root, "a.json", '{"id":"a","n":1,"price":2.50,"o`dd n\\"ame":{"k":[1,2]}}\n{bad\n\n[1]\n{"id":"b","n":"12x","ok":true}\n')
    put(tmp_root, "b.json", '{"id":"c","n":3}\n')
    df, drift = landing.read_files(spark, landing.list_files(spark, tmp_root), "json", CONTRACT, "src")
    rows = {r.id: r for r in df.collect()}
    assert rows["a"].n == 1 and rows["a"].price == 2.5 and rows["a"]['o`dd n"ame'] == '{"k":[1,2]}'
    assert rows["b"].n is None and [tuple(x) for x in rows["b"]._rescued] == [("n", "12x")] and rows["b"].ok is True
    lines = [r._rescued[0]["raw"] for r in df.where("id IS NULL").collect()]
    assert sorted(lines) == ["[1]", "{bad"] and rows["c"]._source_file.endswith("b.json")
    assert any("added" in d and "o`dd" in d for d in drift) and any("omitted" in d for d in drift)
    put(tmp_root, "c.json", '{"id":"d"}\n')   # one file without a required column
    with pytest.raises(C.SchemaBreak, match="n"):
        landing.read_files(spark, landing.list_files(spark, tmp_root), "json", CONTRACT, "src")


def test_no_file_is_opened_by_the_driver(spark, tmp_root, monkeypatch):
    for i in range(3):
        put(tmp_root, f"f{i}.csv", f"id,n{',z' if i == 2 else ''}\na,{i}{',0' if i == 2 else ''}\n")
    jobs = []
    monkeypatch.setattr(landing, "first_lines", lambda s, f, real=landing.first_lines: jobs.append(len(f)) or real(s, f))
    groups = landing.header_groups(spark, landing.list_files(spark, tmp_root))
    assert jobs == [3] and {h: len(f) for h, f in groups.items()} == {("id", "n"): 2, ("id", "n", "z"): 1}
    scan = landing.landing_files(spark, tmp_root)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in scan   # a listing reads no content
    assert landing.landing_files(spark, tmp_root + "/none").count() == 0


def ctx(spark, landing_root, lake, run):
    return L.RunContext(spark, landing_root, lake, run_id=run, as_of=AS_OF)


def test_an_unchanged_folder_is_not_opened(spark, tmp_root, monkeypatch):
    land, lake = write_landing(os.path.join(tmp_root, "landing")), os.path.join(tmp_root, "lake")
    sales = L.SOURCES["sales"]
    assert L.ingest_source(ctx(spark, land, lake, "r1"), sales)["rows_written"] == 5
    opened = []
    monkeypatch.setattr(L, "read_files", lambda s, f, *a, real=landing.read_files: opened.extend(f) or real(s, f, *a))
    monkeypatch.setattr(L.tables, "read_appended", lambda *a: pytest.fail("the target was read"))
    again = L.ingest_source(ctx(spark, land, lake, "r2"), sales)
    assert (again["rows_read"], again["rows_written"], opened) == (0, 0, [])
    write_landing(land, with_day2=True)   # rewrites day 1 with another time of change: it counts as delivered again
    os.utime(os.path.join(land, "sales", "sales_20240101.csv"), (1, 1))
    monkeypatch.undo()
    monkeypatch.setattr(L, "read_files", lambda s, f, *a, real=landing.read_files: opened.extend(f) or real(s, f, *a))
    rec = L.ingest_source(ctx(spark, land, lake, "r3"), sales)
    assert len(opened) == 2 and (rec["rows_read"], rec["rows_written"]) == (6, 1)


def test_an_interrupted_run_is_mended_without_copies(spark, tmp_root, monkeypatch):
    land, lake = write_landing(os.path.join(tmp_root, "landing")), os.path.join(tmp_root, "lake")
    sales = L.SOURCES["sales"]
    real = FileLedger.note

    def dies(self, files, run, state):
        if state == "done":
            raise OSError("lost")
        real(self, files, run, state)
    monkeypatch.setattr(FileLedger, "note", dies)
    with pytest.raises(RuntimeError, match="lost"):
        L.ingest_source(ctx(spark, land, lake, "r1"), sales)
    monkeypatch.setattr(FileLedger, "note", real)
    assert L.bronze_table(ctx(spark, land, lake, "r1"), "sales").count() == 5
    rec = L.ingest_source(ctx(spark, land, lake, "r2"), sales)
    assert (rec["rows_read"], rec["rows_written"]) == (5, 0)
    assert L.ingest_source(ctx(spark, land, lake, "r3"), sales)["rows_read"] == 0
