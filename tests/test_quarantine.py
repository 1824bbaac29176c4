"""Rejects of a scan, and types inferred from all rows."""

import datetime as dt

import pytest

from demandloom.schemas import struct_of
from demandloom.sources import quarantine

SCHEMA = struct_of("id long, price double, at timestamp_ntz, note string, absent integer")


@pytest.fixture
def path(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(
        "id,price,at,note,more\n"
        "1,2.5,2017-10-02 10:56:33,fine,x\n"
        "2,NaN,,,\n"
        "three,1e3,2017-13-02 10:56:33,\"a \"\"quoted\"\" one\",y\n"
        "4,cheap,yesterday,,z\n"
        "5,1.0,2017-10-02 10:56:33,\"cut off,in the middle\n"
        "6,7\n"
        "99999999999999999999,-.5,2017-10-02 00:00:00,ok,ok\n"
    )
    (tmp_path / "in" / "b.csv").write_text("id,price,at,note,more\n8,bad,2018-01-01 00:00:00,n,m\n")
    return str(tmp_path / "in")


def test_rows_and_rejects(spark, path):
    rows, rejects = quarantine.scan_with_rejects(spark, path, SCHEMA)
    assert rows.columns == ["id", "price", "at", "note", "more", "absent"]
    found = {r.id: r for r in rows.collect() if r.id}
    assert rows.count() == 6 and set(found) == {1, 2, 4, 8}
    assert found[1].at == dt.datetime(2017, 10, 2, 10, 56, 33) and found[1].more == "x"
    assert found[2].price is None and found[4].price is None and found[4].at is None
    assert sorted((r.file.rsplit("/", 1)[1], r.column_name or "", r.raw, r.reason) for r in rejects.collect()) == sorted([
        ("a.csv", "id", "three", "no bigint"),
        ("a.csv", "at", "2017-13-02 10:56:33", "no timestamp_ntz"),
        ("a.csv", "price", "cheap", "no double"),
        ("a.csv", "at", "yesterday", "no timestamp_ntz"),
        ("a.csv", "", '5,1.0,2017-10-02 10:56:33,"cut off,in the middle', "fields do not match the header"),
        ("a.csv", "", "6,7", "fields do not match the header"),
        ("a.csv", "id", "99999999999999999999", "no bigint"),
        ("b.csv", "price", "bad", "no double"),
    ])


def test_only_texts_and_no_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n")
    rows, rejects = quarantine.scan_with_rejects(spark, str(tmp_path / "t.csv"), struct_of("a string, b string"))
    assert rows.count() == 0 and rejects.count() == 0 and rows.columns == ["a", "b"]


def test_types(spark):
    columns = {
        "whole": ["1", "-20", "+3", None], "big": ["1", "99999999999999999999", "2", "3"], "real": ["1", "2.5", "1e-3", "NaN"],
        "day": ["2017-01-02", "2017-01-02 10:00:00", "2017-01-02 10:00:00.5", ""], "text": ["1", "2017-01-02", "x", "2.0"],
        "none": [None, "", " ", None], "mixed": ["1", "2.5", "2017-01-02", "3"], "spaces": [" 1", "2 ", "3", "4"],
    }
    rows = list(zip(*columns.values(), strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).withColumnRenamed("none", "no ne")
    found = {r.column_name: (r.inferred, r.n_values) for r in quarantine.infer_types(df).collect()}
    assert found == {
        "whole": ("bigint", 3), "big": ("double", 4), "real": ("double", 4), "day": ("timestamp", 3), "text": ("string", 4),
        "no ne": ("string", 0), "mixed": ("string", 4), "spaces": ("bigint", 4),
    }


def test_one_aggregation(spark):
    df = spark.range(10).selectExpr("cast(id as string) a", "cast(id as string) b")
    plan = quarantine.infer_types(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
