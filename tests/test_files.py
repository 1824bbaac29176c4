import datetime as dt
import os

import pytest

from demandloom.plans.features import build_features
from demandloom.schemas import SCHEMAS, struct_of
from demandloom.sources import files


@pytest.fixture
def base(tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)

    put(
        "orders.csv",
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
        "order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,2017-10-04 19:55:00,2017-10-10 21:25:13,2017-10-18 00:00:00\n"
        "o2,c2,delivered,2017-11-24 20:41:37,,2017-11-26 14:31:00,,2017-12-13 00:00:00\n"
        "o3,c3,canceled,not a time,,,,\n",
    )
    put("items.csv", "order_id,order_item_id,product_id,seller_id,price,freight_value\no1,1,p1,s1,29.99,8.72\no2,1,p1,s1,NaN,1\no2,2,p1,s2,118.7,22.76\n")
    put(
        "products.csv",
        "product_id,product_category_name,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
        "p1,Perfumaria Fina,225,16,x,14\np2,,1000,30,18,20\n",
    )
    put("payments.csv", "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,credit_card,8,99.33\n")
    return str(tmp_path)


def test_typed_scan(spark, base):
    df = files.scan_csv(spark, f"{base}/orders.csv", SCHEMAS["orders"])
    rows = {r["order_id"]: r for r in df.collect()}
    assert rows["o1"]["order_purchase_timestamp"] == dt.datetime(2017, 10, 2, 10, 56, 33)
    assert rows["o2"]["order_delivered_customer_date"] is None
    assert rows["o3"]["order_purchase_timestamp"] is None  # unreadable
    assert dict(df.dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    assert dict(df.dtypes)["order_approved_at"] == "string"  # a column the schema does not name


def test_quotes_and_lines_inside_a_text(spark, tmp_path):
    schema = struct_of("review_id string, order_id string, review_comment string, review_score string")
    rows = [
        ("r1", "o1", 'good, very ""nice""\nproduct', "5"), ("r2", "o2", '"', "4"), ("r3", "o3", 'a\\"b\n\n,', "3"),
        ("r4", "o4", None, "1"), ("r5", "o5", "plain", None),
    ]
    df = spark.createDataFrame(rows, schema)
    files.write_csv(df, str(tmp_path / "own"))
    assert sorted(map(tuple, files.scan_csv(spark, str(tmp_path / "own"), schema, multiline=True).collect())) == rows
    (tmp_path / "other.csv").write_text(
        'review_id,order_id,review_comment,review_score\nr1,o1,"good, very ""nice""\nproduct",5\nr2,o2,,4\n'
    )
    found = files.scan_csv(spark, str(tmp_path / "other.csv"), schema, multiline=True)
    assert [tuple(r) for r in found.collect()] == [("r1", "o1", 'good, very "nice"\nproduct', "5"), ("r2", "o2", None, "4")]


def test_headers_decide_not_places(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    one.mkdir(), two.mkdir()
    (one / "a.csv").write_text("order_id,freight_value,price,order_item_id,product_id,seller_id\no1,3,20,1,p,s\n")
    assert files.scan_csv(spark, str(one), SCHEMAS["items"]).select("price", "freight_value").first() == (20.0, 3.0)
    (two / "a.csv").write_text("order_id,price,freight_value\no1,20,3\n")
    (two / "b.csv").write_text("order_id,freight_value,price\no2,3,20\n")
    with pytest.raises(Exception, match="CSV header does not conform|does not conform"):
        files.scan_csv(spark, str(two), SCHEMAS["items"]).collect()


def test_absent_column_is_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,price\no1,20\n")
    found = files.scan_csv(spark, str(tmp_path / "a.csv"), SCHEMAS["items"])
    assert set(found.columns) == set(SCHEMAS["items"].names)
    assert found.select("order_id", "price", "freight_value", "order_item_id").first() == ("o1", 20.0, None, None)


def test_parquet_follows_the_schema_and_empty_folders_are_errors(spark, tmp_path):
    path = str(tmp_path / "items.parquet")
    spark.createDataFrame([(7, "12.5", 1)], "order_id long, price string, other int").write.parquet(path)
    found = files.scan_tolerant(spark, path, SCHEMAS["items"], "parquet")
    assert found.dtypes == files.scan_tolerant(spark, str(tmp_path / "none"), SCHEMAS["items"], "parquet").dtypes
    assert found.select("order_id", "price", "freight_value").first() == ("7", 12.5, None)
    (tmp_path / "failed.parquet").mkdir()
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        files.scan_tolerant(spark, str(tmp_path / "failed.parquet"), SCHEMAS["items"], "parquet")


def test_nan_price_is_missing(spark, base):
    df = files.scan_csv(spark, f"{base}/items.csv", SCHEMAS["items"])
    assert df.filter("price is null").count() == 1
    assert df.filter("price > 0").count() == 2


def test_missing_files_give_empty_tables_and_features(spark, base):
    sources = files.load_sources(spark, base, files={"orders": "orders.csv"})
    assert sources["reviews"].count() == 0
    assert sources["reviews"].columns == SCHEMAS["reviews"].names
    assert build_features(sources, drop_constants=False).count() == 1  # October, labelled with November
    with pytest.raises(ValueError, match="no orders"):
        build_features(files.load_sources(spark, f"{base}/nowhere"))


def test_feature_table_from_files_has_all_columns(spark, base):
    table = build_features(files.load_sources(spark, base), drop_constants=False)
    assert len(table.columns) == 174
    row = table.first()
    assert (row["order_month"], row["product_category_name"], row["demand"], row["demand_next_month"]) == (
        "2017-10", "perfumaria_fina", 1, 1,
    )
    assert row["avg_review_score"] == 0.0  # unreviewed orders count as 0


def test_tables_written_by_month(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.createDataFrame([("2017-01", "a", 1), ("2017-02", "b", 2)], "order_month string, c string, n long")
    files.write_table(df, path)
    assert sorted(p for p in os.listdir(path) if p.startswith("order_month")) == ["order_month=2017-01", "order_month=2017-02"]
    back = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "snapshots")
    with pytest.raises(FileNotFoundError):
        files.read_snapshot(spark, root)
    first = files.write_snapshot(spark.range(3), root)
    files.write_snapshot(files.read_snapshot(spark, root).union(spark.range(2)), root)
    assert files.read_snapshot(spark, root).count() == 5
    assert files.read_snapshot(spark, root, first).count() == 3
    assert files.snapshot_log(spark, root).count() == 2


def test_half_written_snapshot_is_not_read(spark, tmp_path):
    root = str(tmp_path / "snapshots")
    files.write_snapshot(spark.range(3), root)
    spark.range(9).write.parquet(f"{root}/data/version=99999999_000000_000000")  # no log entry
    assert files.read_snapshot(spark, root).count() == 3


def test_read_or_build(spark, tmp_path):
    path = str(tmp_path / "table")
    assert files.read_or_build(spark, path, lambda: spark.range(4)).count() == 4
    spark.range(2).write.parquet(path)
    assert files.read_or_build(spark, path, lambda: spark.range(4)).count() == 2


def test_two_writers_and_a_clock_that_runs_backwards(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "snapshots")
    names = iter(["20300101_c", "20200101_b", "20100101_a"])
    monkeypatch.setattr(files, "new_version", lambda: next(names))
    files.write_snapshot(spark.range(1), root)
    files.write_snapshot(spark.range(2), root)
    assert files.read_snapshot(spark, root).count() == 2  # the later entry, not the larger name
    # a writer that saw the log before the second entry was made must not hide or lose it
    monkeypatch.setattr(files, "_next_number", lambda spark, log: 1)
    files.write_snapshot(spark.range(3), root)
    entries = [(r.number, r.version) for r in files.snapshot_log(spark, root).orderBy("number").collect()]
    assert entries == [(0, "20300101_c"), (1, "20200101_b"), (2, "20100101_a")]
    assert files.read_snapshot(spark, root).count() == 3 and files.read_snapshot(spark, root, "20200101_b").count() == 2


def test_an_entry_that_is_not_complete_is_not_read(spark, tmp_path):
    root = str(tmp_path / "snapshots")
    files.write_snapshot(spark.range(3), root)
    (tmp_path / "snapshots" / "log" / f"{1:020d}.json").write_text('{"number": 1, "vers')
    assert files.read_snapshot(spark, root).count() == 3
    files.write_snapshot(spark.range(4), root)
    assert files.read_snapshot(spark, root).count() == 4
    assert [r.number for r in files.snapshot_log(spark, root).orderBy("number").collect()] == [0, 2]
