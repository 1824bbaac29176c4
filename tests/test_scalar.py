import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from demandloom.functions.scalar import (
    clamp_non_negative,
    finite_or_zero,
    flag,
    floored_days,
    month_label,
    month_start,
    normalize_category,
    parse_number,
    parse_timestamp,
    ratio,
)
from demandloom.functions.tables import fill_numeric_nulls, keep_first, with_defaults, zero_unusable


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    row = tuple(v for _, v in values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize(
    "later, earlier, days",
    [
        ("2017-01-02 00:00:00", "2017-01-01 22:00:00", 0),  # over midnight, two hours
        ("2017-01-01 22:00:00", "2017-01-01 23:00:00", -1),  # one hour too early
        ("2017-01-11 10:00:00", "2017-01-01 10:00:00", 10),
        ("2017-01-11 09:59:59", "2017-01-01 10:00:00", 9),
        ("2017-01-01 10:00:00", "2017-01-11 10:00:00", -10),
        ("2017-01-01 10:00:00", "2017-01-11 10:00:01", -11),
        ("2017-01-01 00:00:00", "2017-01-01 00:00:00", 0),
    ],
)
def test_days_are_floored(spark, kind, later, earlier, days):
    a = dt.datetime.fromisoformat(later)
    b = dt.datetime.fromisoformat(earlier)
    assert one(spark, floored_days("a", "b"), a=(kind, a), b=(kind, b)) == days
    assert (a - b).days == days


def test_days_do_not_depend_on_daylight_saving(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        a = dt.datetime(2017, 10, 16, 0, 30)
        b = dt.datetime(2017, 10, 14, 0, 45)
        assert one(spark, floored_days("a", "b"), a=("timestamp_ntz", a), b=("timestamp_ntz", b)) == (a - b).days == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_days_of_missing_time(spark):
    b = dt.datetime(2017, 1, 1)
    assert one(spark, floored_days("a", "b"), a=("timestamp_ntz", None), b=("timestamp_ntz", b)) is None


def test_flag_of_unknown_is_zero(spark):
    assert one(spark, flag(F.col("d") > 0), d=("int", None)) == 0
    assert one(spark, flag(F.col("d") > 0), d=("int", 3)) == 1


def test_month(spark):
    t = dt.datetime(2017, 3, 31, 23, 59, 59)
    assert one(spark, month_label("t"), t=("timestamp_ntz", t)) == "2017-03"
    assert one(spark, month_start("m"), m=("string", "2017-03")) == dt.date(2017, 3, 1)


@pytest.mark.parametrize("text, value", [("12.5", 12.5), ("n/a", None), ("", None), (None, None), ("NaN", None), ("7", 7.0)])
def test_parse_number(spark, text, value):
    assert one(spark, parse_number("s"), s=("string", text)) == value


def test_parse_timestamp(spark):
    assert one(spark, parse_timestamp("s"), s=("string", "2018-02-03 04:05:06")) == dt.datetime(2018, 2, 3, 4, 5, 6)
    assert one(spark, parse_timestamp("s"), s=("string", "bad")) is None


def test_category(spark):
    assert one(spark, normalize_category("c"), c=("string", "Home Decor-X")) == "home_decor-x"
    assert one(spark, normalize_category("c", dashes=True), c=("string", "Home Decor-X")) == "home_decor_x"
    assert one(spark, normalize_category("c"), c=("string", None)) == "nan"


def test_ratio_by_zero_is_null(spark):
    assert one(spark, ratio("a", "b"), a=("double", 1.0), b=("double", 0.0)) is None
    assert one(spark, ratio("a", "b"), a=("long", 3), b=("long", 2)) == 1.5


@pytest.mark.parametrize("x, clean", [(math.nan, 0.0), (math.inf, 0.0), (-math.inf, 0.0), (None, 0.0), (-2.5, -2.5)])
def test_finite(spark, x, clean):
    assert one(spark, finite_or_zero("x"), x=("double", x)) == clean
    assert one(spark, clamp_non_negative("x"), x=("double", x)) == max(0.0, clean)


def test_zero_unusable(spark):
    df = spark.createDataFrame(
        [(1, math.inf, None, None), (2, math.nan, 3, "s"), (3, -math.inf, 4, None)], "x_id long, a double, b long, c string"
    )
    assert [tuple(r) for r in zero_unusable(df).orderBy("x_id").collect()] == [
        (1, 0.0, 0, None), (2, 0.0, 3, "s"), (3, 0.0, 4, None),
    ]


def test_fill_leaves_text(spark):
    df = spark.createDataFrame([(None, None)], "a double, s string")
    assert tuple(fill_numeric_nulls(df).first()) == (0.0, None)


def test_defaults_do_not_replace(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert with_defaults(df, {"a": 9, "b": 2.0}).first().asDict() == {"a": 1, "b": 2.0}


def test_keep_first_orders_by_the_given_columns(spark):
    df = spark.createDataFrame([(1, 5, "z"), (1, 4, "y"), (2, 9, "x"), (None, 1, "n"), (None, 0, "m")], "k int, o int, v string")
    rows = keep_first(df, ["k"], ["o"]).collect()
    assert sorted(((r["k"] or 0), r["v"]) for r in rows) == [(0, "m"), (1, "y"), (2, "x")]
    assert keep_first(df, ["k"], ["o"]).columns == df.columns
