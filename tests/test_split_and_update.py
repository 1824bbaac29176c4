import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandloom.config import FeatureConfig
from demandloom.operators import metrics, naive, profile, split, update
from demandloom.operators.calendar import with_date


@pytest.fixture(scope="module")
def table(spark):
    rows = []
    for m in range(1, 13):
        for i, c in enumerate("abcde"):
            if (m + i) % 4 != 0 or m == 12:
                rows.append((f"2017-{m:02d}", c, m * 10 + i, float(m * 7 % 5 + i)))
    rows.append(("2017-12", "new", 1, 2.0))
    return with_date(spark.createDataFrame(rows, "order_month string, product_category_name string, demand long, demand_next_month double"))


def ordered(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("order", [("order_month", "product_category_name"), ("product_category_name", "date")])
def test_positions_follow_the_order(table, order):
    got = sorted((r["position"], *[r[c] for c in order]) for r in split.with_position(table, order).collect())
    assert [p for p, *_ in got] == list(range(table.count()))
    assert [k for _, *k in got] == sorted(k for _, *k in got)


def test_no_step_of_the_numbering_sees_all_rows(table):
    plan = split.with_position(table, ("product_category_name", "date"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan


def test_positional_split_sizes(table):
    sizes = {r["split"]: r["count"] for r in split.positional_split(table).groupBy("split").count().collect()}
    n = table.count()
    assert sizes == {"train": int(n * 0.8), "test": n - int(n * 0.8)}


def test_last_months(table):
    test = split.test_part(split.last_months_split(table))
    assert {r["order_month"] for r in test.collect()} == {"2017-10", "2017-11", "2017-12"}
    one = split.test_part(split.last_months_split(table, FeatureConfig(holdout_months=1)))
    assert {r["order_month"] for r in one.collect()} == {"2017-12"}


def test_naive_forecasts(table):
    parts = split.last_months_split(table)
    train, test = split.train_part(parts), split.test_part(parts)
    known = [tuple(r) for r in train.select("order_month", "product_category_name", "demand_next_month").collect()]
    mean = sum(v for *_, v in known) / len(known)
    last = {c: v for _, c, v in sorted(known)}
    final = max(known)[2]
    rows = naive.predict_all(test, train, {**naive.NAIVE_MODELS, **naive.FORECAST_MODELS}).collect()
    assert {r["product_category_name"] for r in rows} > {"new"}
    for r in rows:
        c = r["product_category_name"]
        assert r["naive_last_value"] == r["naive_global_last"] == final
        assert r["naive_historical_mean"] == pytest.approx(mean)
        assert r["naive_by_category"] == pytest.approx(last.get(c, mean))
        assert r["naive_category_last"] == last.get(c, final)


def test_metrics(spark):
    df = spark.createDataFrame(
        [("2017-01", "a", 2.0, 3.0, float("nan")), ("2017-01", "b", 4.0, 3.0, float("inf")), ("2017-01", "c", 6.0, 6.0, 1.0)],
        "order_month string, product_category_name string, demand_next_month double, x double, y double",
    )
    stacked = metrics.stack_predictions(df, ["x", "y"])
    got = {r["model"]: r for r in metrics.forecast_metrics(stacked, df).collect()}
    assert got["x"]["mae"] == pytest.approx(2 / 3)
    assert got["x"]["rmse"] == pytest.approx((2 / 3) ** 0.5)
    assert got["x"]["r2"] == pytest.approx(1 - 2 / 8)
    assert got["x"]["mape"] == pytest.approx(25.0)
    assert got["x"]["mase"] == pytest.approx(0.5)
    assert got["y"]["mae"] == pytest.approx(11 / 3)  # NaN and infinity count as 0
    assert metrics.best_model(metrics.model_metrics(stacked)).first()["model"] == "x"
    assert [tuple(r)[1:2] for r in metrics.top_errors(stacked, 1).collect()] == [("c",)]


def test_constant_target_has_zero_r2(spark):
    df = spark.createDataFrame(
        [("2017-01", "a", 2.0, 3.0), ("2017-01", "b", 2.0, 2.0)],
        "order_month string, product_category_name string, demand_next_month double, x double",
    )
    row = metrics.forecast_metrics(metrics.stack_predictions(df, ["x"]), df).first()
    assert row["r2"] == 0.0 and row["mase"] is None


def test_future_months(table):
    got = ordered(update.future_months(table, 2).filter("product_category_name = 'a'"), "order_month", "date")
    assert got == [("2018-01", dt.date(2018, 1, 1)), ("2018-02", dt.date(2018, 2, 1))]


def test_next_month_rows_copy_the_newest(table):
    new = update.next_month_rows(table)
    assert new.columns == table.columns
    newest = {c: d for m, c, d in ordered(table, "order_month", "product_category_name", "demand")}
    assert {r["product_category_name"]: r["demand"] for r in new.collect()} == newest
    both = update.append_months(table, new.drop("demand_next_month"))
    assert both.count() == table.count() + len(newest)
    assert both.filter(F.col("demand_next_month").isNull()).count() == len(newest)


def test_histogram_counts_every_value(table):
    bins = profile.histogram(table, "demand", 7)
    assert bins.count() == 7
    assert bins.agg(F.sum("n_rows")).first()[0] == table.count()
    assert bins.filter("bin = 7").first()["n_rows"] > 0  # the maximum belongs to the last bin


def test_histogram_of_one_value(spark):
    bins = profile.histogram(spark.createDataFrame([(3,), (3,)], "v int"), "v", 4).orderBy("bin").collect()
    assert [r["n_rows"] for r in bins] == [0, 0, 2, 0]
    assert bins[0]["bin_start"] == 2.5


def test_new_categories(table):
    parts = split.last_months_split(table)
    test, train = split.test_part(parts), split.train_part(parts)
    assert ordered(profile.new_categories(test, train), "product_category_name") == [("new",)]
    assert ordered(profile.new_categories_except(test, train), "product_category_name") == [("new",)]


def test_restore_category(spark):
    items = spark.createDataFrame([("p1",), ("p2",)], "product_id string")
    products = spark.createDataFrame([("p1", "x")], "product_id string, product_category_name string")
    assert ordered(profile.restore_category(items, products), "product_id")[0] == ("p1",)
    by_id = {r["product_id"]: r["product_category_name"] for r in profile.restore_category(items, products).collect()}
    assert by_id == {"p1": "x", "p2": None}
    unknown = profile.restore_category(items, products.drop("product_category_name"))
    assert {r["product_category_name"] for r in unknown.collect()} == {"unknown_category"}
