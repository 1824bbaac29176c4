"""Series features against their definitions, worked out row by row."""

import datetime as dt
import math
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandloom.config import DEFAULT_CONFIG
from demandloom.functions import series as fs
from demandloom.operators import category, series
from demandloom.operators.calendar import with_date

rng = np.random.default_rng(7)


def months(n, start="2015-01", gaps=()):
    labels = [str(p) for p in pd.period_range(start, periods=n + len(gaps), freq="M")]
    return [m for i, m in enumerate(labels) if i not in gaps]


def frame(name, demand, labels=None):
    n = len(demand)
    return pd.DataFrame(
        {
            "order_month": labels or months(n),
            "product_category_name": name,
            "demand": np.asarray(demand, dtype="int64"),
            "total_sales": np.round(rng.uniform(0, 900, n), 2),
            "avg_price": np.round(rng.uniform(5, 90, n), 2),
            "avg_review_score": np.round(rng.uniform(1, 5, n), 3),
            "avg_delivery_time_days": np.round(rng.uniform(1, 30, n), 3),
        }
    )


GROUPS = [
    frame("single", [4]),
    frame("two", [4, 9]),
    frame("five", [3, 1, 4, 1, 5]),
    frame("twelve", rng.integers(1, 50, 12)),
    frame("thirteen", rng.integers(1, 50, 13)),
    frame("long", rng.integers(1, 500, 200)),
    frame("constant", [6] * 14),
    frame("gap", [2, 3, 5, 8], months(4, gaps=(2, 3))),
]


def by_definition(rows):
    """Every column of one category's rows, worked out row by row from slices of plain lists."""
    demand, sales, price = rows["demand"], rows["total_sales"], rows["avg_price"]
    n = len(demand)

    def at(values, i):
        return values[i] if 0 <= i < n else None

    def before(values, i, width):
        return values[max(0, i - width) : i]

    def whole(values, i, width):
        part = before(values, i, width)
        return part if len(part) == width else None

    def some(part, function, least=1):
        return function(part) if part is not None and len(part) >= least else None

    def change(values, i, months):
        return None if at(values, i - months) is None else values[i] - values[i - months]

    def rate(values, i, months):
        return None if at(values, i - months) is None else values[i] / values[i - months] - 1

    def spread_over_centre(part):
        return None if part is None else statistics.stdev(part) / (statistics.fmean(part) + 1e-8)

    def weighted(values, i, alpha):
        weights = [(1 - alpha) ** (i - 1 - k) for k in range(i)]
        return math.fsum(w * x for w, x in zip(weights, values)) / math.fsum(weights) if i else None

    def skew(part):
        if part is None:
            return None
        size, centre = len(part), statistics.fmean(part)
        second = sum((x - centre) ** 2 for x in part) / size
        third = sum((x - centre) ** 3 for x in part) / size
        return 0.0 if second == 0 else third / second**1.5 * math.sqrt(size * (size - 1)) / (size - 2)

    def quantile(part, share):
        if part is None:
            return None
        ordered, place = sorted(part), share * (len(part) - 1)
        low = math.floor(place)
        high = min(low + 1, len(part) - 1)
        return ordered[low] + (place - low) * (ordered[high] - ordered[low])

    columns = {}
    for i in range(n):
        row = {"demand_next_month": at(demand, i + 1)}
        for name, c in series.LAGGED.items():
            for months in DEFAULT_CONFIG.lags:
                row[f"{name}_lag_{months}"] = at(rows[c], i - months)
        for name, c in series.AVERAGED.items():
            for width in DEFAULT_CONFIG.moving_windows:
                row[f"{name}_{width}"] = some(before(rows[c], i, width), statistics.fmean)
        for alpha in DEFAULT_CONFIG.ema_alphas:
            row[f"ema_{alpha}".replace(".", "_")] = weighted(demand, i, alpha)
        for width in DEFAULT_CONFIG.stat_windows:
            row[f"demand_std_{width}"] = some(before(demand, i, width), statistics.stdev, 2)
            row[f"price_std_{width}"] = some(before(price, i, width), statistics.stdev, 2)
            row[f"demand_min_{width}"] = some(before(demand, i, width), min)
            row[f"demand_max_{width}"] = some(before(demand, i, width), max)
        for months in (1, 3, 12):
            row[f"demand_growth_{months}m"] = rate(demand, i, months)
        row["price_growth_1m"] = rate(price, i, 1)
        row["demand_momentum_3m"], row["sales_momentum_3m"] = change(demand, i, 3), change(sales, i, 3)
        row["demand_momentum_12m"] = row["seasonal_difference_12m"] = change(demand, i, 12)
        yearly = rate(demand, i, 12)
        row["seasonal_ratio_12m"] = None if yearly is None else yearly + 1
        row["demand_volatility_6m"] = spread_over_centre(whole(demand, i, 6))
        row["price_volatility_6m"] = spread_over_centre(whole(price, i, 6))
        now, then = rate(demand, i, 1), rate(demand, i - 1, 1) if i else None
        row["demand_acceleration"] = None if now is None or then is None else now - then
        three = change(demand, i, 3)
        row["demand_trend_3m"] = None if three is None else three / 3
        row["yoy_demand_growth"], row["yoy_price_growth"] = yearly, rate(price, i, 12)
        row["cumulative_demand_year"] = sum(demand[max(0, i - 11) : i + 1])
        row["cumulative_sales_year"] = math.fsum(sales[max(0, i - 11) : i + 1])
        year = whole(demand, i, 12)
        row["demand_skew_12m"], row["demand_cv_12m"] = skew(year), spread_over_centre(year)
        low, high = quantile(year, 0.25), quantile(year, 0.75)
        row["demand_percentile_25_12m"], row["demand_percentile_75_12m"] = low, high
        row["demand_iqr_12m"] = None if year is None else high - low
        for name, value in row.items():
            columns.setdefault(name, []).append(math.nan if value is None else float(value))
    return columns


@pytest.fixture(scope="module")
def computed(spark):
    rows = pd.concat(GROUPS).sample(frac=1, random_state=3)  # the input order must not matter
    df = with_date(spark.createDataFrame(rows))
    df = series.statistical_features(series.yearly_features(series.series_features(df)))
    return df.toPandas()


@pytest.mark.parametrize("group", GROUPS, ids=lambda g: g["product_category_name"].iloc[0])
def test_series_features(computed, group):
    name = group["product_category_name"].iloc[0]
    got = computed[computed["product_category_name"] == name].sort_values("order_month")
    want = by_definition({c: group.sort_values("order_month")[c].tolist() for c in group.columns})
    for c, values in want.items():
        np.testing.assert_allclose(
            got[c].astype(float), values, rtol=1e-9, atol=1e-9, equal_nan=True, err_msg=f"{name} {c}"
        )


def exponential(spark, values, alpha):
    rows = [("c", dt.date(1900 + i // 12, i % 12 + 1, 1), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "product_category_name string, date date, demand double")
    return [r["e"] for r in df.withColumn("e", fs.exponential_mean("demand", alpha)).orderBy("date").collect()]


LONG = [float(v) for v in np.random.default_rng(3).integers(1, 90, 500)]


@pytest.mark.parametrize("values", [LONG, [1e20, *[1.0] * 130], [10.0, None, 20.0, 5.0, None, None, 7.0], [None, None, 3.0]])
@pytest.mark.parametrize("alpha", [0.05, 0.3, 0.7])
def test_exponential_mean_of_long_uneven_and_missing_values(spark, values, alpha):
    want = pd.Series(values, dtype=float).ewm(alpha=alpha).mean().shift(1)
    np.testing.assert_allclose(np.array(exponential(spark, values, alpha), dtype=float), want, rtol=1e-9, equal_nan=True)


def test_exponential_mean_with_full_weight_is_the_row_before(spark):
    assert exponential(spark, [4.0, None, 6.0, 1.0], 1.0) == [None, 4.0, None, 6.0]


def test_zero_previous_sales_gives_null_growth(spark):
    rows = [("2017-01", "c", 1, 0.0, 1.0, 1.0, 1.0), ("2017-02", "c", 2, 10.0, 1.0, 1.0, 1.0)]
    columns = ["order_month", "product_category_name", "demand", *list(series.LAGGED.values())[1:]]
    df = with_date(spark.createDataFrame(rows, columns)).withColumns(series.growth_rates())
    last = df.orderBy("order_month").collect()[1]
    assert last["sales_growth_1m"] is None
    assert last["demand_growth_1m"] == 1.0


def test_lags_are_row_offsets(computed):
    gap = computed[computed["product_category_name"] == "gap"].sort_values("order_month")
    assert list(gap["order_month"]) == ["2015-01", "2015-02", "2015-05", "2015-06"]
    assert list(gap["demand_lag_1"])[1:] == [2, 3, 5]


def test_constant_series_has_no_skew_or_variation(computed):
    last = computed[computed["product_category_name"] == "constant"].sort_values("order_month").iloc[-1]
    assert last["demand_skew_12m"] == 0 and last["demand_cv_12m"] == 0


def test_category_statistics(spark):
    df = spark.createDataFrame(pd.concat(GROUPS))
    rows = {r["product_category_name"]: r for r in category.category_stats(df).collect()}
    five = GROUPS[2]
    assert rows["five"]["category_median_demand"] == five["demand"].median()
    assert math.isclose(rows["five"]["category_std_demand"], five["demand"].std())
    assert rows["single"]["category_std_demand"] is None
    scored = category.category_features(df).filter("product_category_name = 'constant'")
    assert scored.filter(F.abs("demand_z_score") > 1e-9).count() == 0
