"""Time-series features per category, in month order.

Each family returns named column expressions, so that any set of families is
added in one projection and shares one window sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.config import DATE, DEFAULT_CONFIG, TARGET, FeatureConfig
from demandloom.functions.scalar import ratio
from demandloom.functions.series import (
    by_date,
    change,
    exponential_mean,
    full,
    growth,
    lag,
    previous,
    rolling_percentile,
    rolling_skew,
    variation,
)

Columns = dict[str, Column]

# Feature prefix of each measure of the monthly aggregate.
LAGGED = {
    "demand": "demand",
    "sales": "total_sales",
    "price": "avg_price",
    "review": "avg_review_score",
    "delivery": "avg_delivery_time_days",
}
AVERAGED = {
    "ma": "demand",
    "sales_ma": "total_sales",
    "price_ma": "avg_price",
    "review_ma": "avg_review_score",
}


def target(c: str = "demand") -> Columns:
    return {TARGET: F.lead(c, 1).over(by_date())}


def lags(cfg: FeatureConfig = DEFAULT_CONFIG) -> Columns:
    return {f"{name}_lag_{n}": lag(c, n) for name, c in LAGGED.items() for n in cfg.lags}


def moving_averages(cfg: FeatureConfig = DEFAULT_CONFIG) -> Columns:
    return {
        f"{name}_{w}": F.avg(c).over(previous(w)) for name, c in AVERAGED.items() for w in cfg.moving_windows
    }


def exponential_means(cfg: FeatureConfig = DEFAULT_CONFIG) -> Columns:
    return {f"ema_{alpha}".replace(".", "_"): exponential_mean("demand", alpha) for alpha in cfg.ema_alphas}


def rolling_std(cfg: FeatureConfig = DEFAULT_CONFIG) -> Columns:
    measures = {"demand_std": "demand", "price_std": "avg_price"}
    return {
        f"{name}_{w}": F.stddev_samp(c).over(previous(w)) for name, c in measures.items() for w in cfg.stat_windows
    }


def rolling_range(cfg: FeatureConfig = DEFAULT_CONFIG) -> Columns:
    edges = {"demand_min": F.min, "demand_max": F.max}
    return {f"{name}_{w}": f("demand").over(previous(w)) for name, f in edges.items() for w in cfg.stat_windows}


def growth_rates() -> Columns:
    by_months = {f"demand_growth_{n}m": growth("demand", n) for n in (1, 3, 12)}
    return {**by_months, "sales_growth_1m": growth("total_sales"), "price_growth_1m": growth("avg_price")}


def momentum() -> Columns:
    return {
        "demand_momentum_3m": change("demand", 3),
        "demand_momentum_12m": change("demand", 12),
        "sales_momentum_3m": change("total_sales", 3),
    }


def seasonality(cfg: FeatureConfig = DEFAULT_CONFIG) -> Columns:
    """NULL in series of up to one year, as the lag is."""
    return {
        "seasonal_ratio_12m": ratio("demand", lag("demand", cfg.year_months)),
        "seasonal_difference_12m": change("demand", cfg.year_months),
    }


def volatility(cfg: FeatureConfig = DEFAULT_CONFIG) -> Columns:
    measures = {"demand_volatility_6m": "demand", "price_volatility_6m": "avg_price"}
    return {name: variation(c, cfg.volatility_window) for name, c in measures.items()}


def trend() -> Columns:
    return {"demand_trend_3m": change("demand", 3) / 3}


def acceleration() -> Columns:
    """Change of the monthly growth rate; needs ``demand_growth_1m`` in the table."""
    return {"demand_acceleration": change("demand_growth_1m", 1)}


def yoy_growth(cfg: FeatureConfig = DEFAULT_CONFIG) -> Columns:
    measures = {"demand": "demand", "sales": "total_sales", "price": "avg_price"}
    return {f"yoy_{name}_growth": growth(c, cfg.year_months) for name, c in measures.items()}


def mom_growth() -> Columns:
    return {"mom_demand_growth": growth("demand"), "mom_sales_growth": growth("total_sales")}


def trailing_year(cfg: FeatureConfig = DEFAULT_CONFIG) -> Columns:
    """Sums over the last twelve rows, the current one included."""
    frame = by_date().rowsBetween(1 - cfg.year_months, 0)
    return {
        "cumulative_demand_year": F.sum("demand").over(frame),
        "cumulative_sales_year": F.sum("total_sales").over(frame),
    }


def skewness(cfg: FeatureConfig = DEFAULT_CONFIG) -> Columns:
    return {"demand_skew_12m": rolling_skew("demand", cfg.year_months)}


def quantiles(cfg: FeatureConfig = DEFAULT_CONFIG) -> Columns:
    low = rolling_percentile("demand", cfg.year_months, 0.25)
    high = rolling_percentile("demand", cfg.year_months, 0.75)
    return {
        "demand_percentile_25_12m": low,
        "demand_percentile_75_12m": high,
        "demand_iqr_12m": high - low,
    }


def yearly_variation(cfg: FeatureConfig = DEFAULT_CONFIG) -> Columns:
    return {"demand_cv_12m": variation("demand", cfg.year_months)}


def series_features(df: DataFrame, cfg: FeatureConfig = DEFAULT_CONFIG) -> DataFrame:
    """Target, lags, moving statistics, growth, momentum, seasonality, volatility and trend."""
    first = {
        **target(),
        **lags(cfg),
        **moving_averages(cfg),
        **exponential_means(cfg),
        **rolling_std(cfg),
        **rolling_range(cfg),
        **growth_rates(),
        **momentum(),
        **seasonality(cfg),
        **volatility(cfg),
        **trend(),
    }
    return df.withColumns(first).withColumns(acceleration())


def yearly_features(df: DataFrame, cfg: FeatureConfig = DEFAULT_CONFIG) -> DataFrame:
    """Year-on-year, month-on-month and trailing-year columns."""
    return df.withColumns({**yoy_growth(cfg), **mom_growth(), **trailing_year(cfg)})


def statistical_features(df: DataFrame, cfg: FeatureConfig = DEFAULT_CONFIG) -> DataFrame:
    """Skewness, quantiles and variation of the previous year."""
    return df.withColumns({**skewness(cfg), **quantiles(cfg), **yearly_variation(cfg)})
