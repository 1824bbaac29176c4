"""Category statistics and each month's position relative to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from demandloom.config import CATEGORY
from demandloom.functions.series import by_date


def stat_columns() -> dict[str, Column]:
    """Statistics of a category; the median is written as a percentile, which growing frames allow."""
    return {
        "category_avg_demand": F.avg("demand"),
        "category_std_demand": F.stddev_samp("demand"),
        "category_median_demand": F.percentile("demand", F.lit(0.5)),
        "category_max_demand": F.max("demand"),
        "category_avg_price": F.avg("avg_price"),
        "category_std_price": F.stddev_samp("avg_price"),
        "category_avg_review": F.avg("avg_review_score"),
    }


def category_stats(df: DataFrame) -> DataFrame:
    """One row of demand, price and review statistics per category."""
    return df.groupBy(CATEGORY).agg(*[value.alias(name) for name, value in stat_columns().items()])


def _versus(c: str, mean: str) -> Column:
    return F.col(c) / (F.col(mean) + 1e-8)


def _z_score(c: str, mean: str, std: str) -> Column:
    return (F.col(c) - F.col(mean)) / (F.col(std) + 1e-8)


def _described(df: DataFrame, months: WindowSpec) -> DataFrame:
    described = df.withColumns({name: value.over(months) for name, value in stat_columns().items()})
    return described.withColumns(
        {
            "demand_vs_category_avg": _versus("demand", "category_avg_demand"),
            "price_vs_category_avg": _versus("avg_price", "category_avg_price"),
            "review_vs_category_avg": _versus("avg_review_score", "category_avg_review"),
            "demand_z_score": _z_score("demand", "category_avg_demand", "category_std_demand"),
            "price_z_score": _z_score("avg_price", "category_avg_price", "category_std_price"),
        }
    )


def category_features(df: DataFrame) -> DataFrame:
    """The category statistics on every row, with relative values and z-scores.

    The statistics cover the whole series, later months included. They are
    window aggregates on the partitioning the series features already use, so
    the table is neither shuffled again nor computed twice for a join back.
    """
    return _described(df, Window.partitionBy(CATEGORY))


def category_features_as_of(df: DataFrame) -> DataFrame:
    """``category_features`` of what was known in each month: the category's rows up to that month, none later.

    The exact median of a growing frame is kept as counts of its values, so a row
    adds one value to it. A category's first month has no deviation (NULL).
    """
    return _described(df, by_date().rowsBetween(Window.unboundedPreceding, Window.currentRow))
