"""The feature job: source tables in, labelled feature table out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from demandloom.config import DEFAULT_CONFIG, FeatureConfig
from demandloom.operators.aggregates import monthly_category_aggregate
from demandloom.operators.calendar import calendar_features
from demandloom.operators.category import category_features
from demandloom.operators.cleaning import clean_all
from demandloom.operators.final import drop_constant_columns, final_clean
from demandloom.operators.orders import build_item_grain
from demandloom.operators.ratios import business_ratios
from demandloom.operators.series import series_features, statistical_features, yearly_features
from demandloom.session import materialize


def monthly_table(
    sources: dict[str, DataFrame], cfg: FeatureConfig = DEFAULT_CONFIG, with_counts: bool = True
) -> DataFrame:
    """Clean, join to item grain and aggregate to month and category."""
    return monthly_category_aggregate(build_item_grain(clean_all(sources)), cfg, with_counts)


def features_from_monthly(monthly: DataFrame, cfg: FeatureConfig = DEFAULT_CONFIG) -> DataFrame:
    """All derived columns, unlabelled rows included."""
    return (
        monthly.transform(calendar_features)
        .transform(series_features, cfg)
        .transform(business_ratios)
        .transform(yearly_features, cfg)
        .transform(statistical_features, cfg)
        .transform(category_features)
    )


def build_features(
    sources: dict[str, DataFrame], cfg: FeatureConfig = DEFAULT_CONFIG, drop_constants: bool = True
) -> DataFrame:
    """The labelled feature table; without any order there is none.

    ``drop_constants`` stores the table, a few rows per category, since its minima and
    maxima have to be known before its columns are.
    """
    if sources["orders"].isEmpty():
        raise ValueError("no orders to build features from")
    table = final_clean(features_from_monthly(monthly_table(sources, cfg), cfg))
    return drop_constant_columns(materialize(table, "features")) if drop_constants else table
