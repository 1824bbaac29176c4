"""Demand-forecasting features and analytics as Spark DataFrame jobs."""

from demandloom.config import DEFAULT_CONFIG, FeatureConfig

__all__ = ["DEFAULT_CONFIG", "FeatureConfig"]
