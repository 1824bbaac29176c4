"""Training, updating and retraining jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandloom.config import CATEGORY, DATE, DEFAULT_CONFIG, FeatureConfig
from demandloom.operators.final import final_clean
from demandloom.operators.models import Training, train_from_table
from demandloom.operators.update import append_months, by_category_and_date
from demandloom.plans.features import build_features, features_from_monthly
from demandloom.sources.files import read_or_build, read_snapshot, save_models, write_snapshot


def train_and_save(features: DataFrame, root: str, cfg: FeatureConfig = DEFAULT_CONFIG, **options) -> Training:
    """Train, then store every trained model and mark the best of them."""
    training = train_from_table(features, cfg=cfg, **options)
    best = training.best(trained_only=True).first()
    save_models(features.sparkSession, training.models, best["model"] if best else None, root)
    return training


def updated_features(existing: DataFrame, new: DataFrame, cfg: FeatureConfig = DEFAULT_CONFIG) -> DataFrame:
    """Feature table after adding months to the monthly aggregate, all series recomputed."""
    return final_clean(features_from_monthly(append_months(existing, new), cfg))


def stored_features(
    spark: SparkSession, path: str, sources: dict[str, DataFrame], cfg: FeatureConfig = DEFAULT_CONFIG
) -> DataFrame:
    """The feature table stored at ``path``; where there is none yet, it is built and stored first."""

    def build() -> DataFrame:
        build_features(sources, cfg).write.parquet(path)
        return spark.read.parquet(path)

    return read_or_build(spark, path, build)


def retrain(
    spark: SparkSession,
    features: DataFrame,
    new_rows: DataFrame,
    table_root: str,
    model_root: str,
    cfg: FeatureConfig = DEFAULT_CONFIG,
    **options,
) -> Training:
    """Append rows, store the table as a new snapshot in category, date order, train on it in that order."""
    write_snapshot(by_category_and_date(append_months(features, new_rows)), table_root)
    stored = read_snapshot(spark, table_root)
    return train_and_save(stored, model_root, cfg, order_by=(CATEGORY, DATE), **options)
