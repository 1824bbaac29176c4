"""Error metrics of stacked predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.config import KEYS, TARGET
from demandloom.functions.scalar import finite_or_zero


def _actual() -> Column:
    return F.col(TARGET)


def _error() -> Column:
    return F.col(TARGET) - F.col("prediction")


def stack_predictions(df: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per prediction, unusable predictions replaced by 0."""
    wide = df.select(*KEYS, TARGET, *[finite_or_zero(m).alias(m) for m in models])
    return wide.unpivot([*KEYS, TARGET], list(models), "model", "prediction")


def _errors() -> list[Column]:
    error = _error()
    variation = F.var_pop(TARGET) * F.count(TARGET)
    r2 = F.when(variation == 0, 0.0).otherwise(1 - F.try_divide(F.sum(F.pow(error, 2)), variation))
    return [
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(F.pow(error, 2))).alias("rmse"),
        r2.alias("r2"),
    ]


def model_metrics(stacked: DataFrame) -> DataFrame:
    """MAE, RMSE and R² per model."""
    return stacked.groupBy("model").agg(*_errors())


def forecast_metrics(stacked: DataFrame, test: DataFrame) -> DataFrame:
    """The same with MAPE, MASE against the mean of the test targets, and 100 - MAPE."""
    centre = test.select(F.avg(TARGET)).scalar()
    relative = F.avg(F.abs(_error() / (_actual() + 1e-8))) * 100
    scaled = F.try_divide(F.avg(F.abs(_error())), F.avg(F.abs(_actual() - F.col("_centre"))))
    return (
        stacked.withColumn("_centre", centre)
        .groupBy("model")
        .agg(*_errors(), relative.alias("mape"), scaled.alias("mase"))
        .withColumn("accuracy", 100 - F.col("mape"))
    )


def comparison_table(metrics: DataFrame) -> DataFrame:
    """Models from best to worst MAE; failed models (NULL metrics) last."""
    return metrics.orderBy(F.asc_nulls_last("mae"), "model")


def best_model(metrics: DataFrame, trained_only: bool = False) -> DataFrame:
    """The model with the smallest MAE, naive models left out if asked."""
    candidates = metrics.filter(F.col("mae").isNotNull())
    if trained_only:
        candidates = candidates.filter(~F.col("model").contains("naive"))
    return candidates.orderBy("mae", "model").limit(1)


def top_errors(stacked: DataFrame, k: int = 3) -> DataFrame:
    """The predictions furthest from the target; ties go by month, category and model."""
    return stacked.withColumn("abs_error", F.abs(_error())).orderBy(F.desc("abs_error"), *KEYS, "model").limit(k)
