"""Naive forecasts: lookups and scalars learned from the training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandloom.config import CATEGORY, DATE, KEYS, TARGET


def _latest(order_by: Sequence[str] = KEYS) -> Column:
    """Target of the last row in ``order_by`` order."""
    return F.max_by(TARGET, F.struct(*order_by))


def _global_last(train: DataFrame, order_by: Sequence[str] = KEYS) -> Column:
    return train.select(_latest(order_by)).scalar()


def _global_mean(train: DataFrame) -> Column:
    return train.select(F.avg(TARGET)).scalar()


def _lookup(test: DataFrame, train: DataFrame, value: Column, fallback: Column, name: str) -> DataFrame:
    """One learned value per category (a table as small as the category list), or the fallback."""
    learned = train.groupBy(CATEGORY).agg(value.cast("double").alias("_learned"))
    return (
        test.join(learned, CATEGORY, "left")
        .withColumn(name, F.coalesce("_learned", fallback.cast("double")))
        .drop("_learned")
    )


def naive_last_value(
    test: DataFrame, train: DataFrame, name: str = "naive_last_value", order_by: Sequence[str] = KEYS
) -> DataFrame:
    """The last training target for every row."""
    return test.withColumn(name, _global_last(train, order_by).cast("double"))


def naive_historical_mean(
    test: DataFrame, train: DataFrame, name: str = "naive_historical_mean", order_by: Sequence[str] = KEYS
) -> DataFrame:
    """The mean training target for every row."""
    return test.withColumn(name, _global_mean(train))


def naive_by_category(
    test: DataFrame, train: DataFrame, name: str = "naive_by_category", order_by: Sequence[str] = KEYS
) -> DataFrame:
    """Last training target of the category, or the mean target for an unseen category."""
    return _lookup(test, train, _latest(order_by), _global_mean(train), name)


def forecast_last(
    test: DataFrame, train: DataFrame, name: str = "naive_category_last", order_by: Sequence[str] = KEYS
) -> DataFrame:
    """Last training target of the category, or of the whole table."""
    return _lookup(test, train, _latest(order_by), _global_last(train, order_by), name)


def forecast_mean(
    test: DataFrame, train: DataFrame, name: str = "naive_category_mean", order_by: Sequence[str] = KEYS
) -> DataFrame:
    """Mean training target of the category, or of the whole table."""
    return _lookup(test, train, F.avg(TARGET), _global_mean(train), name)


def forecast_seasonal_last(
    test: DataFrame, train: DataFrame, name: str = "seasonal_last", order_by: Sequence[str] = KEYS
) -> DataFrame:
    """Declared as seasonal, defined as the last value of the category."""
    return forecast_last(test, train, name, order_by)


def forecast_seasonal(
    test: DataFrame, train: DataFrame, name: str = "seasonal", order_by: Sequence[str] = KEYS
) -> DataFrame:
    """Target of the same calendar month in the latest earlier year that the training rows of the category hold.

    Without such a row it is the last training target of the category, then of the whole table.
    Asked and known rows meet in one window per category and calendar month, sorted by
    date, so each row sees the latest one before it without a range join.
    """
    month = F.month(DATE).alias("_month")
    day = F.unix_date(DATE).alias("_day")
    asked = test.select(CATEGORY, month, day, F.struct(*test.columns).alias("_row"), F.lit(None).cast("double").alias("_known"))
    none = F.lit(None).cast(asked.schema["_row"].dataType).alias("_row")
    known = train.select(CATEGORY, month, day, none, F.col(TARGET).cast("double").alias("_known"))
    earlier = Window.partitionBy(CATEGORY, "_month").orderBy("_day").rangeBetween(Window.unboundedPreceding, -1)
    met = asked.unionByName(known).withColumn("_season", F.last("_known", ignorenulls=True).over(earlier))
    found = met.where(F.col("_row").isNotNull()).select("_row.*", "_season")
    predicted = forecast_last(found, train, name, order_by)
    return predicted.withColumn(name, F.coalesce("_season", name)).drop("_season")


# Order of the columns of the stacked prediction tables.
NAIVE_MODELS = {
    "naive_last_value": naive_last_value,
    "naive_historical_mean": naive_historical_mean,
    "naive_by_category": naive_by_category,
}
FORECAST_MODELS = {
    "naive_category_last": forecast_last,
    "naive_category_mean": forecast_mean,
    "naive_global_last": naive_last_value,
}


def predict_all(test: DataFrame, train: DataFrame, models: dict, order_by: Sequence[str] = KEYS) -> DataFrame:
    """One prediction column per model."""
    predicted = test
    for name, model in models.items():
        predicted = model(predicted, train, name, order_by)
    return predicted
