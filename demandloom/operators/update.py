"""Adding months to an existing feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.config import CATEGORY, DATE, MONTH
from demandloom.functions.scalar import month_label, month_start


def latest_per_category(df: DataFrame) -> DataFrame:
    """The newest row of each category, by a grouped maximum (no sort of the series)."""
    newest = df.groupBy(CATEGORY).agg(F.max_by(F.struct(*df.columns), MONTH).alias("_row"))
    return newest.select("_row.*")


def future_months(df: DataFrame, months: int = 1) -> DataFrame:
    """Each category with every month that follows the last one of the table."""
    last = df.select(F.max(month_start(MONTH))).scalar()
    following = F.explode(F.sequence(F.lit(1), F.lit(months)))
    ahead = df.select(CATEGORY).distinct().select(CATEGORY, following.alias("_step"))
    date = F.add_months(last, F.col("_step"))
    return ahead.select(month_label(date).alias(MONTH), CATEGORY, date.alias(DATE))


def next_month_rows(df: DataFrame, months: int = 1) -> DataFrame:
    """Copies of each category's newest row, moved to the months after the table."""
    newest = latest_per_category(df)
    moved = newest.drop(MONTH, DATE).join(future_months(df, months), CATEGORY)
    return moved.select(*df.columns)


def append_months(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new rows in one table, features unchanged; columns may differ."""
    return existing.unionByName(new, allowMissingColumns=True)


def by_category_and_date(df: DataFrame) -> DataFrame:
    """The output order of an updated table; sort only where the table is written."""
    return df.orderBy(CATEGORY, DATE)
