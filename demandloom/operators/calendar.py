"""Calendar features of a month."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.config import DATE, MONTH
from demandloom.functions.scalar import flag, month_start

# Month names and the months of each season flag.
MONTH_NAMES = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
SEASONS = {
    "is_holiday_season": (11, 12),
    "is_beginning_year": (1, 2),
    "is_mid_year": (6, 7),
    "is_end_quarter": (3, 6, 9, 12),
}


def with_date(df: DataFrame) -> DataFrame:
    return df.withColumn(DATE, month_start(MONTH))


def date_parts() -> dict[str, Column]:
    return {"year": F.year(DATE), "month_num": F.month(DATE), "quarter": F.quarter(DATE)}


def cycle_columns() -> dict[str, Column]:
    angles = {
        "month": F.month(DATE) * F.lit(2 * math.pi / 12),
        "quarter": F.quarter(DATE) * F.lit(2 * math.pi / 4),
    }
    return {
        f"{name}_{wave}": function(angle)
        for name, angle in angles.items()
        for wave, function in (("sin", F.sin), ("cos", F.cos))
    }


def season_columns() -> dict[str, Column]:
    return {name: flag(F.month(DATE).isin(*months)) for name, months in SEASONS.items()}


def dummy_columns() -> dict[str, Column]:
    by_month = {f"is_{name}": flag(F.month(DATE) == n) for n, name in enumerate(MONTH_NAMES, start=1)}
    by_quarter = {f"is_quarter_{q}": flag(F.quarter(DATE) == q) for q in range(1, 5)}
    return {**by_month, **by_quarter}


def calendar_features(df: DataFrame) -> DataFrame:
    return with_date(df).withColumns(
        {**date_parts(), **cycle_columns(), **season_columns(), **dummy_columns()}
    )
