"""Window expressions over one category's months.

The windows run on the monthly aggregate, so a window partition never holds
more rows than there are months, however hot the category is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from demandloom.config import CATEGORY, DATE
from demandloom.functions.scalar import ratio


def by_date() -> WindowSpec:
    return Window.partitionBy(CATEGORY).orderBy(DATE)


def previous(rows: int) -> WindowSpec:
    """The ``rows`` rows before the current one."""
    return by_date().rowsBetween(-rows, -1)


def lag(c: str, n: int = 1) -> Column:
    return F.lag(c, n).over(by_date())


def full(value: Column, c: str, rows: int) -> Column:
    """``value`` where all ``rows`` previous rows hold a value, otherwise NULL."""
    return F.when(F.count(c).over(previous(rows)) == rows, value)


def growth(c: str, n: int = 1) -> Column:
    return ratio(c, lag(c, n)) - 1


def change(c: str, n: int) -> Column:
    return F.col(c) - lag(c, n)


def variation(c: str, rows: int) -> Column:
    """Standard deviation over mean of the previous ``rows`` rows, full windows only."""
    spread = F.stddev_samp(c).over(previous(rows))
    centre = F.avg(c).over(previous(rows))
    return full(spread / (centre + 1e-8), c, rows)


def exponential_mean(c: str, alpha: float) -> Column:
    """Weighted mean of all earlier rows, weight ``(1 - alpha) ** age``.

    A row without a value ages the rows before it and adds nothing itself. With
    ``alpha`` 1 only the row before counts. The whole history is read: a window
    partition holds one category's months.
    """
    if alpha >= 1:
        return F.lag(F.col(c).cast("double")).over(by_date())
    decay = 1.0 - alpha
    earlier = by_date().rowsBetween(Window.unboundedPreceding, -1)
    # a list leaves nulls out, but not the structs that hold them
    history = F.collect_list(F.struct(F.col(c).cast("double").alias("value"))).over(earlier)
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("weight"))
    return F.aggregate(
        history,
        start,
        lambda acc, x: F.struct(
            (acc["total"] * decay + F.coalesce(x["value"], F.lit(0.0))).alias("total"),
            (acc["weight"] * decay + F.when(x["value"].isNull(), 0.0).otherwise(1.0)).alias("weight"),
        ),
        lambda acc: ratio(acc["total"], acc["weight"]),
    )


def rolling_skew(c: str, rows: int) -> Column:
    """Bias-corrected skewness of the previous ``rows`` rows; 0 for a constant window."""
    correction = math.sqrt(rows * (rows - 1)) / (rows - 2)
    population = F.skewness(c).over(previous(rows))
    return full(F.coalesce(F.nanvl(population, F.lit(0.0)) * correction, F.lit(0.0)), c, rows)


def rolling_percentile(c: str, rows: int, q: float) -> Column:
    return full(F.percentile(c, F.lit(q)).over(previous(rows)), c, rows)


def guarded(value: Column, min_rows: int) -> Column:
    """``value`` only in categories with at least ``min_rows`` months."""
    size = F.count(F.lit(1)).over(Window.partitionBy(CATEGORY))
    return F.when(size >= min_rows, value)
