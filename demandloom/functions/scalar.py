"""Scalar column helpers built from Spark functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def month_label(ts: str | Column) -> Column:
    return F.date_format(col(ts), "yyyy-MM")


def month_start(label: str | Column) -> Column:
    return F.to_date(F.concat(col(label), F.lit("-01")), "yyyy-MM-dd")


def floored_days(later: str | Column, earlier: str | Column) -> Column:
    """Whole days from ``earlier`` to ``later``, rounded towards minus infinity.

    ``datediff`` counts midnights, so one day too many is taken off again when
    the last started day is not complete. Works on wall-clock time for both
    timestamp types, whatever the session time zone.
    """
    later, earlier = col(later), col(earlier)
    midnights = F.datediff(later, earlier)
    overshoots = earlier + F.make_dt_interval(days=midnights) > later
    return F.when(overshoots, midnights - 1).otherwise(midnights)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def parse_number(c: str | Column) -> Column:
    """Double, or NULL for text that is no number (NaN text included)."""
    return F.nanvl(col(c).try_cast("double"), F.lit(None).cast("double"))


def parse_timestamp(c: str | Column) -> Column:
    return col(c).try_cast("timestamp_ntz")


def normalize_category(c: str | Column, dashes: bool = False) -> Column:
    """Lower case with underscores; a missing category becomes the text ``nan``."""
    lowered = F.lower(col(c))
    replaced = F.translate(lowered, " -", "__") if dashes else F.translate(lowered, " ", "_")
    return F.coalesce(replaced, F.lit("nan"))


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Division that gives NULL instead of an error or infinity for a zero divisor."""
    return F.try_divide(col(numerator), col(denominator))


def finite_or_zero(c: str | Column) -> Column:
    """NULL, NaN and both infinities become 0."""
    value = col(c).cast("double")
    is_number = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.when(is_number, value).otherwise(F.lit(0.0))


def clamp_non_negative(c: str | Column) -> Column:
    return F.greatest(F.lit(0.0), finite_or_zero(c))
