"""Final cleaning of the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.config import TARGET
from demandloom.functions.scalar import numeric_columns
from demandloom.functions.tables import zero_unusable


def final_clean(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Labelled rows only; nulls, NaN and infinities become 0."""
    return zero_unusable(df.filter(F.col(target).isNotNull()))


def constant_columns(df: DataFrame) -> DataFrame:
    """Numeric columns with at most one distinct value, from one pass of minima and maxima."""
    names = numeric_columns(df)
    bounds = df.agg(
        *[F.min(c).cast("double").alias(f"lo_{i}") for i, c in enumerate(names)],
        *[F.max(c).cast("double").alias(f"hi_{i}") for i, c in enumerate(names)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"lo_{i}").alias("lo"), F.col(f"hi_{i}").alias("hi"))
            for i, c in enumerate(names)
        ]
    )
    return (
        bounds.select(F.inline(entries))
        .filter(F.col("lo").isNull() | (F.col("lo") == F.col("hi")))
        .select("column_name", F.col("lo").alias("value"))
    )


def drop_constant_columns(df: DataFrame) -> DataFrame:
    """Runs one aggregation; the list it brings to the driver is bounded by the column count."""
    names = [row["column_name"] for row in constant_columns(df).collect()]
    return df.drop(*names)
