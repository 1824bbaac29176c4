"""Data-quality and exploratory reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from demandloom.config import CATEGORY, MONTH, TARGET
from demandloom.functions.tables import join_by_key, row_groups


def _missing(df: DataFrame, c: str) -> Column:
    value = F.col(c)
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _nulls_per_row(df: DataFrame) -> Column:
    return sum((_missing(df, c).cast("int") for c in df.columns), F.lit(0))


def data_quality(df: DataFrame, name: str) -> DataFrame:
    """Rows, nulls, repeated rows, invalid prices and negative freights in one aggregation."""
    copies = F.col("_copies")

    def rows_where(c: str, condition) -> Column:
        if c not in df.columns:
            return F.lit(0).cast("long")
        return F.coalesce(F.sum(F.when(condition(F.col(c)), copies)), F.lit(0))

    rows = F.coalesce(F.sum(copies), F.lit(0))
    nulls = F.coalesce(F.sum(_nulls_per_row(df) * copies), F.lit(0))
    return (
        row_groups(df)
        .agg(
            rows.alias("n_rows"),
            nulls.alias("nulls_total"),
            (rows - F.count(F.lit(1))).alias("duplicate_rows"),
            rows_where("price", lambda c: c <= 0).alias("invalid_prices"),
            rows_where("freight_value", lambda c: c < 0).alias("negative_freights"),
        )
        .select(
            F.lit(name).alias("dataset"),
            "n_rows",
            "nulls_total",
            F.try_divide(F.col("nulls_total") * 100, F.col("n_rows") * len(df.columns)).alias("nulls_pct"),
            "duplicate_rows",
            "invalid_prices",
            "negative_freights",
        )
    )


def compare_quality(before: DataFrame, after: DataFrame) -> DataFrame:
    return data_quality(before, "original").unionByName(data_quality(after, "clean"))


def validate_table(df: DataFrame, name: str) -> DataFrame:
    """Shape, null count and repeated rows of a table."""
    report = data_quality(df, name)
    return report.select(
        "dataset", "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"), "nulls_total", "duplicate_rows"
    )


def null_counts(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count")


def key_uniqueness(df: DataFrame, key: str, name: str) -> DataFrame:
    """Whether the number of distinct keys equals the number of rows.

    Keys are grouped first, so a hot key is one partial row per task.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    return per_key.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("n_rows"), F.count(key).alias("n_keys")
    ).select(F.lit(name).alias("dataset"), "n_rows", "n_keys", (F.col("n_rows") == F.col("n_keys")).alias("is_unique"))


def period_range(df: DataFrame, c: str = MONTH) -> DataFrame:
    return df.agg(F.min(c).alias("first_period"), F.max(c).alias("last_period"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count_distinct(c).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "distinct_values")


def predicate_counts(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(p).alias(name) for name, p in predicates.items()]
    )


def target_completeness(df: DataFrame, target: str = TARGET) -> DataFrame:
    rows, known = F.count(F.lit(1)), F.count(target)
    return df.agg(
        rows.alias("n_rows"), known.alias("n_with_target"), F.try_divide(known * 100, rows).alias("pct_complete")
    )


def demand_by_month(df: DataFrame, c: str) -> DataFrame:
    return df.groupBy(MONTH).agg(F.sum(c).alias("total_demand"))


def value_counts(df: DataFrame, c: str = CATEGORY) -> DataFrame:
    return df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n_rows"))


def top_groups(df: DataFrame, measure: Column, name: str, k: int) -> DataFrame:
    """The ``k`` categories with the largest aggregate; ties go by name."""
    ranked = df.groupBy(CATEGORY).agg(measure.alias(name))
    return ranked.orderBy(F.desc(name), F.asc(CATEGORY)).limit(k)


def top_category_series(df: DataFrame, k: int = 6) -> DataFrame:
    """All rows of the ``k`` categories with the most rows."""
    top = top_groups(df, F.count(F.lit(1)), "n_rows", k).select(CATEGORY)
    return df.join(top, CATEGORY, "left_semi")


def category_profile(df: DataFrame, units: str, target: str = TARGET) -> DataFrame:
    return df.groupBy(CATEGORY).agg(
        F.count(units).alias("units_count"),
        F.round(F.avg(units), 2).alias("units_mean"),
        F.round(F.stddev_samp(units), 2).alias("units_std"),
        F.round(F.avg(target), 2).alias("target_mean"),
        F.round(F.stddev_samp(target), 2).alias("target_std"),
    )


def categories_over(df: DataFrame, months: int = 12) -> DataFrame:
    return value_counts(df).filter(F.col("n_rows") > months)


def histogram(df: DataFrame, c: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty ones included.

    All bins but the last exclude their upper edge. A column with one single
    value gets the range of half a unit on each side of it.
    """
    value = F.col(c).cast("double")
    bounds = df.select(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    low, high = bounds["low"], bounds["high"]
    half = F.when(low == high, 0.5).otherwise(0.0)
    first, last = low - half, high + half
    step = (last - first) / bins
    position = F.least(F.width_bucket(value, first, last, F.lit(bins)), F.lit(bins).cast("long"))
    counts = df.filter(value.isNotNull()).groupBy(position.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    edges = spark.range(1, bins + 1).withColumnRenamed("id", "bin")
    return edges.join(counts, "bin", "left").select(
        F.lit(c).alias("measure"),
        "bin",
        (first + step * (F.col("bin") - 1)).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n_rows"),
    )


def split_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.groupBy("split").agg(
        F.avg("demand").alias("demand_mean"),
        F.stddev_samp("demand").alias("demand_std"),
        F.avg(target).alias("target_mean"),
        F.stddev_samp(target).alias("target_std"),
    )


def split_completeness(df: DataFrame, target: str = TARGET) -> DataFrame:
    rows, known = F.count(F.lit(1)), F.count(target)
    return df.groupBy("split").agg(
        rows.alias("n_rows"),
        known.alias("n_with_target"),
        F.try_divide(known * 100, rows).alias("pct_complete"),
    )


def sample_first_category(df: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` months of the alphabetically first category."""
    first = df.select(F.min(CATEGORY)).scalar()
    return df.filter(F.col(CATEGORY) == first).orderBy(MONTH).limit(k)


def head(df: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` rows in month, category order."""
    return df.orderBy(MONTH, CATEGORY).limit(k)


def new_categories(test: DataFrame, train: DataFrame) -> DataFrame:
    """Categories of ``test`` that ``train`` does not have, by anti join."""
    seen = train.select(CATEGORY).distinct()
    return test.select(CATEGORY).distinct().join(seen, CATEGORY, "left_anti")


def new_categories_except(test: DataFrame, train: DataFrame) -> DataFrame:
    """The same as a set difference."""
    return test.select(CATEGORY).subtract(train.select(CATEGORY))


def restore_category(df: DataFrame, products: DataFrame, default: str = "unknown_category") -> DataFrame:
    """Add the category from the product table, or a default when there is none to look up."""
    if CATEGORY in df.columns:
        return df
    if CATEGORY in products.columns:
        mapping = products.select("product_id", CATEGORY).distinct()
        return join_by_key(df, mapping, "product_id", "left")
    return df.withColumn(CATEGORY, F.lit(default))
