"""Keeping the monthly table and the features up to date as orders arrive.

Three stored tables: the state of ``operators.monthly_state`` by month, the finished monthly
table by category, and the labelled features by category. New orders touch some
months and some categories; only the folders of those are read and written.
A category's features are recomputed for its whole series, since its own
statistics, which every row carries, cover all its months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.config import CATEGORY, DEFAULT_CONFIG, KEYS, FeatureConfig
from demandloom.operators.final import final_clean
from demandloom.operators.monthly_state import MEASURES, finish, merge_stored, read_state, write_state
from demandloom.plans.features import features_from_monthly
from demandloom.session import materialize


def write_by_category(df: DataFrame, path: str) -> None:
    """Replace the folders of the categories in the table; others stay. A category is one file."""
    dealt = df.repartition(CATEGORY)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(CATEGORY).parquet(path)


def read_by_category(spark: SparkSession, path: str, categories: Sequence[str] | None = None) -> DataFrame:
    """The stored table, or the folders of some categories."""
    fields = [f for f in spark.read.parquet(path).schema if f.name != CATEGORY]
    table = spark.read.schema(T.StructType([*fields, T.StructField(CATEGORY, T.StringType())])).parquet(path)
    return table if categories is None else table.where(F.col(CATEGORY).isin(list(categories)))


def start(state: DataFrame, root: str, cfg: FeatureConfig = DEFAULT_CONFIG) -> None:
    """Store the state of the first orders, its monthly table and its features; both come from the stored state."""
    write_state(state, f"{root}/state")
    start_monthly(finish(read_state(state.sparkSession, f"{root}/state")), root, cfg)


def start_monthly(monthly: DataFrame, root: str, cfg: FeatureConfig = DEFAULT_CONFIG) -> None:
    stored = materialize(monthly, "monthly")
    write_by_category(stored, f"{root}/monthly")
    write_by_category(final_clean(features_from_monthly(stored, cfg)), f"{root}/features")


def update_months(spark: SparkSession, root: str, rows: DataFrame, cfg: FeatureConfig = DEFAULT_CONFIG) -> list[str]:
    """Put monthly rows in place of those with the same keys, and recompute the features of their categories.

    Returns the categories, whose names the driver holds. The features have the
    columns of ``final_clean``; rows without a target are in the monthly table only.
    """
    new = materialize(rows, "new-months")
    changed = sorted(r[0] for r in new.select(CATEGORY).distinct().collect())
    old = read_by_category(spark, f"{root}/monthly", changed)
    kept = old.join(new.select(*KEYS), list(KEYS), "left_anti")
    series = materialize(kept.unionByName(new.select(*kept.columns)), "series")
    write_by_category(series, f"{root}/monthly")
    write_by_category(final_clean(features_from_monthly(series, cfg)), f"{root}/features")
    return changed


def update_orders(spark: SparkSession, root: str, new_state: DataFrame, cfg: FeatureConfig = DEFAULT_CONFIG) -> list[str]:
    """Merge the state of new orders (``monthly_state.state_of``) and bring all three tables up to date.

    The touched groups are sought among the finished rows, one a group, not among those of the ids.
    """
    touched = materialize(new_state, "touched")
    finished = finish(merge_stored(spark, f"{root}/state", touched))
    groups = touched.where(F.col("kind") == MEASURES).select(*KEYS)
    return update_months(spark, root, finished.join(groups, list(KEYS), "left_semi"), cfg)
