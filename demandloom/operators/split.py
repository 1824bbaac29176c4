"""Train and test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandloom.config import DATE, DEFAULT_CONFIG, KEYS, FeatureConfig
from demandloom.session import materialize


def with_position(df: DataFrame, order_by: Sequence[str] = KEYS) -> DataFrame:
    """Zero-based row position in ``order_by`` order, without sorting or numbering the table in one task.

    Rows are dealt to ranges of the whole order and stored with the number of
    their range, since the counts and the numbering have to see the same ranges.
    Each range is numbered on its own; before it come the rows of all ranges
    below, one count per shuffle partition.
    """
    dealt = df.repartitionByRange(*order_by).withColumn("_range", F.spark_partition_id())
    ranged = materialize(dealt, "ranges")
    counts = dict(ranged.groupBy("_range").count().collect())
    offsets, total = [], 0
    for number in range(max(counts, default=-1) + 1):
        offsets.append(total)
        total += counts.get(number, 0)
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order_by)) - 1
    before = F.get(F.lit(offsets or [0]).cast("array<long>"), F.col("_range"))
    return ranged.withColumn("position", before + within).drop("_range")


def positional_split(
    df: DataFrame, cfg: FeatureConfig = DEFAULT_CONFIG, order_by: Sequence[str] = KEYS
) -> DataFrame:
    """Label the first 80 % of the rows ``train`` and the rest ``test``.

    ``order_by`` is month-major by default, which makes the split temporal; a
    category-major order holds out the last categories instead.
    """
    rows = df.select(F.count(F.lit(1))).scalar()
    cutoff = F.floor(rows * (1 - cfg.test_fraction))
    label = F.when(F.col("position") < cutoff, "train").otherwise("test")
    return with_position(df, order_by).withColumn("split", label)


def last_months_split(df: DataFrame, cfg: FeatureConfig = DEFAULT_CONFIG) -> DataFrame:
    """Label the rows of the last few distinct dates ``test``, all earlier ones ``train``."""
    held_out = df.select(DATE).distinct().orderBy(F.desc(DATE)).limit(cfg.holdout_months)
    boundary = held_out.select(F.min(DATE)).scalar()
    return df.withColumn("split", F.when(F.col(DATE) >= boundary, "test").otherwise("train"))


def train_part(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "train")


def test_part(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "test")
