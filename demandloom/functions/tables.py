"""Table-level helpers: keyed dedup, skew-tolerant joins, null filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.scalar import numeric_columns
from demandloom.session import materialize


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order_by``, then by the other columns.

    A grouped minimum combines on the map side, so a key with very many copies
    reaches the shuffle as one row per task.
    """
    ranked = list(order_by) + [c for c in df.columns if c not in keys and c not in order_by]
    if not ranked:
        return df.distinct()
    winners = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_first"))
    picked = [F.col(c) if c in keys and c not in ranked else F.col(f"_first.{c}").alias(c) for c in df.columns]
    return winners.select(*picked)


def row_groups(df: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies; copies combine before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))


def join_by_key(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join a table with possibly hot keys (left) to one with few rows per key (right).

    The right side usually comes out of an aggregation on ``key`` and would be
    joined without a shuffle, which leaves nothing for the adaptive skew split
    to work on: all rows of a hot key would meet in one task. The added hash
    key makes Spark exchange both sides, so that a hot partition of the left
    side is split and a right side that turns out small is broadcast instead.
    It is one bit, which compresses to next to nothing; whole hashes do not compress,
    and were shuffled with every row.
    """
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(2))
    joined = left.withColumn("_bucket", bucket).join(right.withColumn("_bucket", bucket), [key, "_bucket"], how)
    return joined.drop("_bucket")


#: Rows of a key of the optional side that one salted part holds, about.
SALTED_ROWS = 10_000


def left_join_by_key(left: DataFrame, right: DataFrame, key: str, sizes: DataFrame | None = None) -> DataFrame:
    """Left join where the *right* side may have hot keys, and where ``left`` is read once.

    An outer join cannot split its optional side, so a hot key is split by salt:
    a narrow count per key says in how many parts the right rows of a key are
    dealt, each left row comes once for every part of its key, and a copy that
    meets no row of its part is dropped unless the key is not a hot one.

    Only hot keys, at most one per ``SALTED_ROWS`` right rows, are stored; as Spark
    knows the size of that table, both sides meet it by broadcast while it is small,
    and are shuffled once, for the join itself. ``sizes`` (key, ``_rows``) spares
    counting a right side that is costly to build.
    """
    counted = sizes if sizes is not None else right.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    busy = counted.where(F.col(key).isNotNull() & (F.col("_rows") > SALTED_ROWS))
    hot = materialize(busy.select(key, F.ceil(F.col("_rows") / SALTED_ROWS).cast("int").alias("_parts")), "hot-keys")
    salted = join_by_key(left, hot, key, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    )
    others = [c for c in right.columns if c != key]
    part = F.pmod(F.xxhash64(*right.columns), F.coalesce("_parts", F.lit(1))).cast("int")
    dealt = join_by_key(right, hot, key, "left").withColumn("_part", part)
    dealt = dealt.withColumn("_met", F.lit(True)).drop("_parts")
    joined = salted.join(dealt, [key, "_part"], "left")
    kept = joined.filter(F.col("_met").isNotNull() | F.col("_parts").isNull())
    return kept.select(*left.columns, *others)


# The keys of the source tables, where they are numbers.
ID_COLUMNS = ("order_id", "order_item_id", "product_id", "customer_id", "seller_id", "review_id")


def fill_numeric_nulls(
    df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = ID_COLUMNS
) -> DataFrame:
    """0 for every NULL or NaN in the numeric columns.

    The ``keys`` stay as they are: they have no nulls, and a key wrapped in an
    expression would hide its uniqueness and partitioning from the optimizer.
    """
    chosen = columns if columns is not None else [c for c in numeric_columns(df) if c not in keys]
    return df.fillna(0, subset=list(chosen)) if chosen else df


def zero_unusable(df: DataFrame) -> DataFrame:
    """0 for every NULL, NaN and infinity in the numeric columns, ids excepted."""
    fractional = [f.name for f in df.schema if isinstance(f.dataType, T.FractionalType)]
    infinities = {float("inf"): 0.0, -float("inf"): 0.0}
    return fill_numeric_nulls(df.replace(infinities, subset=fractional) if fractional else df)


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add each missing column with its default value; existing columns stay."""
    missing = {name: F.lit(value) for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])
