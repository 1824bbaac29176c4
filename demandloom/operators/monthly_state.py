"""The monthly aggregate as a state that later orders are merged into.

A state holds, per month and category, what the measures can be merged from: counts,
sums, smallest and largest values, and for deviations the mean and the sum of
squared distances from it. Distinct ids are kept exactly, as one narrow row per group and
id: ids of a group lie far apart, so that bitmaps over blocks of ids would hold about one each. New orders become a state of their own, and merging it needs
the old state of the months it touches, never the old orders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.config import CATEGORY, KEYS, MONTH, PAYMENT_TYPES, REVIEW_SCORES
from demandloom.functions.tables import join_by_key
from demandloom.operators.aggregates import DISTINCT_COUNTS, kept_rows
from demandloom.operators.split import with_position
from demandloom.session import materialize

MEASURES = "measures"
STATE_KEYS = (*KEYS, "kind", "id")
# Output names of the measures by how they come out of the state.
SUMS = {
    "total_sales": "price", "total_freight": "freight_value", "total_payments": "payment_total", "review_count_sum": "review_count",
}
MEANS = {
    "avg_price": "price", "avg_freight": "freight_value", "avg_payment": "payment_total", "payment_avg_mean": "payment_avg",
    "payment_count_mean": "payment_count", "installments_avg_mean": "installments_avg", "avg_review_score": "review_score_mean",
    "avg_delivery_time_days": "delivery_time_days", "avg_delivery_delay": "delivery_delay", "pct_delayed_orders": "is_delayed",
    **{f"pct_{t}_mean": f"pct_{t}" for t in PAYMENT_TYPES},
    **{f"review_pct_{k}_mean": f"review_pct_{k}" for k in REVIEW_SCORES},
}
DEVIATIONS = {"price_std": "price", "delivery_time_days_std": "delivery_time_days"}
RANGES = {"price": ("price_min", "price_max")}


def number_ids(known: DataFrame, ids: DataFrame) -> DataFrame:
    """The table (id, number) with a number for each further id; numbers once given stay.

    New ids are numbered on from the largest one in the order of the ids, without one task seeing all of them.
    """
    start = known.agg(F.coalesce(F.max("number") + 1, F.lit(0)).alias("start")).first()["start"]
    new = ids.where(F.col("id").isNotNull()).distinct().join(known.select("id"), "id", "left_anti")
    placed = with_position(new, ("id",))
    return known.select("id", "number").unionByName(placed.select("id", (F.col("position") + F.lit(start)).alias("number")))


def with_numbers(items: DataFrame, numbers: Mapping[str, DataFrame]) -> DataFrame:
    """Item rows whose id columns are replaced by their numbers; ids without a number are an error to be seen as nulls."""
    for name, table in numbers.items():
        numbered = table.select(F.col("id").alias(name), F.col("number").alias("_number"))
        items = join_by_key(items, numbered, name, "left").drop(name).withColumnRenamed("_number", name)
    return items


#: Shares that the ids of a month are dealt in, each of which one task holds and writes.
SHARES = 8


def _distinct_ids(rows: DataFrame) -> DataFrame:
    """Distinct ids, shuffled by share of a month: else each task of a growing input would write a file of each month."""
    dealt = rows.select(*STATE_KEYS, F.pmod(F.xxhash64("id"), F.lit(SHARES)).alias("_share"))
    return dealt.repartition(MONTH, "_share").distinct().drop("_share")


def state_of(items: DataFrame) -> DataFrame:
    """The state of joined item rows (``orders.build_item_grain``): the measures, and the distinct ids.

    The item rows are stored once, since the measures and the ids are two aggregations
    (in one, every wide row would be sorted once per id). Ids have to be whole numbers (see ``number_ids``).
    """
    wrong = [c for c in DISTINCT_COUNTS.values() if not isinstance(items.schema[c].dataType, T.IntegralType)]
    if wrong:
        raise TypeError(f"ids must be numbered first: {wrong}")
    read = dict.fromkeys([*KEYS, "product_id", *SUMS.values(), *MEANS.values(), *DISTINCT_COUNTS.values()])
    keyed = kept_rows(items.where(F.col(MONTH).isNotNull() & F.col(CATEGORY).isNotNull()).select(*read))

    parts = [F.count("product_id").alias("demand")]
    parts += [F.count(c).alias(f"n_{c}") for c in dict.fromkeys(MEANS.values())]
    parts += [F.sum(c).alias(f"sum_{c}") for c in dict.fromkeys([*SUMS.values(), *MEANS.values()])]
    for c in DEVIATIONS.values():
        parts += [F.avg(c).alias(f"mean_{c}"), (F.var_pop(c) * F.count(c)).alias(f"m2_{c}")]
    for c in RANGES:
        parts += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    measures = keyed.groupBy(*KEYS).agg(*parts).withColumns({"kind": F.lit(MEASURES), "id": F.lit(None).cast("long")})

    entries = [F.struct(F.lit(name).alias("kind"), F.col(c).cast("long").alias("id")) for name, c in DISTINCT_COUNTS.items()]
    ids = keyed.select(*KEYS, F.explode(F.array(*entries)).alias("_entry")).select(*KEYS, "_entry.*")
    ids = _distinct_ids(ids.where(F.col("id").isNotNull()))
    values = [c for c in measures.columns if c not in STATE_KEYS]
    return measures.select(*STATE_KEYS, *values).unionByName(ids, allowMissingColumns=True)


def _pooled(c: str) -> Column:
    """(n, mean, m2) of several states: squared distances within, and those of the means."""

    def add(acc: Column, s: Column) -> Column:
        n = acc["n"] + s["n"]
        away = s["mean"] - acc["mean"]
        return F.when(s["n"] == 0, acc).when(acc["n"] == 0, s).otherwise(F.struct(
            n.alias("n"),
            (acc["mean"] + away * s["n"] / n).alias("mean"),
            (acc["m2"] + s["m2"] + away * away * acc["n"] * s["n"] / n).alias("m2"),
        ))

    states = F.collect_list(F.struct(F.col(f"n_{c}").alias("n"), F.col(f"mean_{c}").alias("mean"), F.col(f"m2_{c}").alias("m2")))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("m2"))
    return F.aggregate(F.array_sort(states), none, add)


def _is_measure() -> Column:
    return F.col("kind") == MEASURES


def merge(states: Sequence[DataFrame]) -> DataFrame:
    """One state for several; a group has as many rows of measures as there are states."""
    rows = states[0]
    for other in states[1:]:
        rows = rows.unionByName(other)
    pooled = {f"_{c}": _pooled(c) for c in DEVIATIONS.values()}
    merged = rows.where(_is_measure()).groupBy(*STATE_KEYS).agg(
        *[F.sum(c).alias(c) for c in rows.columns if c == "demand" or c.startswith(("n_", "sum_"))],
        *[F.min(f"min_{c}").alias(f"min_{c}") for c in RANGES],
        *[F.max(f"max_{c}").alias(f"max_{c}") for c in RANGES],
        *[value.alias(name) for name, value in pooled.items()],
    )
    spread = {f"{part}_{c}": F.col(f"_{c}")[part] for c in DEVIATIONS.values() for part in ("mean", "m2")}
    ids = _distinct_ids(rows.where(~_is_measure()))
    return merged.withColumns(spread).select(*rows.columns).unionByName(ids, allowMissingColumns=True)


def finish(state: DataFrame) -> DataFrame:
    """The table of ``aggregates.monthly_category_aggregate``: the row of measures and the number of ids of each kind."""
    measures = [c for c in state.columns if c not in STATE_KEYS]
    whole = state.where(_is_measure()).select(*KEYS, F.struct(*measures).alias("_m"))
    counts = state.where(~_is_measure()).groupBy(*KEYS).agg(*[F.count_if(F.col("kind") == n).alias(n) for n in DISTINCT_COUNTS])
    rows = whole.join(counts, list(KEYS), "left").fillna(0, subset=list(DISTINCT_COUNTS))
    m = F.col("_m")
    spread = {
        name: F.when(m[f"n_{c}"] > 1, F.sqrt(m[f"m2_{c}"] / (m[f"n_{c}"] - 1))) for name, c in DEVIATIONS.items()
    }
    return rows.select(
        *KEYS,
        m["demand"].alias("demand"),
        *DISTINCT_COUNTS,
        *[m[f"sum_{c}"].alias(name) for name, c in SUMS.items()],
        *[F.try_divide(m[f"sum_{c}"].cast("double"), m[f"n_{c}"]).alias(name) for name, c in MEANS.items()],
        *[value.alias(name) for name, value in spread.items()],
        *[m[f"min_{c}"].alias(low) for c, (low, _) in RANGES.items()],
        *[m[f"max_{c}"].alias(high) for c, (_, high) in RANGES.items()],
    )


def write_state(state: DataFrame, path: str) -> None:
    """The state by month; months that are there already are replaced, others stay."""
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def read_state(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """The stored state, or the folders of some months."""
    # the names of the months are text, whatever they look like
    fields = [f for f in spark.read.parquet(path).schema if f.name != MONTH]
    state = spark.read.schema(T.StructType([*fields, T.StructField(MONTH, T.StringType())])).parquet(path)
    return state if months is None else state.where(F.col(MONTH).isin(list(months)))


def update_state(spark: SparkSession, path: str, new: DataFrame) -> DataFrame:
    """Merge the state of new orders into the stored one, and return the merged rows of the months it touches.

    Only the folders of those months are read and written; the driver holds their names.
    The merged rows are written once: a month's old folder is replaced when all of them are there.
    """
    return merge_stored(spark, path, materialize(new, "new-state"))


def merge_stored(spark: SparkSession, path: str, new: DataFrame) -> DataFrame:
    """``update_state`` for a state of new orders that is stored already."""
    months = [r[0] for r in new.where(_is_measure()).select(MONTH).distinct().collect()]
    old = read_state(spark, path, months)
    write_state(merge([old, new.select(*old.columns)]), path)
    return read_state(spark, path, months)
