"""Per-order features and the item-grain table."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.config import CATEGORY, PAYMENT_TYPES, REVIEW_SCORES
from demandloom.functions.scalar import flag, floored_days, month_label
from demandloom.functions.tables import fill_numeric_nulls, join_by_key


def order_base_features(orders: DataFrame) -> DataFrame:
    """Purchase month, delivery time, delay against the estimate and the delay flag."""
    delivered = "order_delivered_customer_date"
    estimated = "order_estimated_delivery_date"
    if estimated in orders.columns:
        delay = floored_days(delivered, estimated)
    else:
        delay = F.lit(0)
    return orders.withColumns(
        {
            "order_month": month_label("order_purchase_timestamp"),
            "delivery_time_days": floored_days(delivered, "order_purchase_timestamp"),
            "delivery_delay": delay,
        }
    ).withColumn("is_delayed", flag(F.col("delivery_delay") > 0))


def payment_type_shares(types: Sequence[str] = PAYMENT_TYPES) -> list:
    """Share of each payment type among the rows with a known type (extra types count too)."""
    known = F.count("payment_type")
    return [
        F.try_divide(F.count_if(F.col("payment_type") == t), known).alias(f"pct_{t}")
        for t in types
    ]


def payment_type_pivot(payments: DataFrame) -> DataFrame:
    """Type shares for the orders that have at least one known type."""
    typed = payments.filter(F.col("order_id").isNotNull() & F.col("payment_type").isNotNull())
    return typed.groupBy("order_id").agg(*payment_type_shares())


def column_suffixes(values: Sequence[str]) -> dict[str, str]:
    """A safe and distinct column suffix for each value: lower case, underscores, and a number where two would be equal."""
    names: dict[str, str] = {}
    for value in sorted(values):
        plain = re.sub(r"[^0-9a-z]+", "_", value.lower()).strip("_") or "blank"
        name, n = plain, 1
        while name in names.values():
            n += 1
            name = f"{plain}_{n}"
        names[value] = name
    return names


def payment_type_pivot_all(payments: DataFrame, most: int = 200) -> DataFrame:
    """Shares of every payment type that the data hold, per order with a known type.

    A first, narrow aggregation finds the types, whose names become columns; a
    second one counts them. More than ``most`` types are an error, so that
    a free text in the type column cannot make a table of unlimited width.
    """
    typed = payments.filter(F.col("order_id").isNotNull() & F.col("payment_type").isNotNull())
    found = [r[0] for r in typed.select("payment_type").distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} payment types")
    known = F.count(F.lit(1))
    shares = [
        (F.count_if(F.col("payment_type") == value) / known).alias(f"pct_{name}") for value, name in column_suffixes(found).items()
    ]
    return typed.groupBy("order_id").agg(*shares) if shares else typed.select("order_id").distinct()


def payment_features(payments: DataFrame) -> DataFrame:
    """Value, instalments and type shares per order, in one aggregation."""
    value, parts = "payment_value", "payment_installments"
    if "payment_type" in payments.columns:
        shares = payment_type_shares()
    else:
        shares = [F.lit(0.0).alias(f"pct_{t}") for t in PAYMENT_TYPES]
    return (
        payments.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.coalesce(F.sum(value), F.lit(0.0)).alias("payment_total"),
            F.avg(value).alias("payment_avg"),
            F.count(value).alias("payment_count"),
            F.avg(parts).alias("installments_avg"),
            F.max(parts).alias("installments_max"),
            F.coalesce(F.sum(parts), F.lit(0)).alias("installments_total"),
            *shares,
        )
    )


def review_features(reviews: DataFrame) -> DataFrame:
    """Score mean, score count and the share of each score per order."""
    score = F.col("review_score")
    shares = [
        (F.count_if(score == k) / F.count(F.lit(1))).alias(f"review_pct_{k}") for k in REVIEW_SCORES
    ]
    per_order = (
        reviews.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.avg(score).alias("review_score_mean"),
            F.count(score).alias("review_count"),
            *shares,
        )
    )
    return fill_numeric_nulls(per_order)


def order_level(orders: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """Order, payment and review features side by side; all three are already grouped by order."""
    joined = orders.join(payments, "order_id", "left").join(reviews, "order_id", "left")
    return fill_numeric_nulls(joined)


def items_with_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with their category; items of unknown products keep a NULL category."""
    return join_by_key(items, products.select("product_id", CATEGORY), "product_id", "left")


def item_grain(items: DataFrame, products: DataFrame, orders: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per item of a clean order, with product and order features.

    Rows without month or category are dropped, which makes both joins inner.
    Nulls are filled on the order side, before its values fan out to the items.
    The orders come first: they drop the items of undelivered orders before products are looked up.
    """
    catalogued = products.select("product_id", CATEGORY).filter(F.col(CATEGORY).isNotNull())
    dated = order_level(orders, payments, reviews).filter(F.col("order_month").isNotNull())
    sold = join_by_key(items, dated, "order_id", "inner")
    joined = join_by_key(sold, catalogued, "product_id", "inner")
    keys = ("order_id", "product_id")
    of_item = [c for c in items.columns if c not in keys]
    return joined.select(*keys, *of_item, CATEGORY, *[c for c in dated.columns if c not in keys])


def build_item_grain(clean: dict[str, DataFrame]) -> DataFrame:
    return item_grain(
        clean["items"],
        clean["products"],
        order_base_features(clean["orders"]),
        payment_features(clean["payments"]),
        review_features(clean["reviews"]),
    )
