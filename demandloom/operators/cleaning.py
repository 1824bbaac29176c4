"""Cleaning of the five source tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.config import CATEGORY, DIMENSION_COLUMNS, ORDER_COLUMNS
from demandloom.functions.scalar import normalize_category, parse_number, parse_timestamp
from demandloom.functions.tables import join_by_key, keep_first, select_existing


def clean_orders(orders: DataFrame, status: str = "delivered", order_by: Sequence[str] = ()) -> DataFrame:
    """Delivered orders, one row per id, with a purchase time."""
    wanted = select_existing(orders, ORDER_COLUMNS).filter(F.col("order_status") == status)
    return keep_first(wanted, ["order_id"], order_by).filter(F.col("order_purchase_timestamp").isNotNull())


def clean_items(items: DataFrame) -> DataFrame:
    """Distinct item rows with a positive price and no negative freight."""
    return items.filter((F.col("price") > 0) & (F.col("freight_value") >= 0)).distinct()


def clean_products(products: DataFrame, dashes: bool = False, order_by: Sequence[str] = ()) -> DataFrame:
    """Normalised category, numeric dimensions, one row per product."""
    parsed = {c: parse_number(c) for c in DIMENSION_COLUMNS if c in products.columns}
    if CATEGORY in products.columns:
        parsed[CATEGORY] = normalize_category(CATEGORY, dashes)
    return keep_first(products, ["product_id"], order_by).withColumns(parsed)


def clean_payments(payments: DataFrame) -> DataFrame:
    """Distinct payment rows with a readable, non-negative value."""
    value = parse_number("payment_value")
    return payments.filter(value >= 0).distinct().withColumn("payment_value", value)


def clean_reviews(reviews: DataFrame, order_by: Sequence[str] = ("review_id",)) -> DataFrame:
    """One review per order, with numeric score and parsed times."""
    parsed = {"review_score": parse_number("review_score")}
    for c in ("review_creation_date", "review_answer_timestamp"):
        if c in reviews.columns:
            parsed[c] = parse_timestamp(c)
    ranking = [c for c in order_by if c in reviews.columns]
    return keep_first(reviews, ["order_id"], ranking).withColumns(parsed)


def clean_all(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "orders": clean_orders(sources["orders"]),
        "items": clean_items(sources["items"]),
        "products": clean_products(sources["products"]),
        "payments": clean_payments(sources["payments"]),
        "reviews": clean_reviews(sources["reviews"]),
    }


# The columns that belong to each entity of a wide joined table.
ENTITY_COLUMNS = {
    "orders": ORDER_COLUMNS,
    "items": ("order_id", "product_id", "price", "freight_value"),
    "products": ("product_id", CATEGORY, *DIMENSION_COLUMNS),
    "payments": ("order_id", "payment_value", "payment_installments", "payment_type"),
    "reviews": ("order_id", "review_score", "review_creation_date", "review_answer_timestamp"),
}


def clean_entity(name: str, df: DataFrame) -> DataFrame:
    """The columns of one entity, cleaned; the cleaner removes duplicates, which also undoes a fan-out."""
    cleaners = {
        "orders": clean_orders,
        "items": clean_items,
        "products": lambda rows: clean_products(rows, dashes=True),
        "payments": clean_payments,
        "reviews": clean_reviews,
    }
    return cleaners[name](select_existing(df, ENTITY_COLUMNS[name]))


# The keys without which an entity cannot be told from a wide table.
ENTITY_KEYS = {
    "orders": ("order_id",),
    "items": ("order_id", "product_id"),
    "products": ("product_id",),
    "payments": ("order_id",),
    "reviews": ("order_id",),
}


def decompose_wide(wide: DataFrame) -> dict[str, DataFrame]:
    """Split any wide joined table back into cleaned entity tables.

    An entity is left out when its key is not in the table. Each entity reads its own
    columns only, so the table should be a stored one, and goes straight to its cleaner,
    whose aggregation undoes most of the fan-out before its one shuffle.
    For the star join itself see ``star.star_entities``.
    """
    return {
        name: clean_entity(name, wide) for name in ENTITY_COLUMNS if all(k in wide.columns for k in ENTITY_KEYS[name])
    }


def clean_combined(wide: DataFrame, orders_clean: DataFrame, products_clean: DataFrame) -> DataFrame:
    """Rows of the wide table with a valid order, a valid product, price and freight."""
    valued = wide.filter((F.col("price") > 0) & (F.col("freight_value") >= 0))
    in_orders = join_by_key(valued, orders_clean.select("order_id").distinct(), "order_id", "left_semi")
    return join_by_key(in_orders, products_clean.select("product_id").distinct(), "product_id", "left_semi")
