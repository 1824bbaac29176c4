"""Monthly aggregates by product category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.config import CATEGORY, DEFAULT_CONFIG, KEYS, MONTH, PAYMENT_TYPES, REVIEW_SCORES, FeatureConfig
from demandloom.session import materialize

# Output names of the distinct counts.
DISTINCT_COUNTS = {
    "unique_products": "product_id",
    "unique_orders": "order_id",
    "unique_customers": "customer_id",
    "unique_sellers": "seller_id",
}


# The item columns that the measures are made of, apart from the shares.
MEASURED = (
    "product_id", "price", "freight_value", "payment_total", "payment_avg", "payment_count", "installments_avg",
    "review_score_mean", "review_count", "delivery_time_days", "delivery_delay", "is_delayed",
)


def kept_rows(items: DataFrame) -> DataFrame:
    """Joined item rows that two aggregations read: written to the shared folder, so the joins before them run once.

    A cached table would outlive the query and answer later ones from old files.
    """
    return materialize(items, "items")


def distinct_counts(items: DataFrame) -> DataFrame:
    """Exact distinct products, orders, customers and sellers per month and category.

    Counting shuffles on the counted value as well as the group, so that a hot
    category spreads over all tasks.
    """
    return items.groupBy(*KEYS).agg(*[F.count_distinct(c).alias(name) for name, c in DISTINCT_COUNTS.items()])


def monthly_category_aggregate(
    items: DataFrame, cfg: FeatureConfig = DEFAULT_CONFIG, with_counts: bool = True
) -> DataFrame:
    """Demand, sales, payment, review and delivery measures per month and category.

    Partial aggregation reduces a hot category to one row per task before the
    shuffle. The exact distinct counts are a second, narrow aggregation: in one
    aggregation with the measures, every wide row would be repeated once per
    counted column. Both read the same kept rows, so the joins before them run
    once, and come out partitioned by the keys, so joining them needs no shuffle.
    ``with_counts`` False leaves the distinct counts out and stores nothing.
    """
    shares = [f"pct_{t}" for t in PAYMENT_TYPES] + [f"review_pct_{k}" for k in REVIEW_SCORES]
    keyed = items.filter(F.col(MONTH).isNotNull() & F.col(CATEGORY).isNotNull())
    exact = with_counts and not cfg.approx_distinct
    if exact:
        read = [*KEYS, *MEASURED, *DISTINCT_COUNTS.values(), *shares]
        keyed = kept_rows(keyed.select(*[c for c in dict.fromkeys(read) if c in keyed.columns]))
    sketches = [F.approx_count_distinct(c).alias(name) for name, c in DISTINCT_COUNTS.items()]
    measures = keyed.groupBy(*KEYS).agg(
        F.count("product_id").alias("demand"),
        *(sketches if with_counts and cfg.approx_distinct else []),
        F.sum("price").alias("total_sales"),
        F.avg("price").alias("avg_price"),
        F.stddev_samp("price").alias("price_std"),
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
        F.sum("freight_value").alias("total_freight"),
        F.avg("freight_value").alias("avg_freight"),
        F.sum("payment_total").alias("total_payments"),
        F.avg("payment_total").alias("avg_payment"),
        F.avg("payment_avg").alias("payment_avg_mean"),
        F.avg("payment_count").alias("payment_count_mean"),
        F.avg("installments_avg").alias("installments_avg_mean"),
        F.avg("review_score_mean").alias("avg_review_score"),
        F.sum("review_count").alias("review_count_sum"),
        F.avg("delivery_time_days").alias("avg_delivery_time_days"),
        F.stddev_samp("delivery_time_days").alias("delivery_time_days_std"),
        F.avg("delivery_delay").alias("avg_delivery_delay"),
        F.avg("is_delayed").alias("pct_delayed_orders"),
        *[F.avg(c).alias(f"{c}_mean") for c in shares if c in items.columns],
    )
    if not exact:
        return measures
    return measures.join(distinct_counts(keyed), list(KEYS), "left")


def monthly_demand(items: DataFrame, weight: str | None = None) -> DataFrame:
    """Units, value, freight and orders per month and category.

    ``weight`` names the column holding how often an item row is repeated by
    the star join (see ``operators.star``).
    """
    times = F.col(weight) if weight else F.lit(1)
    keyed = items.filter(F.col(MONTH).isNotNull() & F.col(CATEGORY).isNotNull())
    return keyed.groupBy(*KEYS).agg(
        F.coalesce(F.sum(F.when(F.col("product_id").isNotNull(), times)), F.lit(0)).alias("monthly_demand_units"),
        F.coalesce(F.sum(F.col("price") * times), F.lit(0.0)).alias("monthly_demand_value"),
        F.coalesce(F.sum(F.col("freight_value") * times), F.lit(0.0)).alias("monthly_freight_value"),
        F.count_distinct("order_id").alias("monthly_orders_count"),
    )
