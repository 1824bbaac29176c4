"""Business ratios of the monthly aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _per(numerator: str, denominator: str) -> Column:
    """Ratio with one added to the divisor, so that it is never zero."""
    return F.col(numerator) / (F.col(denominator) + 1)


# Ratio name -> (numerator, divisor before the added one).
PER_UNIT = {
    "sales_per_order": ("total_sales", "unique_orders"),
    "items_per_order": ("demand", "unique_orders"),
    "avg_order_value": ("total_sales", "unique_orders"),
    "conversion_rate": ("unique_orders", "unique_customers"),
    "price_to_freight_ratio": ("avg_price", "avg_freight"),
    "freight_to_sales_ratio": ("total_freight", "total_sales"),
    "customer_loyalty_index": ("unique_orders", "unique_customers"),
    "seller_concentration": ("unique_orders", "unique_sellers"),
    "product_diversity_index": ("unique_products", "demand"),
    "avg_items_per_product": ("demand", "unique_products"),
    "review_engagement_rate": ("review_count_sum", "unique_orders"),
}


def business_ratios(df: DataFrame) -> DataFrame:
    """Seventeen ratios; those whose inputs are missing from the table are left out."""
    columns = {name: _per(*pair) for name, pair in PER_UNIT.items() if set(pair) <= set(df.columns)}
    special = {
        "profit_margin_estimate": (
            {"avg_price", "avg_freight"},
            lambda: (F.col("avg_price") - F.col("avg_freight")) / (F.col("avg_price") + 1),
        ),
        "on_time_delivery_rate": ({"pct_delayed_orders"}, lambda: 1 - F.col("pct_delayed_orders")),
        "delivery_efficiency": (
            {"avg_delivery_time_days", "avg_delivery_delay"},
            lambda: F.col("avg_delivery_time_days") / (F.abs("avg_delivery_delay") + 1),
        ),
        "avg_installments_per_order": ({"installments_avg_mean"}, lambda: F.col("installments_avg_mean")),
        "credit_card_usage_ratio": (
            {"pct_credit_card_mean", "pct_boleto_mean"},
            lambda: F.col("pct_credit_card_mean") / (F.col("pct_boleto_mean") + 0.01),
        ),
        "review_sentiment_score": (
            {"review_pct_5_mean", "review_pct_1_mean"},
            lambda: F.col("review_pct_5_mean") - F.col("review_pct_1_mean"),
        ),
    }
    for name, (needed, build) in special.items():
        if needed <= set(df.columns):
            columns[name] = build()
    return df.withColumns(columns)
