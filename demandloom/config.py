"""Settings shared by the feature, split and model operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FeatureConfig:
    # Lags, windows, decay rates, seed and split sizes of the feature contract.
    lags: tuple[int, ...] = (1, 2, 3, 6, 12)
    moving_windows: tuple[int, ...] = (2, 3, 6, 12)
    stat_windows: tuple[int, ...] = (3, 6, 12)
    ema_alphas: tuple[float, ...] = (0.3, 0.5, 0.7)
    year_months: int = 12
    volatility_window: int = 6
    seed: int = 42
    test_fraction: float = 0.2
    holdout_months: int = 3
    # Swap the four exact distinct counts of the monthly aggregate for sketches.
    approx_distinct: bool = False


DEFAULT_CONFIG = FeatureConfig()

# Column names and category values of the source tables.
CATEGORY = "product_category_name"
MONTH = "order_month"
DATE = "date"
TARGET = "demand_next_month"
KEYS = (MONTH, CATEGORY)
NON_FEATURES = ("order_month", "product_category_name", "date", "month_year", "demand_next_month")
ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_purchase_timestamp",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "order_status",
)
DIMENSION_COLUMNS = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")
REVIEW_SCORES = (1, 2, 3, 4, 5)
