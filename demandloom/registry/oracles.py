"""DuckDB statements of the registered queries."""

from __future__ import annotations

from demandloom.registry.ctes import define, sql
from demandloom.schemas import SCHEMAS
from demandloom.sources.quarantine import LATTICE

W = "PARTITION BY product_category_name ORDER BY date"
KEYS = "order_month, product_category_name"
ORACLES: dict[str, str] = {}


def rnd(expression: str, digits: int) -> str:
    return f"round({expression}, {digits}) + 0.0"


def lag(c: str, n: int) -> str:
    return f"lag({c}, {n}) OVER ({W})"


def prev(function: str, rows: int) -> str:
    return f"{function} OVER ({W} ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING)"


def full(expression: str, c: str, rows: int) -> str:
    return f"CASE WHEN {prev(f'count({c})', rows)} = {rows} THEN {expression} END"


def growth(c: str, n: int) -> str:
    return f"{c} / nullif({lag(c, n)}, 0) - 1"


def diff(c: str, n: int) -> str:
    return f"{c} - {lag(c, n)}"


def variation(c: str, rows: int) -> str:
    return full(f"{prev(f'stddev_samp({c})', rows)} / ({prev(f'avg({c})', rows)} + 1e-8::DOUBLE)", c, rows)


# ---- feature families: column -> (expression, digits) --------------------

MEASURES = {
    "demand": "demand", "sales": "total_sales", "price": "avg_price",
    "review": "avg_review_score", "delivery": "avg_delivery_time_days",
}
MOVING = {"ma": "demand", "sales_ma": "total_sales", "price_ma": "avg_price", "review_ma": "avg_review_score"}
MONTH_NAMES = "january february march april may june july august september october november december".split()

FAMILIES: dict[str, dict[str, tuple[str, int | None]]] = {
    "demand_next_month": {"demand_next_month": (f"lead(demand) OVER ({W})", None)},
    "lag_features": {f"{k}_lag_{n}": (lag(c, n), None) for k, c in MEASURES.items() for n in (1, 2, 3, 6, 12)},
    "moving_averages": {f"{k}_{w}": (prev(f"avg({c})", w), 4) for k, c in MOVING.items() for w in (2, 3, 6, 12)},
    "rolling_std": {
        f"{k}_std_{w}": (prev(f"stddev_samp({c})", w), 4)
        for k, c in (("demand", "demand"), ("price", "avg_price")) for w in (3, 6, 12)
    },
    "rolling_min_max": {
        f"demand_{f}_{w}": (prev(f"{f}(demand)", w), None) for f in ("min", "max") for w in (3, 6, 12)
    },
    "growth_rates": {
        "demand_growth_1m": (growth("demand", 1), None),
        "demand_growth_3m": (growth("demand", 3), None),
        "demand_growth_12m": (growth("demand", 12), None),
        "sales_growth_1m": (growth("total_sales", 1), None),
        "price_growth_1m": (growth("avg_price", 1), None),
    },
    "momentum": {
        "demand_momentum_3m": (diff("demand", 3), None),
        "demand_momentum_12m": (diff("demand", 12), None),
        "sales_momentum_3m": (diff("total_sales", 3), None),
    },
    "seasonality": {
        "seasonal_ratio_12m": (f"demand / {lag('demand', 12)}", None),
        "seasonal_difference_12m": (diff("demand", 12), None),
    },
    "volatility": {
        "demand_volatility_6m": (variation("demand", 6), 6),
        "price_volatility_6m": (variation("avg_price", 6), 6),
    },
    "trend": {"demand_trend_3m": (f"({diff('demand', 3)}) / 3", None)},
    "yoy_growth": {
        "yoy_demand_growth": (growth("demand", 12), None),
        "yoy_sales_growth": (growth("total_sales", 12), None),
        "yoy_price_growth": (growth("avg_price", 12), None),
    },
    "mom_growth": {
        "mom_demand_growth": (growth("demand", 1), None),
        "mom_sales_growth": (growth("total_sales", 1), None),
    },
    "cumulative_12m": {
        "cumulative_demand_year": (f"CAST(sum(demand) OVER ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS BIGINT)", None),
        "cumulative_sales_year": (f"sum(total_sales) OVER ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)", None),
    },
    "rolling_skew": {"demand_skew_12m": (full(f"coalesce({prev('skewness(demand)', 12)}, 0)", "demand", 12), 6)},
    "rolling_quantiles": {
        "demand_percentile_25_12m": (full(prev("quantile_cont(demand, 0.25)", 12), "demand", 12), None),
        "demand_percentile_75_12m": (full(prev("quantile_cont(demand, 0.75)", 12), "demand", 12), None),
        "demand_iqr_12m": (
            full(f"{prev('quantile_cont(demand, 0.75)', 12)} - {prev('quantile_cont(demand, 0.25)', 12)}", "demand", 12),
            None,
        ),
    },
    "rolling_cv": {"demand_cv_12m": (variation("demand", 12), 6)},
}


def columns(family: dict[str, tuple[str, int | None]], rounding: bool = True) -> str:
    return ",\n  ".join(
        f"{e if d is None or not rounding else rnd(e, d)} AS {name}" for name, (e, d) in family.items()
    )


for _name, _family in FAMILIES.items():
    ORACLES[_name] = sql("m", f"SELECT {KEYS},\n  {columns(_family)}\nFROM m")

define("ema", "m", """
SELECT a.order_month, a.product_category_name,
  sum(b.demand * pow(0.7::DOUBLE, a.rn - 1 - b.rn)) / sum(pow(0.7::DOUBLE, a.rn - 1 - b.rn)) AS ema_0_3,
  sum(b.demand * pow(0.5::DOUBLE, a.rn - 1 - b.rn)) / sum(pow(0.5::DOUBLE, a.rn - 1 - b.rn)) AS ema_0_5,
  sum(b.demand * pow(0.3::DOUBLE, a.rn - 1 - b.rn)) / sum(pow(0.3::DOUBLE, a.rn - 1 - b.rn)) AS ema_0_7
FROM (SELECT *, row_number() OVER (PARTITION BY product_category_name ORDER BY date) AS rn FROM m) a
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY product_category_name ORDER BY date) AS rn FROM m) b
  ON a.product_category_name = b.product_category_name AND b.rn < a.rn
GROUP BY 1, 2
""")
ORACLES["ema_features"] = sql("ema", f"""
SELECT {KEYS}, {rnd('ema_0_3', 6)} AS ema_0_3, {rnd('ema_0_5', 6)} AS ema_0_5, {rnd('ema_0_7', 6)} AS ema_0_7 FROM ema
""")

ORACLES["acceleration"] = sql("m", f"""
SELECT {KEYS}, g - lag(g) OVER ({W}) AS demand_acceleration
FROM (SELECT {KEYS}, date, {growth('demand', 1)} AS g FROM m)
""")

ORACLES["group_size_guard"] = sql("m", f"""
SELECT {KEYS},
  CASE WHEN n >= 3 THEN {diff('demand', 1)} END AS change_1m_from_3,
  CASE WHEN n >= 6 THEN {diff('demand', 3)} END AS change_3m_from_6,
  CASE WHEN n >= 13 THEN {diff('demand', 6)} END AS change_6m_from_13
FROM (SELECT *, count(*) OVER (PARTITION BY product_category_name) AS n FROM m)
""")

# ---- calendar, ratios, category ------------------------------------------

CALENDAR = {
    "date": "date",
    "year": "CAST(year(date) AS INTEGER)",
    "month_num": "CAST(month(date) AS INTEGER)",
    "quarter": "CAST(quarter(date) AS INTEGER)",
    "is_holiday_season": "CASE WHEN month(date) IN (11, 12) THEN 1 ELSE 0 END",
    "is_beginning_year": "CASE WHEN month(date) IN (1, 2) THEN 1 ELSE 0 END",
    "is_mid_year": "CASE WHEN month(date) IN (6, 7) THEN 1 ELSE 0 END",
    "is_end_quarter": "CASE WHEN month(date) % 3 = 0 THEN 1 ELSE 0 END",
}
DUMMIES = {
    **{f"is_{n}": f"CASE WHEN month(date) = {i} THEN 1 ELSE 0 END" for i, n in enumerate(MONTH_NAMES, 1)},
    **{f"is_quarter_{q}": f"CASE WHEN quarter(date) = {q} THEN 1 ELSE 0 END" for q in range(1, 5)},
}
CYCLES = {
    f"{unit}_{wave}": f"{wave}(2 * pi() * {unit}(date) / {size})"
    for unit, size in (("month", 12), ("quarter", 4)) for wave in ("sin", "cos")
}
RATIOS = {
    "sales_per_order": "total_sales / (unique_orders + 1)",
    "items_per_order": "demand / (unique_orders + 1)",
    "avg_order_value": "total_sales / (unique_orders + 1)",
    "conversion_rate": "unique_orders / (unique_customers + 1)",
    "price_to_freight_ratio": "avg_price / (avg_freight + 1)",
    "freight_to_sales_ratio": "total_freight / (total_sales + 1)",
    "profit_margin_estimate": "(avg_price - avg_freight) / (avg_price + 1)",
    "customer_loyalty_index": "unique_orders / (unique_customers + 1)",
    "seller_concentration": "unique_orders / (unique_sellers + 1)",
    "product_diversity_index": "unique_products / (demand + 1)",
    "avg_items_per_product": "demand / (unique_products + 1)",
    "on_time_delivery_rate": "1 - pct_delayed_orders",
    "delivery_efficiency": "avg_delivery_time_days / (abs(avg_delivery_delay) + 1)",
    "avg_installments_per_order": "installments_avg_mean",
    "credit_card_usage_ratio": "pct_credit_card_mean / (pct_boleto_mean + 0.01::DOUBLE)",
    "review_sentiment_score": "review_pct_5_mean - review_pct_1_mean",
    "review_engagement_rate": "review_count_sum / (unique_orders + 1)",
}


def plain(items: dict[str, str], digits: int | None = None) -> str:
    return ",\n  ".join(f"{e if digits is None else rnd(e, digits)} AS {n}" for n, e in items.items())


ORACLES["calendar_features"] = sql("m", f"SELECT {KEYS},\n  {plain(CALENDAR)}\nFROM m")
ORACLES["calendar_dummies"] = sql("m", f"SELECT {KEYS},\n  {plain(DUMMIES)}\nFROM m")
ORACLES["cyclical_features"] = sql("m", f"SELECT {KEYS},\n  {plain(CYCLES, 8)}\nFROM m")
ORACLES["business_ratios"] = sql("monthly", f"SELECT {KEYS},\n  {plain(RATIOS)}\nFROM monthly")

define("cat", "monthly", """
SELECT product_category_name, avg(demand) AS category_avg_demand, stddev_samp(demand) AS category_std_demand,
  median(demand) AS category_median_demand, max(demand) AS category_max_demand,
  avg(avg_price) AS category_avg_price, stddev_samp(avg_price) AS category_std_price,
  avg(avg_review_score) AS category_avg_review
FROM monthly GROUP BY product_category_name
""")
STATS_ROUNDED = f"""category_avg_demand, {rnd('category_std_demand', 4)} AS category_std_demand, category_median_demand,
  category_max_demand, {rnd('category_avg_price', 4)} AS category_avg_price,
  {rnd('category_std_price', 4)} AS category_std_price, {rnd('category_avg_review', 4)} AS category_avg_review"""
RELATIVE = {
    "demand_vs_category_avg": "demand / (category_avg_demand + 1e-8::DOUBLE)",
    "price_vs_category_avg": "avg_price / (category_avg_price + 1e-8::DOUBLE)",
    "review_vs_category_avg": "avg_review_score / (category_avg_review + 1e-8::DOUBLE)",
    "demand_z_score": "(demand - category_avg_demand) / (category_std_demand + 1e-8::DOUBLE)",
    "price_z_score": "(avg_price - category_avg_price) / (category_std_price + 1e-8::DOUBLE)",
}
ORACLES["category_stats"] = sql("cat", f"SELECT product_category_name, {STATS_ROUNDED} FROM cat")
ORACLES["category_features"] = sql("monthly cat", f"""
SELECT order_month, m.product_category_name AS product_category_name,
  {plain(RELATIVE, 6)}
FROM monthly m JOIN cat USING (product_category_name)
""")

_SO_FAR = f"OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
define("cat_as_of", "m", f"""
SELECT *, avg(demand) {_SO_FAR} AS category_avg_demand, stddev_samp(demand) {_SO_FAR} AS category_std_demand,
  median(demand) {_SO_FAR} AS category_median_demand, max(demand) {_SO_FAR} AS category_max_demand,
  avg(avg_price) {_SO_FAR} AS category_avg_price, stddev_samp(avg_price) {_SO_FAR} AS category_std_price,
  avg(avg_review_score) {_SO_FAR} AS category_avg_review
FROM m
""")
ORACLES["category_features_as_of"] = sql("cat_as_of", f"""
SELECT {KEYS}, category_median_demand, category_max_demand, {rnd('category_avg_demand', 4)} AS category_avg_demand,
  {rnd('category_std_demand', 4)} AS category_std_demand, {rnd('category_avg_price', 4)} AS category_avg_price,
  {rnd('category_std_price', 4)} AS category_std_price, {rnd('category_avg_review', 4)} AS category_avg_review,
  {plain(RELATIVE, 6)}
FROM cat_as_of
""")

# ---- sources and sinks ---------------------------------------------------

ORACLES["scan_sources"] = sql("f_orders f_items f_products f_payments f_reviews", """
SELECT 'orders' AS table_name, count(*) AS n_rows FROM f_orders
UNION ALL SELECT 'items', count(*) FROM f_items
UNION ALL SELECT 'products', count(*) FROM f_products
UNION ALL SELECT 'payments', count(*) FROM f_payments
UNION ALL SELECT 'reviews', count(*) FROM f_reviews
UNION ALL SELECT 'customers', count(*) FROM customer
UNION ALL SELECT 'sellers', count(*) FROM supplier
""")
ORACLES["scan_reviews_csv"] = sql("f_reviews", """
SELECT *, concat('good, very ""nice"", "said" by ', order_id, chr(10), chr(10), 'product, again') AS review_comment FROM f_reviews
""")
ORACLES["scan_orders_typed"] = sql("f_orders", "SELECT * FROM f_orders")
ORACLES["scan_tolerant"] = """
SELECT 'found' AS source, count(*) AS n_rows FROM lineitem UNION ALL SELECT 'absent', 0
"""
_product_fields = "product_weight_g, ',', product_length_cm, ',', product_height_cm, ',', product_width_cm"
ORACLES["scan_rejects"] = sql("f_products f_reviews", f"""
SELECT 'products' AS table_name, 'product_weight_g' AS column_name, product_weight_g AS raw, 'no double' AS reason, true AS in_folder
FROM f_products WHERE product_id % 59 <> 0 AND product_weight_g = 'n/a'
UNION ALL
SELECT 'products', NULL, concat(product_id, ',"', coalesce(product_category_name, ''), ',', {_product_fields}),
  'fields do not match the header', true
FROM f_products WHERE product_id % 59 = 0
UNION ALL
SELECT 'products', NULL, CAST(count(*) AS VARCHAR), 'rows kept', true FROM f_products WHERE product_id % 59 <> 0
UNION ALL
SELECT 'reviews', 'review_answer_timestamp', review_answer_timestamp, 'no timestamp_ntz', true
FROM f_reviews WHERE review_answer_timestamp = 'bad'
UNION ALL
SELECT 'reviews', NULL, CAST(count(*) AS VARCHAR), 'rows kept', true FROM f_reviews
""")
_text_tables = {
    **{t: f"f_{t}" for t in ("orders", "items", "products", "payments", "reviews")},
    "customers": "(SELECT c_custkey AS customer_id FROM customer)", "sellers": "(SELECT s_suppkey AS seller_id FROM supplier)",
}


def _inferred(table: str, source: str) -> str:
    parts = []
    for f in SCHEMAS[table]:
        cases = " ".join(f"WHEN count(*) FILTER (regexp_full_match(v, '{pattern}')) = count(v) THEN '{kind}'" for kind, pattern in LATTICE.items())
        parts.append(f"""
SELECT '{table}' AS table_name, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS declared,
  CASE WHEN count(v) = 0 THEN 'string' {cases} ELSE 'string' END AS inferred, count(v) AS n_values
FROM (SELECT nullif(trim(CAST({f.name} AS VARCHAR)), '') AS v FROM {source})""")
    return "\nUNION ALL".join(parts)


ORACLES["infer_types"] = sql("f_orders f_items f_products f_payments f_reviews", """
SELECT *, declared = 'string' OR (inferred = 'bigint' AND declared IN ('bigint', 'int', 'double'))
  OR (inferred = 'double' AND declared = 'double') OR (inferred = 'timestamp' AND declared = 'timestamp_ntz') AS fits
FROM (""" + "\nUNION ALL".join(_inferred(t, s) for t, s in _text_tables.items()) + "\n)")
ORACLES["sink_roundtrip"] = sql("monthly", f"SELECT {KEYS}, demand, total_sales, avg_price FROM monthly")
ORACLES["snapshot_write"] = sql("monthly", """
SELECT 'backup' AS snapshot, count(*) AS n_rows, CAST(sum(demand) AS BIGINT) AS demand FROM monthly
UNION ALL
SELECT 'newest', count(*), CAST(sum(demand) AS BIGINT) FROM (
  SELECT demand FROM monthly
  UNION ALL
  SELECT arg_max(demand, order_month) FROM monthly GROUP BY product_category_name
)
""")

# ---- cleaning ------------------------------------------------------------

for _table in ("orders", "items", "products", "payments", "reviews"):
    ORACLES[f"clean_{_table}"] = sql(f"c_{_table}", f"SELECT * FROM c_{_table}")

ORACLES["normalize_category"] = sql("f_products", """
SELECT product_id, coalesce(replace(lower(product_category_name), ' ', '_'), 'nan') AS category,
  coalesce(replace(replace(lower(product_category_name), ' ', '_'), '-', '_'), 'nan') AS category_without_dashes
FROM f_products
""")
ORACLES["fill_numeric_nulls"] = sql("o_features", """
SELECT order_id, coalesce(delivery_time_days, 0) AS delivery_time_days, coalesce(delivery_delay, 0) AS delivery_delay,
  is_delayed
FROM o_features
""")
_cleaned = {**FAMILIES["growth_rates"], **FAMILIES["seasonality"]}
ORACLES["final_clean"] = sql("m", f"""
SELECT {KEYS}, demand, demand_next_month, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _cleaned)}
FROM (SELECT {KEYS}, demand, lead(demand) OVER ({W}) AS demand_next_month, {columns(_cleaned)} FROM m)
WHERE demand_next_month IS NOT NULL
""")
_review_columns = ["order_id", "review_score_mean", "review_count"] + [f"review_pct_{k}" for k in range(1, 6)]
ORACLES["default_columns"] = sql("f_products", """
SELECT product_id, product_length_cm, 'unknown_category' AS product_category_name,
  0 AS delivery_delay, 0.0::DOUBLE AS pct_boleto
FROM f_products
""")
ORACLES["decompose_wide"] = sql("star", """
SELECT 'orders' AS entity, count(*) AS n_rows, count(DISTINCT order_id) AS n_keys FROM (
  SELECT DISTINCT order_id FROM star WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL)
UNION ALL
SELECT 'items', count(*), count(DISTINCT order_id) FROM (
  SELECT DISTINCT order_id, product_id, price, freight_value FROM star WHERE price > 0 AND freight_value >= 0)
UNION ALL
SELECT 'products', count(*), count(product_id) FROM (SELECT DISTINCT product_id FROM star)
UNION ALL
SELECT 'payments', count(*), count(DISTINCT order_id) FROM (
  SELECT DISTINCT order_id, payment_value, payment_installments, payment_type FROM star WHERE payment_value >= 0)
UNION ALL
SELECT 'reviews', count(*), count(order_id) FROM (SELECT DISTINCT order_id FROM star)
""")
ORACLES["decompose_wide_table"] = ORACLES["decompose_wide"]
ORACLES["clean_combined"] = sql("star_clean", """
SELECT order_id, order_item_id, product_id, seller_id, price, freight_value, review_id, payment_sequential, payment_value
FROM star_clean
""")
ORACLES["retention_report"] = sql("star_clean", """
SELECT b AS rows_before, a AS rows_after, b - a AS rows_removed, a / b * 100 AS pct_kept
FROM (SELECT (SELECT count(*) FROM star) AS b, (SELECT count(*) FROM star_clean) AS a)
""")

# ---- joins ---------------------------------------------------------------

ORACLES["items_with_category"] = sql("c_items c_products", """
SELECT i.*, p.product_category_name FROM c_items i LEFT JOIN c_products p ON p.product_id = i.product_id
""")
ORACLES["lookup_category"] = ORACLES["items_with_category"]
ORACLES["item_grain_join"] = sql("item_grain", "SELECT * FROM item_grain")
ORACLES["star_left_join"] = sql("star", "SELECT * FROM star")
ORACLES["semi_join_valid_orders"] = sql("f_items c_orders", """
SELECT * FROM f_items WHERE order_id IN (SELECT order_id FROM c_orders)
""")
ORACLES["top_category_series"] = sql("demand_labelled", """
SELECT * FROM demand_labelled WHERE product_category_name IN (
  SELECT product_category_name FROM demand_labelled GROUP BY 1 ORDER BY count(*) DESC, product_category_name LIMIT 6)
""")
_new_categories = """
SELECT DISTINCT product_category_name FROM by_category WHERE position >= floor(n_all * 0.8)
  AND product_category_name NOT IN (SELECT product_category_name FROM by_category WHERE position < floor(n_all * 0.8))
"""
define("by_category", "labelled", """
SELECT *, row_number() OVER (ORDER BY product_category_name, date) - 1 AS position, count(*) OVER () AS n_all FROM labelled
""")
ORACLES["new_categories_anti"] = sql("by_category", _new_categories)
ORACLES["new_categories_except"] = ORACLES["new_categories_anti"]
ORACLES["future_month_scaffold"] = sql("m", """
SELECT strftime(d, '%Y-%m') AS order_month, product_category_name, CAST(d AS DATE) AS date
FROM (SELECT DISTINCT product_category_name FROM m),
  (SELECT (SELECT max(date) FROM m) + INTERVAL '1' MONTH * n AS d FROM (VALUES (1), (2), (3)) v(n))
""")

# ---- aggregations --------------------------------------------------------

ORACLES["order_base_features"] = sql("o_features", """
SELECT order_id, order_month, delivery_time_days, delivery_delay, is_delayed FROM o_features
""")
ORACLES["payment_features"] = sql("p_features", "SELECT * FROM p_features")
ORACLES["payment_type_pivot"] = sql("p_features", """
SELECT order_id, pct_credit_card, pct_boleto, pct_voucher, pct_debit_card FROM p_features
""")
ORACLES["payment_type_pivot_all"] = sql("f_payments", "SELECT order_id,\n" + ",\n".join(
    f"  avg(CASE WHEN kind = '{t}' THEN 1.0::DOUBLE ELSE 0 END) AS pct_{t.lower().replace(' ', '_')}"
    for t in ("credit_card", "boleto", "voucher", "debit_card", "Gift Card")
) + """
FROM (
  SELECT DISTINCT order_id, payment_sequential, payment_installments, payment_value,
    CASE WHEN order_id % 7 = 0 AND payment_sequential = 1 THEN 'Gift Card' ELSE payment_type END AS kind
  FROM f_payments WHERE payment_value >= 0
) GROUP BY order_id
""")
ORACLES["review_features"] = sql("r_features", "SELECT * FROM r_features")
ORACLES["monthly_category_agg"] = sql("monthly", f"""
SELECT * REPLACE ({rnd('price_std', 4)} AS price_std, {rnd('delivery_time_days_std', 4)} AS delivery_time_days_std)
FROM monthly
""")
ORACLES["monthly_state_merge"] = ORACLES["monthly_category_agg"]
ORACLES["monthly_demand"] = sql("star", """
SELECT *, lead(monthly_demand_units) OVER (PARTITION BY product_category_name ORDER BY order_month) AS demand_next_month
FROM (
  SELECT strftime(order_purchase_timestamp, '%Y-%m') AS order_month, product_category_name,
    count(product_id) AS monthly_demand_units, sum(price) AS monthly_demand_value,
    sum(freight_value) AS monthly_freight_value, count(DISTINCT order_id) AS monthly_orders_count
  FROM star
  WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL AND product_category_name IS NOT NULL
  GROUP BY 1, 2
)
""")
ORACLES["monthly_demand_clean"] = sql("demand_clean", "SELECT * FROM demand_clean")
ORACLES["monthly_agg_fanout"] = sql("star_clean", f"""
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS order_month, product_category_name,
  count(product_id) AS demand, count(DISTINCT product_id) AS unique_products, count(DISTINCT order_id) AS unique_orders,
  count(DISTINCT customer_id) AS unique_customers, count(DISTINCT seller_id) AS unique_sellers,
  sum(price) AS total_sales, avg(price) AS avg_price, {rnd('stddev_samp(price)', 4)} AS price_std,
  min(price) AS price_min, max(price) AS price_max, sum(freight_value) AS total_freight, avg(freight_value) AS avg_freight,
  avg(d) AS avg_delivery_time_days, {rnd('stddev_samp(d)', 4)} AS delivery_time_days_std,
  avg(late) AS avg_delivery_delay, avg(CASE WHEN late > 0 THEN 1 ELSE 0 END) AS pct_delayed_orders,
  coalesce(sum(payment_value), 0) AS total_payments, avg(payment_value) AS avg_payment, count(payment_value) AS payment_count,
  avg(payment_installments) AS installments_avg, max(payment_installments) AS installments_max,
  CAST(coalesce(sum(payment_installments), 0) AS BIGINT) AS installments_total, avg(review_score) AS avg_review_score
FROM (
  SELECT *, floor((epoch(order_delivered_customer_date) - epoch(order_purchase_timestamp)) / 86400) AS d,
    floor((epoch(order_delivered_customer_date) - epoch(order_estimated_delivery_date)) / 86400) AS late
  FROM star_clean
)
WHERE product_category_name IS NOT NULL AND order_purchase_timestamp IS NOT NULL
GROUP BY 1, 2
""")
ORACLES["category_profile"] = sql("demand_labelled", f"""
SELECT product_category_name, count(monthly_demand_units) AS units_count, {rnd('avg(monthly_demand_units)', 2)} AS units_mean,
  {rnd('stddev_samp(monthly_demand_units)', 2)} AS units_std, {rnd('avg(demand_next_month)', 2)} AS target_mean,
  {rnd('stddev_samp(demand_next_month)', 2)} AS target_std
FROM demand_labelled GROUP BY 1
""")
ORACLES["categories_over_12_months"] = sql("demand_labelled", """
SELECT product_category_name, count(*) AS n_rows FROM demand_labelled GROUP BY 1 HAVING count(*) > 12
""")
ORACLES["category_value_counts"] = sql("demand_labelled", """
SELECT product_category_name, count(*) AS n_rows FROM demand_labelled GROUP BY 1
""")
define("demand_target", "demand_clean", """
SELECT *, lead(monthly_demand_units) OVER (PARTITION BY product_category_name ORDER BY order_month) AS demand_next_month
FROM demand_clean
""")
ORACLES["target_completeness"] = sql("demand_target", """
SELECT count(*) AS n_rows, count(demand_next_month) AS n_with_target, count(demand_next_month) * 100 / count(*) AS pct_complete
FROM demand_target
""")
_star_columns = (
    "order_id customer_id order_status order_purchase_timestamp order_delivered_carrier_date order_delivered_customer_date "
    "order_estimated_delivery_date order_item_id product_id seller_id price freight_value product_category_name "
    "product_weight_g product_length_cm product_height_cm product_width_cm review_id review_score review_creation_date "
    "review_answer_timestamp payment_sequential payment_type payment_installments payment_value"
).split()


def quality(table: str, name: str) -> str:
    nulls = " + ".join(f"count(*) - count({c})" for c in _star_columns)
    return f"""
SELECT '{name}' AS dataset, count(*) AS n_rows, {nulls} AS nulls_total,
  ({nulls}) * 100 / (count(*) * {len(_star_columns)}) AS nulls_pct,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {table})) AS duplicate_rows,
  count(*) FILTER (WHERE price <= 0) AS invalid_prices, count(*) FILTER (WHERE freight_value < 0) AS negative_freights
FROM {table}"""


ORACLES["data_quality"] = sql("star_clean", quality("star", "original") + "\nUNION ALL" + quality("star_clean", "clean"))
ORACLES["validate_table"] = sql("f_items", """
SELECT 'items' AS dataset, count(*) AS n_rows, 6::BIGINT AS n_columns,
  CAST(sum(CASE WHEN order_id IS NULL OR price IS NULL OR freight_value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls_total,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM f_items)) AS duplicate_rows
FROM f_items
""")
ORACLES["null_counts"] = sql("f_orders", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM f_orders" for c in _star_columns[:7]
))
ORACLES["key_uniqueness"] = sql("f_orders c_orders c_products", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS dataset, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys, count(*) = count(DISTINCT {k}) AS is_unique FROM {t}"
    for n, t, k in (
        ("orders_raw", "f_orders", "order_id"), ("orders_clean", "c_orders", "order_id"),
        ("products_clean", "c_products", "product_id"),
    )
))
ORACLES["period_range"] = sql("demand_clean", """
SELECT min(order_month) AS first_period, max(order_month) AS last_period FROM demand_clean
""")
ORACLES["distinct_counts"] = sql("demand_labelled", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM demand_labelled"
    for c in ("order_month", "product_category_name", "demand_next_month")
))
ORACLES["predicate_counts"] = sql("f_items", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE price > 0) AS valid_prices,
  count(*) FILTER (WHERE freight_value >= 0) AS valid_freights
FROM f_items
""")
ORACLES["demand_by_month"] = sql("demand_labelled", """
SELECT order_month, CAST(sum(monthly_demand_units) AS BIGINT) AS total_demand FROM demand_labelled GROUP BY 1
""")
for _n, _alias, _e in (
    ("count", "n_rows", "count(*)"),
    ("mean", "mean_demand", "avg(monthly_demand_units)"),
    ("sum", "total_demand", "CAST(sum(monthly_demand_units) AS BIGINT)"),
):
    ORACLES[f"top_categories_by_{_n}"] = sql("demand_labelled", f"""
SELECT product_category_name, {_e} AS {_alias} FROM demand_labelled
GROUP BY 1 ORDER BY {_alias} DESC, product_category_name LIMIT 10
""")


def bins(c: str, n: int) -> str:
    return f"""
SELECT '{c}' AS measure, b.bin AS bin, {rnd(f'lo + (hi - lo) / {n} * (b.bin - 1)', 4)} AS bin_start,
  count(v.bin) AS n_rows, {n} AS bins
FROM (SELECT unnest(range(1, {n + 1})) AS bin) b
CROSS JOIN (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM demand_labelled) e
LEFT JOIN (
  SELECT least(CAST(floor(({c} - lo) * {n} / (hi - lo)) AS BIGINT) + 1, {n}) AS bin
  FROM demand_labelled, (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM demand_labelled)
) v ON v.bin = b.bin
GROUP BY b.bin, lo, hi"""


ORACLES["demand_histogram"] = sql("demand_labelled", "\nUNION ALL\n".join(
    bins(c, n) for c in ("monthly_demand_units", "demand_next_month") for n in (30, 50)
))
ORACLES["split_distribution"] = sql("dated", f"""
SELECT split, avg(demand) AS demand_mean, {rnd('stddev_samp(demand)', 4)} AS demand_std,
  avg(demand_next_month) AS target_mean, {rnd('stddev_samp(demand_next_month)', 4)} AS target_std
FROM dated GROUP BY split
""")
define("all_dated", "m", f"""
SELECT *, lead(demand) OVER ({W}) AS demand_next_month,
  CASE WHEN date IN (SELECT DISTINCT date FROM m ORDER BY date DESC LIMIT 3) THEN 'test' ELSE 'train' END AS split
FROM m
""")
ORACLES["split_completeness"] = sql("all_dated", """
SELECT split, count(*) AS n_rows, count(demand_next_month) AS n_with_target,
  count(demand_next_month) * 100 / count(*) AS pct_complete
FROM all_dated GROUP BY split
""")

# ---- rows picked by order ------------------------------------------------

ORACLES["latest_per_category"] = sql("monthly", f"""
SELECT {KEYS}, demand, total_sales FROM monthly
QUALIFY row_number() OVER (PARTITION BY product_category_name ORDER BY order_month DESC) = 1
""")
ORACLES["positional_split"] = sql("by_position", f"SELECT {KEYS}, position, split, demand_next_month FROM by_position")
ORACLES["last_k_months_split"] = sql("dated", f"SELECT {KEYS}, split, demand_next_month FROM dated")
ORACLES["sample_first_category"] = sql("demand_labelled", """
SELECT * FROM demand_labelled WHERE product_category_name = (SELECT min(product_category_name) FROM demand_labelled)
ORDER BY order_month LIMIT 5
""")
ORACLES["sample_labelled"] = sql("demand_labelled", """
SELECT * FROM demand_labelled ORDER BY order_month, product_category_name LIMIT 10
""")
# ---- naive models and metrics --------------------------------------------

define("pos_train", "by_position", "SELECT * FROM by_position WHERE split = 'train'")
define("pos_test", "by_position", "SELECT * FROM by_position WHERE split = 'test'")
define("date_train", "dated", "SELECT * FROM dated WHERE split = 'train'")
define("date_test", "dated", "SELECT * FROM dated WHERE split = 'test'")


def last_of(table: str) -> str:
    return f"(SELECT demand_next_month FROM {table} ORDER BY order_month DESC, product_category_name DESC LIMIT 1)"


def mean_of(table: str) -> str:
    return f"(SELECT avg(demand_next_month) FROM {table})"


def lookup(which: str, value: str, fallback: str) -> str:
    learned = f"SELECT product_category_name, {value} AS v FROM {which}_train GROUP BY 1"
    return f"""
SELECT t.order_month, t.product_category_name, t.demand_next_month, CAST(coalesce(l.v, {fallback}) AS DOUBLE) AS prediction
FROM {which}_test t LEFT JOIN ({learned}) l ON l.product_category_name = t.product_category_name"""


LAST = "arg_max(demand_next_month, order_month)"
define("naive_last_value", "pos_train pos_test", f"""
SELECT {KEYS}, demand_next_month, CAST({last_of('pos_train')} AS DOUBLE) AS prediction FROM pos_test
""")
define("naive_historical_mean", "pos_train pos_test", f"""
SELECT {KEYS}, demand_next_month, {mean_of('pos_train')} AS prediction FROM pos_test
""")
define("naive_by_category", "pos_train pos_test", lookup("pos", LAST, mean_of("pos_train")))
define("forecast_naive_last", "date_train date_test", lookup("date", LAST, last_of("date_train")))
define("forecast_naive_mean", "date_train date_test", lookup("date", "avg(demand_next_month)", mean_of("date_train")))
define("forecast_global_last", "date_train date_test", f"""
SELECT {KEYS}, demand_next_month, CAST({last_of('date_train')} AS DOUBLE) AS prediction FROM date_test
""")
for _n in ("naive_last_value", "naive_historical_mean", "naive_by_category", "forecast_naive_last", "forecast_naive_mean"):
    ORACLES[_n] = sql(_n, f"SELECT * FROM {_n}")
ORACLES["forecast_seasonal_last"] = ORACLES["forecast_naive_last"]

define("forecast_seasonal", "date_train date_test", f"""
SELECT {KEYS}, demand_next_month, CAST(coalesce(season, last_of_category, {last_of('date_train')}) AS DOUBLE) AS prediction
FROM (
  SELECT t.*, (SELECT arg_max(s.demand_next_month, s.date) FROM date_train s
      WHERE s.product_category_name = t.product_category_name AND month(s.date) = month(t.date) AND s.date < t.date) AS season,
    (SELECT {LAST.replace('demand_next_month', 's.demand_next_month').replace('order_month', 's.order_month')} FROM date_train s
      WHERE s.product_category_name = t.product_category_name) AS last_of_category
  FROM date_test t
)
""")
ORACLES["forecast_seasonal"] = sql("forecast_seasonal", "SELECT * FROM forecast_seasonal")
define("naive_stack", "naive_last_value naive_historical_mean naive_by_category", """
SELECT 'naive_last_value' AS model, * FROM naive_last_value
UNION ALL SELECT 'naive_historical_mean', * FROM naive_historical_mean
UNION ALL SELECT 'naive_by_category', * FROM naive_by_category
""")
ORACLES["sanitize_predictions"] = sql("naive_stack", f"""
SELECT {KEYS}, model, demand_next_month,
  {rnd("CASE WHEN demand_next_month % 7 = 4 THEN -prediction - 1 WHEN demand_next_month % 7 > 4 THEN prediction ELSE 0 END", 6)} AS prediction,
  {rnd("CASE WHEN demand_next_month % 7 > 4 THEN prediction ELSE 0 END", 6)} AS clamped
FROM naive_stack
""")
define("forecast_stack", "forecast_naive_last forecast_naive_mean forecast_global_last", """
SELECT 'naive_category_last' AS model, * FROM forecast_naive_last
UNION ALL SELECT 'naive_category_mean', * FROM forecast_naive_mean
UNION ALL SELECT 'naive_global_last', * FROM forecast_global_last
""")


def errors(stack: str) -> str:
    return f"""
SELECT model, avg(abs(demand_next_month - prediction)) AS mae, sqrt(avg(pow(demand_next_month - prediction, 2))) AS rmse,
  CASE WHEN max(ss_tot) = 0 THEN 0 ELSE 1 - sum(pow(demand_next_month - prediction, 2)) / max(ss_tot) END AS r2,
  avg(abs((demand_next_month - prediction) / (demand_next_month + 1e-8::DOUBLE))) * 100 AS mape,
  avg(abs(demand_next_month - prediction)) / max(spread) AS mase
FROM {stack}, (
  SELECT sum(pow(demand_next_month - c, 2)) AS ss_tot, avg(abs(demand_next_month - c)) AS spread
  FROM (SELECT DISTINCT {KEYS}, demand_next_month FROM {stack}), (SELECT avg(demand_next_month) AS c FROM {stack})
)
GROUP BY model"""


_basic = ", ".join(f"{rnd(c, 6)} AS {c}" for c in ("mae", "rmse", "r2"))
_wide = ", ".join(f"{rnd(c, 6)} AS {c}" for c in ("mae", "rmse", "r2", "mape", "mase"))
ORACLES["model_metrics"] = sql("naive_stack", f"SELECT model, {_basic} FROM ({errors('naive_stack')})")
ORACLES["best_model"] = sql("naive_stack", f"""
SELECT model, {_basic} FROM ({errors('naive_stack')}) e ORDER BY e.mae, model LIMIT 1
""")
ORACLES["forecast_metrics"] = sql("forecast_stack", f"""
SELECT model, {_wide}, {rnd('100 - mape', 6)} AS accuracy FROM ({errors('forecast_stack')})
""")
ORACLES["top_errors"] = sql("forecast_stack", f"""
SELECT *, abs(prediction - demand_next_month) AS abs_error FROM forecast_stack WHERE model = 'naive_category_last'
ORDER BY abs_error DESC, {KEYS} LIMIT 3
""")

# ---- end to end ----------------------------------------------------------

_series = {
    name: pair
    for family, members in FAMILIES.items()
    if family != "demand_next_month"
    for name, pair in members.items()
}
_monthly_columns = (
    "demand unique_products unique_orders unique_customers unique_sellers total_sales avg_price price_min price_max "
    "total_freight avg_freight total_payments avg_payment payment_avg_mean payment_count_mean installments_avg_mean "
    "avg_review_score review_count_sum avg_delivery_time_days avg_delivery_delay pct_delayed_orders "
    "pct_credit_card_mean pct_boleto_mean pct_voucher_mean pct_debit_card_mean review_pct_1_mean review_pct_2_mean "
    "review_pct_3_mean review_pct_4_mean review_pct_5_mean"
).split()
define("derived", "m ema cat", f"""
SELECT m.*, ema_0_3, ema_0_5, ema_0_7, cat.* EXCLUDE (product_category_name),
  lead(demand) OVER (PARTITION BY m.product_category_name ORDER BY date) AS demand_next_month,
  {columns(_series, rounding=False).replace('PARTITION BY product_category_name', 'PARTITION BY m.product_category_name')}
FROM m JOIN ema ON ema.order_month = m.order_month AND ema.product_category_name = m.product_category_name
JOIN cat ON cat.product_category_name = m.product_category_name
""")
define("accelerated", "derived", f"""
SELECT *, demand_growth_1m - lag(demand_growth_1m) OVER ({W}) AS demand_acceleration FROM derived
""")


def _filled(name: str, expression: str, digits: int | None) -> str:
    value = f"coalesce({expression}, 0)"
    return f"{value if digits is None else rnd(value, digits)} AS {name}"


ORACLES["feature_table"] = sql("accelerated", "SELECT " + ",\n  ".join([
    KEYS, "demand_next_month", "demand_acceleration_0 AS demand_acceleration", *_monthly_columns,
    *[_filled(c, c, 4) for c in ("price_std", "delivery_time_days_std")],
    plain(CALENDAR), plain(DUMMIES), plain(CYCLES, 6), plain(RATIOS), plain(RELATIVE | {}, 6).replace(
        "category_std_demand", "coalesce(category_std_demand, 0)").replace(
        "category_std_price", "coalesce(category_std_price, 0)"),
    STATS_ROUNDED,
    *[_filled(c, c, 6) for c in ("ema_0_3", "ema_0_5", "ema_0_7")],
    *[_filled(n, n, d) for n, (_, d) in _series.items()],
]).replace("demand_acceleration_0", "coalesce(demand_acceleration, 0)")
    + "\nFROM accelerated WHERE demand_next_month IS NOT NULL")

_appended = """
  SELECT strftime((SELECT max(date) FROM {0}) + INTERVAL '1' MONTH, '%Y-%m') AS order_month, product_category_name,
    CAST((SELECT max(date) FROM {0}) + INTERVAL '1' MONTH AS DATE) AS date, {1}
  FROM {0} QUALIFY row_number() OVER (PARTITION BY product_category_name ORDER BY date DESC) = 1
"""
ORACLES["update_append"] = sql("labelled", f"""
SELECT {KEYS}, date, demand, total_sales, demand_next_month FROM labelled
UNION ALL
{_appended.format('labelled', 'demand, total_sales, demand_next_month')}
""")
define("grown", "m", f"SELECT {KEYS}, date, demand FROM m UNION ALL {_appended.format('m', 'demand')}")
ORACLES["update_recompute"] = sql("grown", f"""
SELECT {KEYS}, demand, demand_next_month, coalesce(demand_lag_1, 0) AS demand_lag_1, coalesce(demand_lag_12, 0) AS demand_lag_12,
  {rnd('coalesce(ma_3, 0)', 4)} AS ma_3, coalesce(demand_growth_1m, 0) AS demand_growth_1m, cumulative_demand_year
FROM (
  SELECT {KEYS}, demand, lead(demand) OVER ({W}) AS demand_next_month, {lag('demand', 1)} AS demand_lag_1,
    {lag('demand', 12)} AS demand_lag_12, {prev('avg(demand)', 3)} AS ma_3, {growth('demand', 1)} AS demand_growth_1m,
    CAST(sum(demand) OVER ({W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_demand_year
  FROM grown
) WHERE demand_next_month IS NOT NULL
""")

ORACLES["update_incremental"] = ORACLES["update_recompute"]
ORACLES["feature_table_incremental"] = ORACLES["feature_table"]

# ---- fitted models: facts about the fits ----------------------------------

# Keys and dates, which are no features.
ORACLES["constant_columns"] = f"""
WITH feature_rows AS ({ORACLES['feature_table']})
SELECT column_name, min(value) AS value FROM (
  UNPIVOT (SELECT CAST(COLUMNS(* EXCLUDE (order_month, product_category_name, date)) AS DOUBLE) FROM feature_rows)
  ON COLUMNS(*) INTO NAME column_name VALUE value
) GROUP BY column_name HAVING min(value) = max(value)
"""
ORACLES["feature_table_default"] = f"""
WITH feature_rows AS ({ORACLES['feature_table']})
SELECT (SELECT count(*) FROM feature_rows) AS n_rows, column_name, min(value) + 0.0 AS lo, max(value) + 0.0 AS hi FROM (
  UNPIVOT (SELECT CAST(COLUMNS(* EXCLUDE (order_month, product_category_name, date)) AS DOUBLE) FROM feature_rows)
  ON COLUMNS(*) INTO NAME column_name VALUE value
) GROUP BY column_name HAVING min(value) <> max(value)
"""
for _n in ("rf_predictions", "lr_predictions", "gbt_predictions", "gbt_l2_predictions"):
    ORACLES[_n] = sql("pos_test", f"SELECT {KEYS}, demand_next_month, true AS is_finite, true AS fit_holds FROM pos_test")
_models = ("naive_last_value", "naive_historical_mean", "naive_by_category", "linear_regression")


def _scored(models: tuple[str, ...], more: str = "") -> str:
    return "\nUNION ALL\n".join(f"SELECT '{m}' AS model, 'ok' AS status, true AS is_scored{more}" for m in models)


ORACLES["train_from_table"] = _scored(_models)
ORACLES["train_and_score"] = _scored((*_models, "gradient_boosting"), ", true AS latest_is_best")
ORACLES["model_persist"] = sql("labelled", f"SELECT {KEYS}, demand_next_month, true AS is_same FROM labelled")
ORACLES["retrain"] = sql("labelled", """
SELECT count(*) + count(DISTINCT product_category_name) AS n_rows, count(DISTINCT product_category_name) AS n_categories,
  strftime(max(date) + INTERVAL '1' MONTH, '%Y-%m') AS last_month, CAST(2 AS BIGINT) AS n_versions, CAST(4 AS BIGINT) AS n_models,
  true AS latest_is_best
FROM labelled
""")
ORACLES["read_or_compute"] = sql("labelled", """
SELECT call, count(*) AS n_rows, CAST(sum(demand_next_month) AS BIGINT) AS target FROM labelled, (VALUES (1), (2)) c(call) GROUP BY call
""")
