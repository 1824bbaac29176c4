"""Shared SQL fragments of the DuckDB oracles.

Each fragment is an independent statement of a table in plain SQL; ``sql``
puts the ones a query needs in front of it.
"""

from __future__ import annotations

# name -> (names it reads, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def define(name: str, needs: str, body: str) -> None:
    CTES[name] = (tuple(needs.split()), body.strip())


def sql(needs: str, body: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in CTES[name][0]:
                visit(other)
            ordered.append(name)

    for name in needs.split():
        visit(name)
    if not ordered:
        return body.strip()
    parts = ",\n".join(f"{name} AS (\n{CTES[name][1]}\n)" for name in ordered)
    return f"WITH {parts}\n{body.strip()}"


# ---- source tables -------------------------------------------------------

define("f_orders", "", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
  CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24) END AS order_purchase_timestamp,
  o_orderdate + INTERVAL '1' DAY * (o_orderkey % 5 + 1) AS order_delivered_carrier_date,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderdate + INTERVAL '1' HOUR * (o_orderkey * 7 % 1080 + 24) END AS order_delivered_customer_date,
  o_orderdate + INTERVAL '1' DAY * (20 + o_orderkey % 15) AS order_estimated_delivery_date
FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 89 = 0) o
""")

define("f_items", "", """
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
  CASE WHEN l_orderkey % 127 = 0 THEN cast(0 AS DOUBLE) ELSE floor(l_extendedprice) END AS price,
  CASE WHEN l_orderkey % 131 = 0 THEN cast(-1 AS DOUBLE) ELSE floor(l_extendedprice * l_tax) END AS freight_value
FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, floor(l_extendedprice), floor(l_extendedprice * l_tax)
FROM lineitem WHERE l_orderkey % 113 = 0 AND l_orderkey % 127 <> 0 AND l_orderkey % 131 <> 0
""")

define("f_products", "", """
SELECT p_partkey AS product_id,
  CASE WHEN p_partkey % 101 = 0 THEN NULL ELSE concat(p_type, ' ', p_brand) END AS product_category_name,
  CASE WHEN p_partkey % 53 = 0 THEN 'n/a' ELSE cast(p_size * 100 AS VARCHAR) END AS product_weight_g,
  cast(p_size AS VARCHAR) AS product_length_cm,
  cast(p_size % 17 + 1 AS VARCHAR) AS product_height_cm,
  cast(p_size % 11 + 1 AS VARCHAR) AS product_width_cm
FROM part
""")

define("f_payments", "", """
SELECT o_orderkey AS order_id, 1 AS payment_sequential,
  CASE o_orderkey % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'boleto' WHEN 2 THEN 'debit_card' ELSE 'voucher' END AS payment_type,
  o_orderkey % 10 + 1 AS payment_installments,
  CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice * 0.75) ELSE floor(o_totalprice) END AS payment_value
FROM orders
UNION ALL
SELECT o_orderkey, 2, 'voucher', 1, floor(o_totalprice * 0.25) FROM orders WHERE o_orderkey % 3 = 0
""")

define("f_reviews", "", """
SELECT o_orderkey * 10 AS review_id, o_orderkey AS order_id, o_orderkey * 7 % 5 + 1 AS review_score,
  cast(o_orderdate + INTERVAL '30' DAY AS VARCHAR) AS review_creation_date,
  CASE WHEN o_orderkey % 61 = 0 THEN 'bad' ELSE cast(o_orderdate + INTERVAL '32' DAY AS VARCHAR) END AS review_answer_timestamp
FROM orders WHERE o_orderkey % 6 <> 0
UNION ALL
SELECT o_orderkey * 10 + 1, o_orderkey, 1, cast(o_orderdate + INTERVAL '31' DAY AS VARCHAR), 'bad'
FROM orders WHERE o_orderkey % 33 = 1
""")

# ---- cleaned tables ------------------------------------------------------

define("c_orders", "f_orders", """
SELECT order_id, customer_id, order_purchase_timestamp, order_delivered_carrier_date,
  order_delivered_customer_date, order_estimated_delivery_date, order_status
FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY customer_id, order_purchase_timestamp NULLS FIRST) AS rn
  FROM f_orders WHERE order_status = 'delivered'
) WHERE rn = 1 AND order_purchase_timestamp IS NOT NULL
""")

define("c_items", "f_items", """
SELECT DISTINCT * FROM f_items WHERE price > 0 AND freight_value >= 0
""")

define("c_products", "f_products", """
SELECT product_id,
  coalesce(replace(lower(product_category_name), ' ', '_'), 'nan') AS product_category_name,
  TRY_CAST(product_weight_g AS DOUBLE) AS product_weight_g,
  TRY_CAST(product_length_cm AS DOUBLE) AS product_length_cm,
  TRY_CAST(product_height_cm AS DOUBLE) AS product_height_cm,
  TRY_CAST(product_width_cm AS DOUBLE) AS product_width_cm
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY product_category_name NULLS FIRST) AS rn FROM f_products)
WHERE rn = 1
""")

define("c_payments", "f_payments", """
SELECT DISTINCT order_id, payment_sequential, payment_type, payment_installments,
  TRY_CAST(payment_value AS DOUBLE) AS payment_value
FROM f_payments WHERE TRY_CAST(payment_value AS DOUBLE) >= 0
""")

define("c_reviews", "f_reviews", """
SELECT review_id, order_id, TRY_CAST(review_score AS DOUBLE) AS review_score,
  TRY_CAST(review_creation_date AS TIMESTAMP) AS review_creation_date,
  TRY_CAST(review_answer_timestamp AS TIMESTAMP) AS review_answer_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY review_id) AS rn FROM f_reviews)
WHERE rn = 1
""")

# ---- per-order features --------------------------------------------------

define("o_features", "c_orders", """
SELECT *, CASE WHEN delivery_delay > 0 THEN 1 ELSE 0 END AS is_delayed
FROM (
  SELECT *, strftime(order_purchase_timestamp, '%Y-%m') AS order_month,
    CAST(floor((epoch(order_delivered_customer_date) - epoch(order_purchase_timestamp)) / 86400) AS INTEGER) AS delivery_time_days,
    CAST(floor((epoch(order_delivered_customer_date) - epoch(order_estimated_delivery_date)) / 86400) AS INTEGER) AS delivery_delay
  FROM c_orders
)
""")

define("p_features", "c_payments", """
SELECT order_id, sum(payment_value) AS payment_total, avg(payment_value) AS payment_avg, count(payment_value) AS payment_count,
  avg(payment_installments) AS installments_avg, max(payment_installments) AS installments_max,
  CAST(sum(payment_installments) AS BIGINT) AS installments_total,
  avg(CASE WHEN payment_type = 'credit_card' THEN 1.0::DOUBLE ELSE 0 END) AS pct_credit_card,
  avg(CASE WHEN payment_type = 'boleto' THEN 1.0::DOUBLE ELSE 0 END) AS pct_boleto,
  avg(CASE WHEN payment_type = 'voucher' THEN 1.0::DOUBLE ELSE 0 END) AS pct_voucher,
  avg(CASE WHEN payment_type = 'debit_card' THEN 1.0::DOUBLE ELSE 0 END) AS pct_debit_card
FROM c_payments GROUP BY order_id
""")

define("r_features", "c_reviews", """
SELECT order_id, coalesce(avg(review_score), 0) AS review_score_mean, count(review_score) AS review_count,
  avg(CASE WHEN review_score = 1 THEN 1.0::DOUBLE ELSE 0 END) AS review_pct_1,
  avg(CASE WHEN review_score = 2 THEN 1.0::DOUBLE ELSE 0 END) AS review_pct_2,
  avg(CASE WHEN review_score = 3 THEN 1.0::DOUBLE ELSE 0 END) AS review_pct_3,
  avg(CASE WHEN review_score = 4 THEN 1.0::DOUBLE ELSE 0 END) AS review_pct_4,
  avg(CASE WHEN review_score = 5 THEN 1.0::DOUBLE ELSE 0 END) AS review_pct_5
FROM c_reviews GROUP BY order_id
""")

define("item_grain", "c_items c_products o_features p_features r_features", """
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value,
  p.product_category_name, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_delivered_carrier_date,
  o.order_delivered_customer_date, o.order_estimated_delivery_date, o.order_month,
  coalesce(o.delivery_time_days, 0) AS delivery_time_days, coalesce(o.delivery_delay, 0) AS delivery_delay,
  coalesce(o.is_delayed, 0) AS is_delayed,
  coalesce(y.payment_total, 0) AS payment_total, coalesce(y.payment_avg, 0) AS payment_avg,
  coalesce(y.payment_count, 0) AS payment_count, coalesce(y.installments_avg, 0) AS installments_avg,
  coalesce(y.installments_max, 0) AS installments_max, coalesce(y.installments_total, 0) AS installments_total,
  coalesce(y.pct_credit_card, 0) AS pct_credit_card, coalesce(y.pct_boleto, 0) AS pct_boleto,
  coalesce(y.pct_voucher, 0) AS pct_voucher, coalesce(y.pct_debit_card, 0) AS pct_debit_card,
  coalesce(r.review_score_mean, 0) AS review_score_mean, coalesce(r.review_count, 0) AS review_count,
  coalesce(r.review_pct_1, 0) AS review_pct_1, coalesce(r.review_pct_2, 0) AS review_pct_2,
  coalesce(r.review_pct_3, 0) AS review_pct_3, coalesce(r.review_pct_4, 0) AS review_pct_4,
  coalesce(r.review_pct_5, 0) AS review_pct_5
FROM c_items i
LEFT JOIN c_products p ON p.product_id = i.product_id
LEFT JOIN o_features o ON o.order_id = i.order_id
LEFT JOIN p_features y ON y.order_id = i.order_id
LEFT JOIN r_features r ON r.order_id = i.order_id
WHERE o.order_month IS NOT NULL AND p.product_category_name IS NOT NULL
""")

# ---- month x category ----------------------------------------------------

define("monthly", "item_grain", """
SELECT order_month, product_category_name, count(product_id) AS demand,
  count(DISTINCT product_id) AS unique_products, count(DISTINCT order_id) AS unique_orders,
  count(DISTINCT customer_id) AS unique_customers, count(DISTINCT seller_id) AS unique_sellers,
  sum(price) AS total_sales, avg(price) AS avg_price, stddev_samp(price) AS price_std,
  min(price) AS price_min, max(price) AS price_max,
  sum(freight_value) AS total_freight, avg(freight_value) AS avg_freight,
  sum(payment_total) AS total_payments, avg(payment_total) AS avg_payment,
  avg(payment_avg) AS payment_avg_mean, avg(payment_count) AS payment_count_mean,
  avg(installments_avg) AS installments_avg_mean, avg(review_score_mean) AS avg_review_score,
  CAST(sum(review_count) AS BIGINT) AS review_count_sum,
  avg(delivery_time_days) AS avg_delivery_time_days, stddev_samp(delivery_time_days) AS delivery_time_days_std,
  avg(delivery_delay) AS avg_delivery_delay, avg(is_delayed) AS pct_delayed_orders,
  avg(pct_credit_card) AS pct_credit_card_mean, avg(pct_boleto) AS pct_boleto_mean,
  avg(pct_voucher) AS pct_voucher_mean, avg(pct_debit_card) AS pct_debit_card_mean,
  avg(review_pct_1) AS review_pct_1_mean, avg(review_pct_2) AS review_pct_2_mean,
  avg(review_pct_3) AS review_pct_3_mean, avg(review_pct_4) AS review_pct_4_mean,
  avg(review_pct_5) AS review_pct_5_mean
FROM item_grain GROUP BY order_month, product_category_name
""")

define("m", "monthly", """
SELECT *, CAST(order_month || '-01' AS DATE) AS date FROM monthly
""")

define("labelled", "m", """
SELECT * FROM (
  SELECT *, lead(demand) OVER (PARTITION BY product_category_name ORDER BY date) AS demand_next_month FROM m
) WHERE demand_next_month IS NOT NULL
""")

define("numbered", "labelled", """
SELECT *, row_number() OVER (ORDER BY order_month, product_category_name) - 1 AS position,
  count(*) OVER () AS n_all
FROM labelled
""")

define("by_position", "numbered", """
SELECT *, CASE WHEN position < floor(n_all * 0.8) THEN 'train' ELSE 'test' END AS split FROM numbered
""")

define("dated", "labelled", """
SELECT *, CASE WHEN date IN (SELECT DISTINCT date FROM labelled ORDER BY date DESC LIMIT 3) THEN 'test' ELSE 'train' END AS split
FROM labelled
""")

# ---- raw star join and its cleaned rows ----------------------------------

define("star", "f_orders f_items f_products f_reviews f_payments", """
SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_delivered_carrier_date,
  o.order_delivered_customer_date, o.order_estimated_delivery_date,
  i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value,
  p.product_category_name, p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
  r.review_id, r.review_score, r.review_creation_date, r.review_answer_timestamp,
  y.payment_sequential, y.payment_type, y.payment_installments, y.payment_value
FROM f_orders o
LEFT JOIN f_items i ON i.order_id = o.order_id
LEFT JOIN f_products p ON p.product_id = i.product_id
LEFT JOIN f_reviews r ON r.order_id = o.order_id
LEFT JOIN f_payments y ON y.order_id = o.order_id
""")

define("star_clean", "star c_orders c_products", """
SELECT * FROM star
WHERE order_id IN (SELECT order_id FROM c_orders) AND product_id IN (SELECT product_id FROM c_products)
  AND price > 0 AND freight_value >= 0
""")

define("demand_clean", "star_clean", """
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS order_month, product_category_name,
  count(product_id) AS monthly_demand_units, sum(price) AS monthly_demand_value
FROM star_clean
WHERE order_purchase_timestamp IS NOT NULL AND product_category_name IS NOT NULL
GROUP BY 1, 2
""")

define("demand_labelled", "demand_clean", """
SELECT * FROM (
  SELECT *, lead(monthly_demand_units) OVER (PARTITION BY product_category_name ORDER BY order_month) AS demand_next_month
  FROM demand_clean
) WHERE demand_next_month IS NOT NULL
""")
