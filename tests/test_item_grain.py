"""What the joins of the item rows shuffle, and that the rows come out as before."""

from pyspark.sql import functions as F

from demandloom.config import CATEGORY
from demandloom.functions.tables import join_by_key
from demandloom.operators import orders
from tests.test_skew import SMALL_SPLITS, final_plan, settings


def small_tables(spark):
    items = spark.createDataFrame(
        [(1, 1, 10, 5, 2.0, 1.0), (1, 2, 11, 5, 3.0, 0.0), (2, 1, 10, 6, 4.0, 1.0), (3, 1, 12, 6, 5.0, 1.0), (4, 1, 10, 5, 6.0, 1.0),
         (9, 1, 10, 5, 7.0, 1.0), (None, 1, 10, 5, 8.0, 1.0), (2, 2, None, 5, 9.0, 1.0), (2, 3, 99, 5, 9.0, 1.0)],
        "order_id long, order_item_id int, product_id long, seller_id long, price double, freight_value double",
    )
    products = spark.createDataFrame([(10, "a"), (11, "b"), (12, None)], f"product_id long, {CATEGORY} string")
    dated = spark.createDataFrame(
        [(1, 100, "2020-01", 3), (2, 101, "2020-02", None), (3, 102, "2020-02", 4), (4, 103, None, 5)],
        "order_id long, customer_id long, order_month string, delivery_time_days long",
    )
    payments = spark.createDataFrame([(1, 12.0)], "order_id long, payment_total double")
    reviews = spark.createDataFrame([(2, 4.0)], "order_id long, review_score_mean double")
    return items, products, dated, payments, reviews


def test_item_grain_keeps_rows_and_columns_and_drops_items_by_order_first(spark):
    found = orders.item_grain(*small_tables(spark))
    assert found.columns == [
        "order_id", "product_id", "order_item_id", "seller_id", "price", "freight_value", CATEGORY,
        "customer_id", "order_month", "delivery_time_days", "payment_total", "review_score_mean",
    ]
    assert sorted(map(tuple, found.collect())) == [
        (1, 10, 1, 5, 2.0, 1.0, "a", 100, "2020-01", 3, 12.0, 0.0),
        (1, 11, 2, 5, 3.0, 0.0, "b", 100, "2020-01", 3, 12.0, 0.0),
        (2, 10, 1, 6, 4.0, 1.0, "a", 101, "2020-02", 0, 0.0, 4.0),
    ]
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert "product_id" in joins[0] and "order_id" in joins[1]  # the upper join first


def test_added_join_key_is_one_bit(spark):
    left = spark.range(0, 1000).select((F.col("id") % 97).alias("k"), F.col("id").alias("v"))
    right = spark.range(0, 90).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    with settings(spark, **SMALL_SPLITS):
        joined = join_by_key(left, right, "k")
        plan = final_plan(joined)
    assert "pmod(xxhash64(" in plan and "hashpartitioning(k" in plan
    assert joined.columns == ["k", "v", "w"] and joined.count() == sum(1 for i in range(1000) if i % 97 < 90)
