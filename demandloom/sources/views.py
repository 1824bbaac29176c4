"""The five source tables, derived from the star-schema test tables.

Edge cases (repeated rows, nulls, unreadable text) are placed by key modulus.
Money is in whole currency units, so that sums do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.schemas import struct_of

# The columns of the test tables that the views read.
TABLES = {
    "customer": struct_of("c_custkey long"),
    "supplier": struct_of("s_suppkey long"),
    "orders": struct_of(
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
    ),
    "lineitem": struct_of(
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber integer, l_extendedprice double, l_tax double"
    ),
    "part": struct_of("p_partkey long, p_brand string, p_type string, p_size integer"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The known schema saves a pass over the file footers."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _every(key: str, n: int) -> Column:
    return F.pmod(F.col(key), F.lit(n)) == 0


def _repeated(df: DataFrame, twice: Column) -> DataFrame:
    """Each row once, and a second time where the condition holds; one scan."""
    copies = F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("copy", F.explode(copies))


def _after(base: str, **interval: Column) -> Column:
    return F.col(base) + F.make_dt_interval(**interval)


def orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "shipped")
    rows = _repeated(read_table(spark, sf_dir, "orders"), _every("o_orderkey", 89))
    return rows.select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.otherwise("processing").alias("order_status"),
        F.when(~_every("o_orderkey", 211), _after("o_orderdate", hours=(key % 24).cast("int"))).alias(
            "order_purchase_timestamp"
        ),
        _after("o_orderdate", days=(key % 5 + 1).cast("int")).alias("order_delivered_carrier_date"),
        F.when(~_every("o_orderkey", 97), _after("o_orderdate", hours=(key * 7 % 1080 + 24).cast("int"))).alias(
            "order_delivered_customer_date"
        ),
        _after("o_orderdate", days=(key % 15 + 20).cast("int")).alias("order_estimated_delivery_date"),
    )


def items_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    free = _every("l_orderkey", 127)
    faulty = _every("l_orderkey", 131)
    rows = _repeated(
        read_table(spark, sf_dir, "lineitem"), _every("l_orderkey", 113) & ~free & ~faulty
    )
    price = F.floor("l_extendedprice").cast("double")
    freight = F.floor(F.col("l_extendedprice") * F.col("l_tax")).cast("double")
    return rows.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.when(free, 0.0).otherwise(price).alias("price"),
        F.when(faulty, -1.0).otherwise(freight).alias("freight_value"),
    )


def products_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(~_every("p_partkey", 101), F.concat_ws(" ", "p_type", "p_brand")).alias("product_category_name"),
        F.when(_every("p_partkey", 53), "n/a").otherwise((size * 100).cast("string")).alias("product_weight_g"),
        size.cast("string").alias("product_length_cm"),
        (size % 17 + 1).cast("string").alias("product_height_cm"),
        (size % 11 + 1).cast("string").alias("product_width_cm"),
    )


def payments_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order; every third order is split into two parts."""
    in_parts = _every("o_orderkey", 3)
    rows = _repeated(read_table(spark, sf_dir, "orders"), in_parts)
    second = F.col("copy") == 1
    kind = F.element_at(
        F.array(*[F.lit(t) for t in ("credit_card", "boleto", "debit_card", "voucher")]),
        (F.col("o_orderkey") % 4 + 1).cast("int"),
    )
    share = F.when(second, 0.25).when(in_parts, 0.75).otherwise(1.0)
    return rows.select(
        F.col("o_orderkey").alias("order_id"),
        (F.col("copy") + 1).alias("payment_sequential"),
        F.when(second, "voucher").otherwise(kind).alias("payment_type"),
        F.when(second, F.lit(1).cast("long")).otherwise(F.col("o_orderkey") % 10 + 1).alias("payment_installments"),
        F.floor(F.col("o_totalprice") * share).cast("double").alias("payment_value"),
    )


def reviews_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No review for every sixth order, a second one for some, unreadable times for some."""
    key = F.col("o_orderkey")
    first = F.when(~_every("o_orderkey", 6), F.lit(0))
    second = F.when(F.pmod(key, F.lit(33)) == 1, F.lit(1))
    rows = (
        read_table(spark, sf_dir, "orders")
        .withColumn("copy", F.explode(F.array(first, second)))
        .filter(F.col("copy").isNotNull())
    )
    again = F.col("copy") == 1
    answer = _after("o_orderdate", days=F.lit(32)).cast("string")
    return rows.select(
        (key * 10 + F.col("copy")).alias("review_id"),
        key.alias("order_id"),
        F.when(again, F.lit(1).cast("long")).otherwise(key * 7 % 5 + 1).alias("review_score"),
        _after("o_orderdate", days=F.col("copy") + 30).cast("string").alias("review_creation_date"),
        F.when(again | _every("o_orderkey", 61), "bad").otherwise(answer).alias("review_answer_timestamp"),
    )


def source_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": orders_view(spark, sf_dir),
        "items": items_view(spark, sf_dir),
        "products": products_view(spark, sf_dir),
        "payments": payments_view(spark, sf_dir),
        "reviews": reviews_view(spark, sf_dir),
    }


def party_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Customers and sellers, which are loaded but enter no feature."""
    return {
        "customers": read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id")),
        "sellers": read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("seller_id")),
    }
