"""Explicit schemas of the five source tables (no inference pass over the files)."""

from __future__ import annotations

from pyspark.sql import types as T


def struct_of(spec: str) -> T.StructType:
    """Nullable fields from ``name type, name type`` (needs no running session)."""
    schema = T.StructType()
    for part in spec.split(","):
        name, kind = part.split()
        schema = schema.add(name, kind.lower())
    return schema


# Columns of the source files. Values that need a tolerant parse
# arrive as strings and are converted by the cleaning operators.
SCHEMAS = {
    "orders": struct_of(
        "order_id STRING, customer_id STRING, order_status STRING, "
        "order_purchase_timestamp TIMESTAMP_NTZ, order_delivered_carrier_date TIMESTAMP_NTZ, "
        "order_delivered_customer_date TIMESTAMP_NTZ, order_estimated_delivery_date TIMESTAMP_NTZ"
    ),
    "items": struct_of(
        "order_id STRING, order_item_id INTEGER, product_id STRING, seller_id STRING, "
        "price DOUBLE, freight_value DOUBLE"
    ),
    "products": struct_of(
        "product_id STRING, product_category_name STRING, product_weight_g STRING, "
        "product_length_cm STRING, product_height_cm STRING, product_width_cm STRING"
    ),
    "payments": struct_of(
        "order_id STRING, payment_sequential INTEGER, payment_type STRING, "
        "payment_installments LONG, payment_value STRING"
    ),
    "reviews": struct_of(
        "review_id STRING, order_id STRING, review_score STRING, "
        "review_creation_date STRING, review_answer_timestamp STRING"
    ),
    "customers": struct_of("customer_id STRING"),
    "sellers": struct_of("seller_id STRING"),
}

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def with_id_type(schema: T.StructType, id_type: T.DataType) -> T.StructType:
    """The same schema with another type for every ``*_id`` key (item numbers stay as they are)."""
    return T.StructType(
        [
            T.StructField(f.name, id_type if f.name.endswith("_id") and f.name != "order_item_id" else f.dataType)
            for f in schema
        ]
    )
