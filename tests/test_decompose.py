"""The decomposition queries store their entities whole, cleaned values included, and count the stored rows."""

import datetime as dt

import pytest

from demandloom.registry import queries

T = dt.datetime(2017, 5, 10, 12)
DAY = dt.timedelta(days=1)

ORDERS = [
    ("a", "c1", "delivered", T, T + DAY, None, T + 20 * DAY),
    ("a", "c1", "delivered", T, T + DAY, None, T + 20 * DAY),  # a copy
    ("b", "c2", "shipped", T, T + DAY, T + 2 * DAY, T + 20 * DAY),
    ("c", "c3", "delivered", None, T + DAY, T + 2 * DAY, T + 20 * DAY),
    ("d", "c4", "delivered", T, None, T + 3 * DAY, None),
]
ITEMS = [
    ("a", 1, "p1", "s1", 10.0, 1.0),
    ("a", 2, "p1", "s2", 10.0, 1.0),  # the same in the columns of the entity
    ("a", 3, "p2", "s1", 0.0, 1.0),
    ("b", 1, "p2", "s2", 5.0, 2.0),
    ("d", 1, "gone", "s2", 7.0, 0.0),
]
PRODUCTS = [
    ("p1", "Home-Decor X", "100", "7", "n/a", "3"),
    ("p2", None, "x", "8.5", "2", "1"),
    ("unsold", "Toys", "1", "1", "1", "1"),
]
PAYMENTS = [
    ("a", 1, "voucher", 2, "3.5"),
    ("a", 2, "voucher", 2, "3.5"),
    ("a", 3, "boleto", 1, "4"),
    ("b", 1, "boleto", 1, "-1"),
    ("d", 1, None, None, "0"),
    ("d", 2, "boleto", 1, "n/a"),
]
REVIEWS = [
    ("r1", "a", "4", "2018-01-02 00:00:00", "bad"),
    ("r2", "b", "x", "bad", "2018-01-03 10:00:00"),
    ("r3", "d", "5", None, "2018-01-04 00:00:00"),
]

STORED = {
    "orders": [ORDERS[0], ORDERS[4]],
    "items": [("a", "p1", 10.0, 1.0), ("b", "p2", 5.0, 2.0), ("d", "gone", 7.0, 0.0)],
    "products": [
        (None, "nan", None, None, None, None),  # order c has no item
        ("gone", "nan", None, None, None, None),
        ("p1", "home_decor_x", 100.0, 7.0, None, 3.0),
        ("p2", "nan", None, 8.5, 2.0, 1.0),
    ],
    "payments": [("a", 3.5, 2, "voucher"), ("a", 4.0, 1, "boleto"), ("d", 0.0, None, None)],
    "reviews": [
        ("a", 4.0, dt.datetime(2018, 1, 2), None),
        ("b", None, None, dt.datetime(2018, 1, 3, 10)),
        ("c", None, None, None),
        ("d", 5.0, None, dt.datetime(2018, 1, 4)),
    ],
}
COLUMNS = {
    "orders": "order_id customer_id order_status order_purchase_timestamp order_delivered_carrier_date "
    "order_delivered_customer_date order_estimated_delivery_date",
    "items": "order_id product_id price freight_value",
    "products": "product_id product_category_name product_weight_g product_length_cm product_height_cm product_width_cm",
    "payments": "order_id payment_value payment_installments payment_type",
    "reviews": "order_id review_score review_creation_date review_answer_timestamp",
}


@pytest.fixture(scope="module")
def sources(spark):
    texts = "product_category_name string, product_weight_g string, product_length_cm string, product_height_cm string, product_width_cm string"
    return {
        "orders": spark.createDataFrame(
            ORDERS,
            "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
            "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
            "order_estimated_delivery_date timestamp_ntz",
        ),
        "items": spark.createDataFrame(
            ITEMS, "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double"
        ),
        "products": spark.createDataFrame(PRODUCTS, f"product_id string, {texts}"),
        "payments": spark.createDataFrame(
            PAYMENTS,
            "order_id string, payment_sequential int, payment_type string, payment_installments long, payment_value string",
        ),
        "reviews": spark.createDataFrame(
            REVIEWS,
            "review_id string, order_id string, review_score string, review_creation_date string, review_answer_timestamp string",
        ),
    }


@pytest.mark.parametrize("name", ["decompose_wide_table", "decompose_wide"])
def test_entities_are_stored_whole(spark, sources, monkeypatch, name):
    stored = {}

    def recorded(df, label):
        stored[label] = materialize(df, label)
        return stored[label]

    materialize = queries.materialize
    monkeypatch.setattr(queries, "materialize", recorded)
    monkeypatch.setattr(queries.views, "source_views", lambda spark, sf_dir: sources)
    report = queries.QUERIES[name](spark, "unused")

    assert set(stored) - {"wide"} == set(STORED)
    for entity, columns in COLUMNS.items():
        got = stored[entity].select(*columns.split())
        assert len(stored[entity].columns) == len(got.columns), entity
        assert sorted(map(tuple, got.collect()), key=str) == sorted(STORED[entity], key=str), entity
    assert {r["entity"]: (r["n_rows"], r["n_keys"]) for r in report.collect()} == {
        "orders": (2, 2), "items": (3, 3), "products": (4, 3), "payments": (3, 2), "reviews": (4, 4),
    }
