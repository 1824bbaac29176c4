import datetime as dt

from demandloom.operators import cleaning, orders

T = dt.datetime(2017, 5, 10, 12)
ORDER = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
    "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_orders(spark):
    df = spark.createDataFrame(
        [
            ("a", "c1", "delivered", T, T, T),
            ("a", "c1", "delivered", T, T, T),
            ("b", "c2", "shipped", T, T, T),
            ("c", "c3", "delivered", None, T, T),
            ("a", "c1", "canceled", T, T, T),
        ],
        ORDER,
    )
    clean = cleaning.clean_orders(df)
    assert [r["order_id"] for r in clean.collect()] == ["a"]
    assert "order_delivered_carrier_date" not in clean.columns


def test_items_drop_copies_and_invalid_values(spark):
    df = spark.createDataFrame(
        [("a", "p", 1.0, 0.0), ("a", "p", 1.0, 0.0), ("a", "p", 0.0, 1.0), ("a", "p", 2.0, -1.0), ("a", "p", None, 1.0)],
        "order_id string, product_id string, price double, freight_value double",
    )
    assert rows(cleaning.clean_items(df)) == [("a", "p", 1.0, 0.0)]


def test_reviews_keep_the_lowest_id(spark):
    df = spark.createDataFrame(
        [("r2", "a", "5", "2018-01-01 00:00:00", "bad"), ("r1", "a", "x", "2018-01-02 00:00:00", "2018-01-03 00:00:00")],
        "review_id string, order_id string, review_score string, review_creation_date string, review_answer_timestamp string",
    )
    row = cleaning.clean_reviews(df).first()
    assert (row["review_id"], row["review_score"], row["review_answer_timestamp"]) == ("r1", None, dt.datetime(2018, 1, 3))


def test_payment_features(spark):
    df = spark.createDataFrame(
        [
            ("a", "credit_card", 3, "10.5"),
            ("a", "credit_card", 3, "10.5"),
            ("a", "gift", 1, "4.5"),
            ("b", "boleto", 1, "n/a"),
            ("c", None, 2, "1"),
            ("d", "voucher", 1, "-3"),
        ],
        "order_id string, payment_type string, payment_installments long, payment_value string",
    )
    features = {r["order_id"]: r for r in orders.payment_features(cleaning.clean_payments(df)).collect()}
    assert set(features) == {"a", "c"}  # unreadable and negative values are gone
    a = features["a"]
    assert (a["payment_total"], a["payment_avg"], a["payment_count"]) == (15.0, 7.5, 2)
    assert (a["installments_avg"], a["installments_max"], a["installments_total"]) == (2.0, 3, 4)
    assert (a["pct_credit_card"], a["pct_boleto"]) == (0.5, 0.0)  # the unlisted type counts in the divisor
    assert features["c"]["pct_voucher"] is None


def test_review_features_fill_zero(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 1.0), ("b", None)], "order_id string, review_score double")
    features = {r["order_id"]: r for r in orders.review_features(df).collect()}
    assert (features["a"]["review_score_mean"], features["a"]["review_count"], features["a"]["review_pct_5"]) == (3.0, 2, 0.5)
    assert (features["b"]["review_score_mean"], features["b"]["review_count"], features["b"]["review_pct_5"]) == (0.0, 0, 0.0)


def test_order_features(spark):
    df = spark.createDataFrame(
        [
            ("late", "c", "delivered", T, T + dt.timedelta(days=9, hours=1), T + dt.timedelta(days=5)),
            ("early", "c", "delivered", T, T + dt.timedelta(days=2, hours=23), T + dt.timedelta(days=5)),
            ("open", "c", "delivered", T, None, T),
        ],
        ORDER,
    )
    got = {r["order_id"]: r for r in orders.order_base_features(df).collect()}
    pick = ("order_month", "delivery_time_days", "delivery_delay", "is_delayed")
    assert tuple(got["late"][c] for c in pick) == ("2017-05", 9, 4, 1)
    assert tuple(got["early"][c] for c in pick) == ("2017-05", 2, -3, 0)
    assert tuple(got["open"][c] for c in pick) == ("2017-05", None, None, 0)
    plain = orders.order_base_features(df.drop("order_estimated_delivery_date")).first()
    assert (plain["delivery_delay"], plain["is_delayed"]) == (0, 0)
