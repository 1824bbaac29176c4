"""Aggregates over the star join from repeat counts, against the joined rows themselves."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandloom.operators import aggregates, cleaning, profile, star
from demandloom.session import materialize
from demandloom.sources import views

T = dt.datetime(2017, 5, 10, 12)


@pytest.fixture(scope="module")
def sources(spark):
    orders = [
        ("hot", "c1", "delivered", T, T + dt.timedelta(days=3), T),
        ("hot", "c1", "delivered", T, T + dt.timedelta(days=3), T),  # a copy doubles the star rows
        ("two", "c2", "delivered", T, T + dt.timedelta(days=9), T + dt.timedelta(days=10)),
        ("bare", "c3", "delivered", T, None, None),
        ("open", "c4", "shipped", T, None, T),
    ]
    items = [("hot", i % 7, f"p{i % 3}", f"s{i % 2}", float(i % 11), float(i % 5 - 1)) for i in range(60)]
    items += [("two", 1, "p1", "s1", 10.0, 1.0), ("two", 1, "p1", "s1", 10.0, 1.0), ("two", 2, "gone", "s1", 5.0, 1.0)]
    products = [("p0", "Toys"), ("p1", "Home Decor"), ("p2", None)]
    payments = [("hot", n, "voucher", n + 1, float(n)) for n in range(5)] + [("two", 1, "boleto", None, 3.0), ("open", 1, "boleto", 1, None)]
    reviews = [("r1", "hot", 5, "x", "y"), ("r2", "hot", 2, "x", None), ("r3", "bare", None, "x", "y")]
    return {
        "orders": spark.createDataFrame(
            orders,
            "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
            "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
        ),
        "items": spark.createDataFrame(
            items, "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double"
        ),
        "products": spark.createDataFrame(products, "product_id string, product_category_name string"),
        "payments": spark.createDataFrame(
            payments,
            "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
        ),
        "reviews": spark.createDataFrame(
            reviews,
            "review_id string, order_id string, review_score int, review_creation_date string, review_answer_timestamp string",
        ),
    }


def joined(sources):
    df = sources["orders"].join(sources["items"], "order_id", "left").join(sources["products"], "product_id", "left")
    df = df.join(sources["reviews"], "order_id", "left").join(sources["payments"], "order_id", "left")
    return df.withColumn("order_month", F.date_format("order_purchase_timestamp", "yyyy-MM"))


def rows(df, columns):
    def cell(v):
        return round(v, 9) if isinstance(v, float) else v

    return sorted((tuple(cell(r[c]) for c in columns) for r in df.collect()), key=str)


def clean(sources):
    return cleaning.clean_orders(sources["orders"]), cleaning.clean_products(sources["products"], dashes=True)


def test_star_rows(sources):
    want = joined(sources).drop("order_month")
    assert rows(star.star_left_join(sources), want.columns) == rows(want, want.columns)


def test_demand(sources):
    want = aggregates.monthly_demand(joined(sources))
    got = aggregates.monthly_demand(star.star_items(sources), star.WEIGHT)
    assert rows(got, want.columns) == rows(want, want.columns)


def test_quality_of_all_and_clean_rows(sources):
    whole = joined(sources).drop("order_month")
    orders_clean, products_clean = clean(sources)
    kept = cleaning.clean_combined(whole, orders_clean, products_clean)
    want = profile.compare_quality(whole, kept)
    got = star.compare_star_quality(sources, orders_clean, products_clean)
    assert rows(got, want.columns) == rows(want, want.columns)


def test_retention(sources):
    whole = joined(sources)
    orders_clean, products_clean = clean(sources)
    kept = cleaning.clean_combined(whole, orders_clean, products_clean).count()
    report = star.retention_report(sources, orders_clean, products_clean).first()
    assert (report["rows_before"], report["rows_after"]) == (whole.count(), kept)


def test_wide_aggregate(sources):
    orders_clean, products_clean = clean(sources)
    kept = cleaning.clean_combined(joined(sources), orders_clean, products_clean)
    seconds = F.unix_micros(F.col("order_delivered_customer_date").cast("timestamp")) - F.unix_micros(
        F.col("order_purchase_timestamp").cast("timestamp")
    )
    want = kept.filter("product_category_name is not null").groupBy("order_month", "product_category_name").agg(
        F.count("product_id").alias("demand"),
        F.stddev_samp("price").alias("price_std"),
        F.avg("price").alias("avg_price"),
        F.stddev_samp(F.floor(seconds / 86_400_000_000)).alias("delivery_time_days_std"),
        F.sum("payment_value").alias("total_payments"),
        F.avg("payment_value").alias("avg_payment"),
        F.count("payment_value").alias("payment_count"),
        F.avg("payment_installments").alias("installments_avg"),
        F.max("payment_installments").alias("installments_max"),
        F.avg("review_score").alias("avg_review_score"),
    )
    items = star.clean_star_items(sources, orders_clean, products_clean)
    assert rows(star.monthly_aggregate_fanout(items), want.columns) == rows(want, want.columns)


def test_combined_cleaning_before_the_fan_out(sources):
    orders_clean, products_clean = clean(sources)
    want = cleaning.clean_combined(joined(sources).drop("order_month"), orders_clean, products_clean)
    got = star.clean_combined(sources, orders_clean, products_clean)
    assert rows(got, want.columns) == rows(want, want.columns)


def test_entities_without_the_star(sources):
    want = cleaning.decompose_wide(star.star_left_join(sources))
    got = star.star_entities(sources)
    assert set(got) == set(want)
    for name, df in want.items():
        keys = [c for c in df.columns if c in ("order_id", "product_id", "price", "payment_value", "review_score", "order_status")]
        assert rows(got[name], keys) == rows(df, keys), name


def scans(df, column):
    """File scans of the plan that ran; a reused exchange reads nothing again."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    return sum("FileScan" in line and column in line for line in plan.splitlines())


def test_sources_are_read_once_for_rows_and_once_for_counts(spark):
    all_views = views.source_views(spark, "/root/testdata/sf0.001")
    orders_clean, products_clean = clean(all_views)
    whole = star.star_left_join(all_views)
    # the orders file is behind orders, payments and reviews; only the last two are counted
    assert scans(whole, "l_orderkey") <= 2 and scans(whole, "o_orderkey") <= 5
    kept = star.clean_star_items(all_views, orders_clean, products_clean)
    assert scans(kept, "l_orderkey") == 1
    # the joined items are stored once and then aggregated twice
    assert scans(star.monthly_aggregate_fanout(kept), "l_orderkey") == 0


def test_decompose_gives_back_the_clean_tables(sources):
    parts = cleaning.decompose_wide(star.star_left_join(sources))
    assert parts["orders"].count() == 3
    assert rows(parts["payments"], ["order_id", "payment_value"]) == rows(
        cleaning.clean_payments(sources["payments"]), ["order_id", "payment_value"]
    )
    assert set(parts) == {"orders", "items", "products", "payments", "reviews"}
    assert set(cleaning.decompose_wide(sources["products"])) == {"products"}


def test_quality_with_repeated_products_and_null_keys(sources):
    spark = sources["orders"].sparkSession
    products = spark.createDataFrame(
        [("p0", "Toys"), ("p0", "Toys"), ("p0", "Games"), ("p1", None), (None, "Odd"), (None, "Odd")], "product_id string, product_category_name string"
    )
    items = sources["items"].unionByName(
        spark.createDataFrame([("two", 3, None, "s1", None, 1.0), (None, 3, "p0", "s1", 2.0, 1.0)], sources["items"].schema)
    )
    odd = {**sources, "products": products, "items": items}
    whole = joined(odd).drop("order_month")
    orders_clean, products_clean = clean(odd)
    want = profile.compare_quality(whole, cleaning.clean_combined(whole, orders_clean, products_clean))
    got = star.compare_star_quality(odd, orders_clean, products_clean)
    assert rows(got, want.columns) == rows(want, want.columns)
    alone = star.star_quality(odd, "original").unionByName(star.star_quality(odd, "clean", orders_clean, products_clean))
    assert rows(alone, want.columns) == rows(want, want.columns)


def test_quality_reads_the_items_once_without_product_columns(spark):
    all_views = views.source_views(spark, "/root/testdata/sf0.001")
    report = star.compare_star_quality(all_views, *clean(all_views))
    assert scans(report, "l_orderkey") == 1


def test_decomposing_shuffles_each_entity_once(sources):
    wide = materialize(star.star_left_join(sources), "wide")
    for name, part in cleaning.decompose_wide(wide).items():
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Aggregate ") == 1 and "_entity" not in plan, name
