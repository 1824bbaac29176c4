"""The raw five-table star join, and aggregates over it that never build it.

In the star every item row of an order is repeated once per payment row and
once per review row of that order. ``star_left_join`` produces those rows.
``star_items`` keeps the item rows and carries the repeat counts instead, which
is all a sum, count or mean over the star needs; an order with very many
items, payments and reviews then costs their sum, not their product.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandloom.config import CATEGORY, KEYS, MONTH
from demandloom.functions.scalar import flag, floored_days, month_label, parse_number
from demandloom.functions.tables import join_by_key, left_join_by_key, row_groups
from demandloom.operators.aggregates import DISTINCT_COUNTS, distinct_counts, kept_rows
from demandloom.operators.cleaning import clean_entity
from demandloom.session import materialize

WEIGHT = "repeats"


def star_left_join(sources: dict[str, DataFrame]) -> DataFrame:
    """orders ⟕ items ⟕ products ⟕ reviews ⟕ payments, uncleaned, with the full fan-out.

    The items, the largest table, come last: nothing is shuffled after the join
    that multiplies the rows.
    """
    sold = join_by_key(sources["items"], sources["products"], "product_id", "left")
    reviewed = left_join_by_key(sources["orders"], sources["reviews"], "order_id")
    paid = left_join_by_key(reviewed, sources["payments"], "order_id")
    return left_join_by_key(paid, sold, "order_id", _sold_rows(sources))


def _sold_rows(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows of items ⟕ products per order id, from the items and the few products that come more than once."""
    copies = sources["products"].groupBy("product_id").agg(F.count(F.lit(1)).alias("_copies")).where(F.col("_copies") > 1)
    asked = join_by_key(sources["items"].select("order_id", "product_id"), materialize(copies, "copies"), "product_id", "left")
    return asked.groupBy("order_id").agg(F.sum(F.coalesce("_copies", F.lit(1))).alias("_rows"))


def order_repeats(sources: dict[str, DataFrame]) -> DataFrame:
    """Raw orders with the payment and review totals of each order id."""
    value = parse_number("payment_value")
    score = parse_number("review_score")
    parts = F.col("payment_installments")
    payments = (
        sources["payments"]
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("payment_rows"),
            F.sum(value).alias("payment_sum"),
            F.count(value).alias("payment_values"),
            F.sum(parts).alias("installments_sum"),
            F.max(parts).alias("installments_top"),
            F.count(parts).alias("installments_values"),
        )
    )
    reviews = (
        sources["reviews"]
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("review_rows"),
            F.sum(score).alias("score_sum"),
            F.count(score).alias("score_values"),
        )
    )
    # raw orders may repeat an id very often; the totals have one row per id
    paid = join_by_key(sources["orders"], payments, "order_id", "left")
    joined = join_by_key(paid, reviews, "order_id", "left")
    counted = joined.withColumns(
        {
            "payment_rows": F.greatest(F.coalesce("payment_rows", F.lit(0)), F.lit(1)),
            "review_rows": F.greatest(F.coalesce("review_rows", F.lit(0)), F.lit(1)),
        }
    )
    return counted.withColumn(WEIGHT, F.col("payment_rows") * F.col("review_rows"))


def _joined(items: DataFrame, products: DataFrame, orders: DataFrame, how: str) -> DataFrame:
    timed = orders.withColumn(MONTH, month_label("order_purchase_timestamp"))
    sold = join_by_key(items, products.select("product_id", CATEGORY), "product_id", how)
    return join_by_key(sold, timed, "order_id", "inner")


def star_items(sources: dict[str, DataFrame]) -> DataFrame:
    """Item rows of the star that have an item, each with its repeat count."""
    return _joined(sources["items"], sources["products"], order_repeats(sources), "left")


def _valued(items: DataFrame) -> DataFrame:
    return items.filter((F.col("price") > 0) & (F.col("freight_value") >= 0))


def clean_star_items(
    sources: dict[str, DataFrame], orders_clean: DataFrame, products_clean: DataFrame
) -> DataFrame:
    """The star items that survive the combined cleaning rules.

    Orders and products are reduced to the clean ones first, so the items, the
    largest table, meet each of them in one join.
    """
    orders = join_by_key(order_repeats(sources), orders_clean.select("order_id"), "order_id", "left_semi")
    products = join_by_key(sources["products"], products_clean.select("product_id"), "product_id", "left_semi")
    return _joined(_valued(sources["items"]), products, orders, "inner")


def clean_combined(
    sources: dict[str, DataFrame], orders_clean: DataFrame, products_clean: DataFrame
) -> DataFrame:
    """Rows of the star join with a valid order, a valid product, price and freight.

    Each source is cleaned before the join that multiplies the rows. A row of the
    star without an item has no price and is never among them.
    """
    orders = join_by_key(sources["orders"], orders_clean.select("order_id"), "order_id", "left_semi")
    products = join_by_key(sources["products"], products_clean.select("product_id"), "product_id", "left_semi")
    sold = join_by_key(_valued(sources["items"]), products, "product_id", "inner")
    reviewed = left_join_by_key(orders, sources["reviews"], "order_id")
    paid = left_join_by_key(reviewed, sources["payments"], "order_id")
    return join_by_key(paid, sold, "order_id", "inner")


def star_entities(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What ``cleaning.decompose_wide`` gives for the star join, without building the star.

    Distinct rows survive the fan-out, so each entity comes from its own source,
    reduced to what the star holds: the rows of known orders, the products of their
    items, and rows of nulls where an order or a product has no partner.
    """
    known = sources["orders"].select("order_id").distinct()
    asked = left_join_by_key(known, sources["items"].select("order_id", "product_id"), "order_id")
    parts = {
        "orders": sources["orders"],
        "items": join_by_key(sources["items"], known, "order_id", "left_semi"),
        "products": left_join_by_key(asked.select("product_id").distinct(), sources["products"], "product_id"),
        "payments": join_by_key(sources["payments"], known, "order_id", "left_semi"),
        "reviews": left_join_by_key(known, sources["reviews"], "order_id"),
    }
    return {name: clean_entity(name, df) for name, df in parts.items()}


def retention_report(sources: dict[str, DataFrame], orders_clean: DataFrame, products_clean: DataFrame) -> DataFrame:
    """Rows of the star before and after cleaning, rows removed and percent kept."""
    products_per_id = sources["products"].groupBy("product_id").agg(F.count(F.lit(1)).alias("product_rows"))
    sold = join_by_key(sources["items"], products_per_id, "product_id", "left").withColumn(
        "product_rows", F.coalesce("product_rows", F.lit(1))
    )
    per_order = sold.groupBy("order_id").agg(F.sum("product_rows").alias("item_rows"))
    whole = (
        join_by_key(order_repeats(sources), per_order, "order_id", "left")
        .agg(F.sum(F.col(WEIGHT) * F.coalesce("item_rows", F.lit(1))).alias("rows_before"))
    )
    kept = clean_star_items(sources, orders_clean, products_clean).agg(
        F.coalesce(F.sum(WEIGHT), F.lit(0)).alias("rows_after")
    )
    return whole.withColumn("rows_after", kept.scalar()).select(
        "rows_before",
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        (F.col("rows_after") / F.col("rows_before") * 100).alias("pct_kept"),
    )


def _nulls(columns: Sequence[str]) -> Column:
    return sum((F.col(c).isNull().cast("long") for c in columns), F.lit(0))


def _part(df: DataFrame, name: str, key: str = "order_id") -> DataFrame:
    """Rows, distinct rows and nulls of one table per key."""
    copies = F.col("_copies")
    return row_groups(df).groupBy(key).agg(
        F.sum(copies).alias(f"{name}_rows"),
        F.count(F.lit(1)).alias(f"{name}_distinct"),
        F.sum(_nulls([c for c in df.columns if c != key]) * copies).alias(f"{name}_nulls"),
    )


def _sold_part(items: DataFrame, products: DataFrame, products_clean: DataFrame | None) -> DataFrame:
    """Totals of items ⟕ products per order id, and (``clean_*``) of the valued ones with a clean product.

    The rows of an item are its combinations with the rows of its product, so the items meet the
    totals of their product, and neither their own columns nor those of the product are shuffled with them.
    """
    facts = _part(products, "product", "product_id").where(F.col("product_id").isNotNull())
    if products_clean is not None:
        listed = products_clean.select("product_id").where(F.col("product_id").isNotNull()).distinct()
        facts = facts.join(listed.withColumn("_listed", F.lit(True)), "product_id", "full")
    flags = {"bad_prices": F.col("price") <= 0, "bad_freights": F.col("freight_value") < 0}
    valued = (F.col("price") > 0) & (F.col("freight_value") >= 0)
    rows = row_groups(items).select(
        "order_id", "product_id", "_copies", _nulls([c for c in items.columns if c != "order_id"]).cast("int").alias("_nulls"),
        valued.alias("_valued"), *[condition.alias(name) for name, condition in flags.items()],
    )
    met = join_by_key(rows, facts, "product_id", "left")
    partners, variants = F.coalesce("product_rows", F.lit(1)), F.coalesce("product_distinct", F.lit(1))
    absent = F.coalesce("product_nulls", F.lit(len(products.columns) - 1))
    copies = F.col("_copies")
    totals = {
        "rows": copies * partners,
        "distinct": variants,
        "nulls": copies * (F.col("_nulls") * partners + absent),
        **{name: F.when(F.col(name), copies * partners).otherwise(0) for name in flags},
    }
    parts = [F.sum(value).alias(f"items_{what}") for what, value in totals.items()]
    if products_clean is not None:
        kept = F.col("_valued") & F.col("_listed")
        parts += [F.sum(F.when(kept, value)).alias(f"clean_{what}") for what, value in totals.items()]
    return met.groupBy("order_id").agg(*parts)


def _star_counts(
    sources: dict[str, DataFrame],
    names: Sequence[str],
    orders_clean: DataFrame | None = None,
    products_clean: DataFrame | None = None,
) -> DataFrame:
    """``profile.data_quality`` of the star join (the first name) and of its cleaned rows (the second), in one pass.

    The star rows of an order are all combinations of the order's rows in the
    four tables, so their number, their distinct number and their nulls follow
    from those of each table. Nothing larger than the sources is shuffled.
    """
    tables = {n: sources[n] for n in ("orders", "items", "reviews", "payments")}
    joined = _part(tables["orders"], "orders")
    if orders_clean is not None:
        known = orders_clean.select("order_id").distinct().withColumn("_known", F.lit(True))
        joined = joined.join(known, "order_id", "left")
    joined = joined.join(_sold_part(tables["items"], sources["products"], products_clean), "order_id", "left")
    for other in ("reviews", "payments"):
        joined = joined.join(_part(tables[other], other), "order_id", "left")
    # the columns of a row without a partner, which are all null
    width = {n: len(t.columns) - 1 for n, t in tables.items()}
    width["items"] += len(sources["products"].columns) - 1
    every = {"items": F.lit(True), "clean": F.col("_known") & F.col("clean_rows").isNotNull()}

    def combined(sold: str, what: str, replace: str | None = None, by: Column | None = None) -> Column:
        # the product of four counts of a very hot order may pass a long
        result = F.lit(1).cast("decimal(38,0)")
        for table in tables:
            prefix = sold if table == "items" else table
            factor = by if table == replace else F.coalesce(F.col(f"{prefix}_{what}"), F.lit(1).cast("long"))
            result = (result * factor.cast("decimal(20,0)")).cast("decimal(38,0)")
        return result

    def measures(sold: str) -> list[Column]:
        def total(value: Column) -> Column:
            return F.coalesce(F.sum(F.when(every[sold], value)), F.lit(0)).cast("long")

        def nulls_of(table: str) -> Column:
            prefix = sold if table == "items" else table
            return F.coalesce(F.col(f"{prefix}_nulls"), F.lit(width[table]).cast("long"))

        nulls = sum((combined(sold, "rows", t, nulls_of(t)) for t in tables), F.lit(0))
        found = {
            "n_rows": total(combined(sold, "rows")),
            "nulls_total": total(nulls),
            "_distinct": total(combined(sold, "distinct")),
            **{
                name: total(combined(sold, "rows", "items", F.coalesce(F.col(f"{sold}_{c}"), F.lit(0))))
                for name, c in (("invalid_prices", "bad_prices"), ("negative_freights", "bad_freights"))
            },
        }
        return [value.alias(f"{sold}_{name}") for name, value in found.items()]

    kinds = dict(zip(("items", "clean"), names))
    counts = joined.agg(*[m for sold in kinds for m in measures(sold)])
    entries = [
        F.struct(
            F.lit(name).alias("dataset"),
            *[F.col(f"{sold}_{c}").alias(c) for c in ("n_rows", "nulls_total", "_distinct", "invalid_prices", "negative_freights")],
        )
        for sold, name in kinds.items()
    ]
    return counts.select(F.inline(F.array(*entries))).select(
        "dataset",
        "n_rows",
        "nulls_total",
        F.try_divide(F.col("nulls_total") * 100, F.col("n_rows") * (sum(width.values()) + 1)).alias("nulls_pct"),
        (F.col("n_rows") - F.col("_distinct")).alias("duplicate_rows"),
        "invalid_prices",
        "negative_freights",
    )


def star_quality(
    sources: dict[str, DataFrame],
    name: str,
    orders_clean: DataFrame | None = None,
    products_clean: DataFrame | None = None,
) -> DataFrame:
    """``profile.data_quality`` of the star join, or of its cleaned rows; for both see ``compare_star_quality``."""
    if orders_clean is None or products_clean is None:
        return _star_counts(sources, (name,))
    both = _star_counts(sources, ("", name), orders_clean, products_clean)
    return both.where(F.col("dataset") == name)


def compare_star_quality(
    sources: dict[str, DataFrame], orders_clean: DataFrame, products_clean: DataFrame
) -> DataFrame:
    """The report of all star rows and that of the cleaned ones, from one pass over the sources."""
    return _star_counts(sources, ("original", "clean"), orders_clean, products_clean)


# Measures whose deviation over the repeated rows is wanted: prefix -> column.
SPREAD = {"price": "price", "days": "delivery_time_days"}


def _summaries() -> list[Column]:
    """Weight, mean and variance of each spread measure inside one repeat count."""
    return [
        column
        for name, c in SPREAD.items()
        for column in (
            (F.count(c) * F.col(WEIGHT)).alias(f"{name}_n"),
            F.avg(c).alias(f"{name}_mean"),
            F.var_pop(c).alias(f"{name}_var"),
        )
    ]


def _centres() -> dict[str, Column]:
    """Common mean of the summaries of a month and category."""
    group = Window.partitionBy(*KEYS)
    return {
        f"{name}_centre": F.try_divide(
            F.sum(F.col(f"{name}_n") * F.col(f"{name}_mean")).over(group), F.sum(f"{name}_n").over(group)
        )
        for name in SPREAD
    }


def _merged_std(name: str) -> Column:
    """Sample deviation from the summaries: variance within plus distance of the means."""
    size = F.sum(f"{name}_n")
    within = F.sum(F.col(f"{name}_n") * F.col(f"{name}_var"))
    between = F.sum(F.col(f"{name}_n") * F.pow(F.col(f"{name}_mean") - F.col(f"{name}_centre"), 2))
    return F.when(size > 1, F.sqrt((within + F.coalesce(between, F.lit(0.0))) / (size - 1)))


def monthly_aggregate_fanout(items: DataFrame) -> DataFrame:
    """The wide monthly aggregate as the star join would give it, from ``star_items`` rows.

    Items are summarised per month, category and repeat count with Spark's own
    stable variance; the few summaries of a month and category are then merged
    around their common mean.
    """
    timed = items.withColumns(
        {
            "delivery_time_days": floored_days("order_delivered_customer_date", "order_purchase_timestamp"),
            "delivery_delay": floored_days("order_delivered_customer_date", "order_estimated_delivery_date"),
        }
    ).withColumn("is_delayed", flag(F.col("delivery_delay") > 0))
    read = [*KEYS, WEIGHT, "review_rows", "payment_rows", "price", "freight_value", "delivery_time_days", "delivery_delay",
            "is_delayed", "payment_sum", "payment_values", "installments_sum", "installments_values", "installments_top",
            "score_sum", "score_values", *DISTINCT_COUNTS.values()]
    timed = kept_rows(timed.filter(F.col(MONTH).isNotNull() & F.col(CATEGORY).isNotNull()).select(*read))

    times, by_review, by_payment = F.col(WEIGHT), F.col("review_rows"), F.col("payment_rows")
    # mean -> (sum over the repeated rows, number of repeated rows with a value)
    means = {
        name: (F.col(c) * times, F.when(F.col(c).isNotNull(), times))
        for name, c in {
            "avg_price": "price",
            "avg_freight": "freight_value",
            "avg_delivery_time_days": "delivery_time_days",
            "avg_delivery_delay": "delivery_delay",
            "pct_delayed_orders": "is_delayed",
        }.items()
    }
    means["avg_payment"] = (F.col("payment_sum") * by_review, F.col("payment_values") * by_review)
    means["installments_avg"] = (F.col("installments_sum") * by_review, F.col("installments_values") * by_review)
    means["avg_review_score"] = (F.col("score_sum") * by_payment, F.col("score_values") * by_payment)

    summaries = timed.groupBy(*KEYS, WEIGHT).agg(
        (F.count("product_id") * F.col(WEIGHT)).alias("demand"),
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
        F.max("installments_top").alias("installments_max"),
        *[F.sum(total).alias(f"{name}_total") for name, (total, _) in means.items()],
        *[F.sum(weight).alias(f"{name}_weight") for name, (_, weight) in means.items()],
        *_summaries(),
    )
    merged = (
        summaries.withColumns(_centres())
        .groupBy(*KEYS)
        .agg(
            F.sum("demand").alias("demand"),
            F.min("price_min").alias("price_min"),
            F.max("price_max").alias("price_max"),
            F.max("installments_max").alias("installments_max"),
            *[F.try_divide(F.sum(f"{name}_total"), F.sum(f"{name}_weight")).alias(name) for name in means],
            F.sum("avg_price_total").alias("total_sales"),
            F.sum("avg_freight_total").alias("total_freight"),
            F.coalesce(F.sum("avg_payment_total"), F.lit(0.0)).alias("total_payments"),
            F.coalesce(F.sum("avg_payment_weight"), F.lit(0)).alias("payment_count"),
            F.coalesce(F.sum("installments_avg_total"), F.lit(0)).alias("installments_total"),
            _merged_std("price").alias("price_std"),
            _merged_std("days").alias("delivery_time_days_std"),
        )
    )
    return merged.join(distinct_counts(timed), list(KEYS), "left")
