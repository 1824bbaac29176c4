"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Values whose last digits depend on the order of floating-point sums are rounded
here, never in the operators.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.config import CATEGORY, DATE, KEYS, MONTH, TARGET
from demandloom.functions import series as fs
from demandloom.functions.scalar import clamp_non_negative, finite_or_zero, normalize_category
from demandloom.functions.tables import fill_numeric_nulls, with_defaults, zero_unusable
from demandloom.operators import (
    aggregates,
    boosting,
    calendar,
    category,
    cleaning,
    final,
    metrics,
    models,
    monthly_state,
    naive,
    orders,
    profile,
    ratios,
    series,
    split,
    star,
    update,
)
from demandloom.plans import features, incremental, training
from demandloom.schemas import SCHEMAS, struct_of, with_id_type
from demandloom.session import materialize, scratch_path
from demandloom.sources import files, quarantine, views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def rounded(df: DataFrame, digits: int, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- shared inputs -------------------------------------------------------


def _clean(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return cleaning.clean_all(views.source_views(spark, sf_dir))


def _item_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.build_item_grain(_clean(spark, sf_dir))


def _monthly(spark: SparkSession, sf_dir: str, with_counts: bool = False) -> DataFrame:
    return features.monthly_table(views.source_views(spark, sf_dir), with_counts=with_counts)


def _series_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.with_date(_monthly(spark, sf_dir))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return final.final_clean(_series_input(spark, sf_dir).withColumns(series.target()))


def _stored(table: DataFrame) -> DataFrame:
    """The small monthly table, written once because the query reads it several times."""
    return materialize(table, "monthly")


def _star_clean_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = views.source_views(spark, sf_dir)
    return star.clean_star_items(
        sources,
        cleaning.clean_orders(sources["orders"]),
        cleaning.clean_products(sources["products"], dashes=True),
    )


def _demand_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.monthly_demand(_star_clean_items(spark, sf_dir), star.WEIGHT).select(
        *KEYS, "monthly_demand_units", "monthly_demand_value"
    )


def _with_target(demand: DataFrame) -> DataFrame:
    nxt = F.lead("monthly_demand_units", 1).over(fs.Window.partitionBy(CATEGORY).orderBy(MONTH))
    return demand.withColumn(TARGET, nxt)


def _demand_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_target(_demand_clean(spark, sf_dir)).filter(F.col(TARGET).isNotNull())


def _family(columns: dict, digits: int | None = None, skip: tuple[str, ...] = ()) -> Query:
    """The keys of the monthly table and one family of series columns."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _series_input(spark, sf_dir).withColumns(columns()).select(*KEYS, *columns())
        if digits is None:
            return df
        return rounded(df, digits, [c for c in df.columns if c not in KEYS and c not in skip])

    return run


# ---- sources and sinks ---------------------------------------------------


def _as_csv(spark: SparkSession, df: DataFrame, name: str, base: str) -> None:
    """The table as ``base/name.csv``, times as the source files have them."""
    stamped = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c, t in df.dtypes if t == "timestamp_ntz"}
    files.write_csv(df.withColumns(stamped) if stamped else df, f"{base}/{name}.csv")


@query
def scan_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven tables, written as CSV and read as the jobs read them."""
    base = scratch_path(spark, "sources-csv")
    for name, df in {**views.source_views(spark, sf_dir), **views.party_views(spark, sf_dir)}.items():
        _as_csv(spark, df, name, base)
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name, df in files.load_sources(spark, base).items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


@query
def scan_orders_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "orders-csv")
    raw = views.orders_view(spark, sf_dir)
    _as_csv(spark, raw, "orders", base)
    schema = with_id_type(SCHEMAS["orders"], raw.schema["order_id"].dataType)
    return files.scan_csv(spark, f"{base}/orders.csv", schema)


@query
def scan_reviews_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with a comment that holds commas, quotes and line ends, through CSV and back."""
    base = scratch_path(spark, "reviews-csv")
    comment = F.concat(F.lit('good, very ""nice"", "said" by '), F.col("order_id").cast("string"), F.lit("\n\nproduct, again"))
    raw = views.reviews_view(spark, sf_dir).withColumn("review_comment", comment)
    _as_csv(spark, raw, "reviews", base)
    return files.scan_csv(spark, f"{base}/reviews.csv", raw.schema, multiline=True)


@query
def scan_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files.scan_tolerant(spark, f"{sf_dir}/lineitem.parquet", SCHEMAS["items"], "parquet")
    absent = files.scan_tolerant(spark, f"{sf_dir}/no_such_table.parquet", SCHEMAS["items"], "parquet")
    return found.agg(F.lit("found").alias("source"), F.count(F.lit(1)).alias("n_rows")).unionByName(
        absent.agg(F.lit("absent").alias("source"), F.count(F.lit(1)).alias("n_rows"))
    )


@query
def scan_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the scans of products and reviews cannot read, also lines cut off inside quotes, and how many rows they keep."""
    products, reviews = views.products_view(spark, sf_dir), views.reviews_view(spark, sf_dir)
    cut = F.when(F.col("product_id") % 59 == 0, F.concat(F.lit('"'), F.coalesce(CATEGORY, F.lit("")))).otherwise(F.col(CATEGORY))
    typed = {
        "products": (products.withColumn(CATEGORY, cut), "product_weight_g double, product_length_cm integer, product_height_cm double"),
        "reviews": (reviews, "review_score long, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"),
    }
    parts = []
    for name, (table, schema) in typed.items():
        path = f"{scratch_path(spark, 'rejects-csv')}/{name}.csv"
        table.write.options(header=True, quote="").csv(path)  # as the texts are, without quoting
        rows, rejects = quarantine.scan_with_rejects(spark, path, struct_of(schema))
        in_folder = F.contains("file", F.lit(f"/{name}.csv/"))
        parts.append(rejects.select(F.lit(name).alias("table_name"), "column_name", "raw", "reason", in_folder.alias("in_folder")))
        kept = rows.agg(F.count(F.lit(1)).cast("string").alias("raw"))
        parts.append(kept.select(
            F.lit(name).alias("table_name"), F.lit(None).cast("string").alias("column_name"), "raw",
            F.lit("rows kept").alias("reason"), F.lit(True).alias("in_folder"),
        ))
    result = parts[0]
    for other in parts[1:]:
        result = result.unionByName(other)
    return result


@query
def infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types that the values of the seven CSV tables have, beside the declared ones."""
    base = scratch_path(spark, "typed-csv")
    parts = []
    for name, df in {**views.source_views(spark, sf_dir), **views.party_views(spark, sf_dir)}.items():
        _as_csv(spark, df, name, base)
        texts = spark.read.options(**files.CSV_OPTIONS).csv(f"{base}/{name}.csv")
        declared = F.create_map(*[F.lit(v) for f in SCHEMAS[name] for v in (f.name, f.dataType.simpleString())])
        parts.append(quarantine.infer_types(texts).select(
            F.lit(name).alias("table_name"), "column_name", "inferred", "n_values", declared[F.col("column_name")].alias("declared")
        ))
    result = parts[0]
    for other in parts[1:]:
        result = result.unionByName(other)
    return result.withColumn("fits", quarantine.fits("inferred", "declared"))


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, sf_dir).select(*KEYS, "demand", "total_sales", "avg_price")


@query
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV, then as parquet by month, and read back."""
    table = _sales(spark, sf_dir)
    as_csv, as_parquet = scratch_path(spark, "sales-csv"), scratch_path(spark, "sales-parquet")
    files.write_csv(table, as_csv)
    files.write_table(files.read_csv_like(spark, as_csv, table.schema), as_parquet)
    return spark.read.schema(table.schema).parquet(as_parquet).select(*table.columns)


@query
def snapshot_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second snapshot replaces the first for readers; the first stays readable."""
    root = scratch_path(spark, "snapshots")
    table = _stored(_sales(spark, sf_dir))
    first = files.write_snapshot(table, root)
    files.write_snapshot(update.append_months(files.read_snapshot(spark, root), update.next_month_rows(table)), root)
    newest = files.read_snapshot(spark, root).withColumn("snapshot", F.lit("newest"))
    backup = files.read_snapshot(spark, root, first).withColumn("snapshot", F.lit("backup"))
    return newest.unionByName(backup).groupBy("snapshot").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("demand").alias("demand")
    )


# ---- cleaning ------------------------------------------------------------


@query
def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_orders(views.orders_view(spark, sf_dir))


@query
def clean_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_items(views.items_view(spark, sf_dir))


@query
def clean_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_products(views.products_view(spark, sf_dir))


@query
def clean_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_payments(views.payments_view(spark, sf_dir))


@query
def clean_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_reviews(views.reviews_view(spark, sf_dir))


@query
def normalize_category_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.products_view(spark, sf_dir).select(
        "product_id",
        normalize_category(CATEGORY).alias("category"),
        normalize_category(CATEGORY, dashes=True).alias("category_without_dashes"),
    )


@query
def fill_numeric_nulls_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders.order_base_features(cleaning.clean_orders(views.orders_view(spark, sf_dir)))
    return fill_numeric_nulls(base).select("order_id", "delivery_time_days", "delivery_delay", "is_delayed")


@query
def final_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _series_input(spark, sf_dir).withColumns(
        {**series.target(), **series.growth_rates(), **series.seasonality()}
    )
    return final.final_clean(
        df.select(*KEYS, "demand", TARGET, *series.growth_rates(), *series.seasonality())
    )


@query
def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that the feature table leaves out."""
    return final.constant_columns(feature_table(spark, sf_dir))


@query
def default_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = views.products_view(spark, sf_dir).select("product_id", "product_length_cm")
    return with_defaults(
        products, {CATEGORY: "unknown_category", "delivery_delay": 0, "pct_boleto": 0.0, "product_length_cm": "none"}
    )


@query
def decompose_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entity_counts(star.star_entities(views.source_views(spark, sf_dir)))


def _entity_counts(entities: dict[str, DataFrame]) -> DataFrame:
    """Rows and keys of the entity tables, each stored whole first.

    Counted straight away, the columns that no count asks for would be neither read nor cleaned.
    """
    keys = {"products": "product_id"}
    counts = [
        materialize(df, name).agg(
            F.lit(name).alias("entity"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(keys.get(name, "order_id")).alias("n_keys"),
        )
        for name, df in entities.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


@query
def decompose_wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored wide table split into its entities."""
    wide = materialize(star.star_left_join(views.source_views(spark, sf_dir)), "wide")
    return _entity_counts(cleaning.decompose_wide(wide))


@query
def clean_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = views.source_views(spark, sf_dir)
    return star.clean_combined(
        sources,
        cleaning.clean_orders(sources["orders"]),
        cleaning.clean_products(sources["products"], dashes=True),
    ).select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value",
        "review_id", "payment_sequential", "payment_value",
    )


@query
def retention_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = views.source_views(spark, sf_dir)
    return star.retention_report(
        sources,
        cleaning.clean_orders(sources["orders"]),
        cleaning.clean_products(sources["products"], dashes=True),
    )


# ---- joins ---------------------------------------------------------------


@query
def items_with_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _clean(spark, sf_dir)
    return orders.items_with_category(clean["items"], clean["products"])


@query
def item_grain_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _item_grain(spark, sf_dir)


@query
def star_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.star_left_join(views.source_views(spark, sf_dir))


@query
def semi_join_valid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = views.source_views(spark, sf_dir)
    valid = cleaning.clean_orders(sources["orders"]).select("order_id")
    return star.join_by_key(sources["items"], valid, "order_id", "left_semi")


@query
def top_category_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_category_series(_stored(_demand_labelled(spark, sf_dir)))


@query
def new_categories_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = split.positional_split(_stored(_labelled(spark, sf_dir)), order_by=(CATEGORY, DATE))
    return profile.new_categories(split.test_part(parts), split.train_part(parts))


@query
def new_categories_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = split.positional_split(_stored(_labelled(spark, sf_dir)), order_by=(CATEGORY, DATE))
    return profile.new_categories_except(split.test_part(parts), split.train_part(parts))


@query
def future_month_scaffold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return update.future_months(_stored(_monthly(spark, sf_dir).select(*KEYS)), months=3)


@query
def lookup_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _clean(spark, sf_dir)
    return profile.restore_category(clean["items"], clean["products"])


# ---- aggregations --------------------------------------------------------


@query
def order_base_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders.order_base_features(cleaning.clean_orders(views.orders_view(spark, sf_dir)))
    return base.select("order_id", MONTH, "delivery_time_days", "delivery_delay", "is_delayed")


@query
def payment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.payment_features(cleaning.clean_payments(views.payments_view(spark, sf_dir)))


@query
def payment_type_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.payment_type_pivot(cleaning.clean_payments(views.payments_view(spark, sf_dir)))


@query
def payment_type_pivot_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of all types in the data, here with a fifth one."""
    payments = views.payments_view(spark, sf_dir)
    fifth = F.when((F.col("order_id") % 7 == 0) & (F.col("payment_sequential") == 1), "Gift Card")
    return orders.payment_type_pivot_all(
        cleaning.clean_payments(payments.withColumn("payment_type", F.coalesce(fifth, F.col("payment_type"))))
    )


@query
def review_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.review_features(cleaning.clean_reviews(views.reviews_view(spark, sf_dir)))


@query
def monthly_category_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_monthly(spark, sf_dir, with_counts=True), 4, ["price_std", "delivery_time_days_std"])


def _order_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """States of two batches of orders: every third order comes later, with its items, payments and reviews."""
    sources = views.source_views(spark, sf_dir)
    later = F.col("order_id") % 3 == 0
    batches = [
        {name: rows if name == "products" else rows.where(which) for name, rows in sources.items()} for which in (~later, later)
    ]
    return [monthly_state.state_of(orders.build_item_grain(cleaning.clean_all(batch))) for batch in batches]


@query
def monthly_state_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly table from a stored state that a second batch of orders was merged into."""
    first, second = _order_batches(spark, sf_dir)
    path = scratch_path(spark, "state")
    monthly_state.write_state(first, path)
    monthly_state.update_state(spark, path, second)
    table = monthly_state.finish(monthly_state.read_state(spark, path))
    return rounded(table, 4, ["price_std", "delivery_time_days_std"])


@query
def monthly_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered demand of the star join per month and category, with next month's units."""
    items = star.star_items(views.source_views(spark, sf_dir))
    delivered = items.filter(F.col("order_status") == "delivered")
    return _with_target(aggregates.monthly_demand(delivered, star.WEIGHT))


@query
def monthly_demand_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _demand_clean(spark, sf_dir)


@query
def monthly_agg_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = star.monthly_aggregate_fanout(_star_clean_items(spark, sf_dir))
    return rounded(table, 4, ["price_std", "delivery_time_days_std"])


@query
def category_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = category.category_stats(_monthly(spark, sf_dir))
    return rounded(
        table, 4, ["category_std_demand", "category_avg_price", "category_std_price", "category_avg_review"]
    )


@query
def category_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.category_profile(_demand_labelled(spark, sf_dir), "monthly_demand_units")


@query
def categories_over_12_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.categories_over(_demand_labelled(spark, sf_dir))


@query
def target_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.target_completeness(_with_target(_demand_clean(spark, sf_dir)))


@query
def data_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = views.source_views(spark, sf_dir)
    return star.compare_star_quality(
        sources,
        cleaning.clean_orders(sources["orders"]),
        cleaning.clean_products(sources["products"], dashes=True),
    )


@query
def validate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.validate_table(views.items_view(spark, sf_dir), "items")


@query
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_counts(views.orders_view(spark, sf_dir))


@query
def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = views.source_views(spark, sf_dir)
    raw = profile.key_uniqueness(sources["orders"], "order_id", "orders_raw")
    return raw.unionByName(
        profile.key_uniqueness(cleaning.clean_orders(sources["orders"]), "order_id", "orders_clean")
    ).unionByName(
        profile.key_uniqueness(cleaning.clean_products(sources["products"]), "product_id", "products_clean")
    )


@query
def period_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.period_range(_demand_clean(spark, sf_dir))


@query
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_counts(_demand_labelled(spark, sf_dir), [MONTH, CATEGORY, TARGET])


@query
def predicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.predicate_counts(
        views.items_view(spark, sf_dir),
        {"valid_prices": F.col("price") > 0, "valid_freights": F.col("freight_value") >= 0},
    )


@query
def demand_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.demand_by_month(_demand_labelled(spark, sf_dir), "monthly_demand_units")


@query
def category_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(_demand_labelled(spark, sf_dir))


@query
def top_categories_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_groups(_demand_labelled(spark, sf_dir), F.count(F.lit(1)), "n_rows", 10)


@query
def top_categories_by_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_groups(_demand_labelled(spark, sf_dir), F.avg("monthly_demand_units"), "mean_demand", 10)


@query
def top_categories_by_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_groups(_demand_labelled(spark, sf_dir), F.sum("monthly_demand_units"), "total_demand", 10)


@query
def demand_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _stored(_demand_labelled(spark, sf_dir))
    parts = [profile.histogram(df, c, bins) for c in ("monthly_demand_units", TARGET) for bins in (30, 50)]
    result = parts[0].withColumn("bins", F.lit(30))
    for part, bins in zip(parts[1:], (50, 30, 50)):
        result = result.unionByName(part.withColumn("bins", F.lit(bins)))
    return rounded(result, 4, ["bin_start"])


@query
def split_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = profile.split_distribution(split.last_months_split(_stored(_labelled(spark, sf_dir))))
    return rounded(table, 4, ["demand_std", "target_std"])


@query
def split_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _stored(_series_input(spark, sf_dir).withColumns(series.target()).select(*KEYS, DATE, TARGET))
    return profile.split_completeness(split.last_months_split(table))


# ---- time series ---------------------------------------------------------

QUERIES["demand_next_month"] = _family(series.target)
QUERIES["lag_features"] = _family(series.lags)
QUERIES["moving_averages"] = _family(series.moving_averages, 4)
QUERIES["ema_features"] = _family(series.exponential_means, 6)
QUERIES["rolling_std"] = _family(series.rolling_std, 4)
QUERIES["rolling_min_max"] = _family(series.rolling_range)
QUERIES["growth_rates"] = _family(series.growth_rates)
QUERIES["momentum"] = _family(series.momentum)
QUERIES["seasonality"] = _family(series.seasonality)
QUERIES["volatility"] = _family(series.volatility, 6)
QUERIES["trend"] = _family(series.trend)
QUERIES["yoy_growth"] = _family(series.yoy_growth)
QUERIES["mom_growth"] = _family(series.mom_growth)
QUERIES["cumulative_12m"] = _family(series.trailing_year)
QUERIES["rolling_skew"] = _family(series.skewness, 6)
QUERIES["rolling_quantiles"] = _family(series.quantiles)
QUERIES["rolling_cv"] = _family(series.yearly_variation, 6)


@query
def acceleration(spark: SparkSession, sf_dir: str) -> DataFrame:
    grown = _series_input(spark, sf_dir).withColumns(series.growth_rates())
    return grown.withColumns(series.acceleration()).select(*KEYS, "demand_acceleration")


@query
def group_size_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing measures that exist only in categories with enough months."""
    guarded = {
        f"{name}_from_{rows}": fs.guarded(value, rows)
        for name, value, rows in (
            ("change_1m", fs.change("demand", 1), 3),
            ("change_3m", fs.change("demand", 3), 6),
            ("change_6m", fs.change("demand", 6), 13),
        )
    }
    return _series_input(spark, sf_dir).withColumns(guarded).select(*KEYS, *guarded)


@query
def latest_per_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return update.latest_per_category(_monthly(spark, sf_dir).select(*KEYS, "demand", "total_sales"))


@query
def positional_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = split.positional_split(_stored(_labelled(spark, sf_dir)))
    return parts.select(*KEYS, "position", "split", TARGET)


@query
def last_k_months_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.last_months_split(_stored(_labelled(spark, sf_dir))).select(*KEYS, "split", TARGET)


@query
def sample_first_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.sample_first_category(_stored(_demand_labelled(spark, sf_dir)))


@query
def sample_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.head(_demand_labelled(spark, sf_dir))


# ---- calendar, ratios, category ------------------------------------------


@query
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _series_input(spark, sf_dir).withColumns({**calendar.date_parts(), **calendar.season_columns()})
    return df.select(*KEYS, DATE, *calendar.date_parts(), *calendar.season_columns())


@query
def cyclical_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = calendar.cycle_columns()
    df = _series_input(spark, sf_dir).withColumns(columns).select(*KEYS, *columns)
    return rounded(df, 8, list(columns))


@query
def calendar_dummies(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = calendar.dummy_columns()
    return _series_input(spark, sf_dir).withColumns(columns).select(*KEYS, *columns)


@query
def business_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = _monthly(spark, sf_dir, with_counts=True)
    return ratios.business_ratios(monthly).drop(*[c for c in monthly.columns if c not in KEYS])


@query
def category_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = category.category_features(_monthly(spark, sf_dir))
    names = ["demand_vs_category_avg", "price_vs_category_avg", "review_vs_category_avg", "demand_z_score", "price_z_score"]
    return rounded(table.select(*KEYS, *names), 6, names)


@query
def category_features_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category statistics and relative values from the months up to each row's own."""
    table = category.category_features_as_of(_series_input(spark, sf_dir))
    relative = ["demand_vs_category_avg", "price_vs_category_avg", "review_vs_category_avg", "demand_z_score", "price_z_score"]
    stats = ["category_avg_demand", "category_std_demand", "category_avg_price", "category_std_price", "category_avg_review"]
    exact = ["category_median_demand", "category_max_demand"]
    return rounded(rounded(table.select(*KEYS, *exact, *stats, *relative), 6, relative), 4, stats)


@query
def sanitize_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stacked naive predictions, spoilt by target modulus with NaN, infinity, NULL and negative values."""
    key, value = F.col(TARGET), F.col("prediction").cast("double")
    raw = (
        F.when(key % 7 == 0, float("nan"))
        .when(key % 7 == 1, float("inf"))
        .when(key % 7 == 2, -float("inf"))
        .when(key % 7 == 3, F.lit(None).cast("double"))
        .when(key % 7 == 4, -value - 1)
        .otherwise(value)
    )
    table = _naive_stack(spark, sf_dir).select(
        *KEYS, "model", TARGET, finite_or_zero(raw).alias("prediction"), clamp_non_negative(raw).alias("clamped")
    )
    return rounded(table, 6, ["prediction", "clamped"])


# ---- naive models and metrics --------------------------------------------


def _positional(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    parts = split.positional_split(_stored(_labelled(spark, sf_dir).select(*KEYS, DATE, TARGET)))
    return split.test_part(parts), split.train_part(parts)


def _by_date(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    parts = split.last_months_split(_stored(_labelled(spark, sf_dir).select(*KEYS, DATE, TARGET)))
    return split.test_part(parts), split.train_part(parts)


def _naive(parts: Callable, model: Callable) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        test, train = parts(spark, sf_dir)
        return model(test, train, "prediction").select(*KEYS, TARGET, "prediction")

    return run


QUERIES["naive_last_value"] = _naive(_positional, naive.naive_last_value)
QUERIES["naive_historical_mean"] = _naive(_positional, naive.naive_historical_mean)
QUERIES["naive_by_category"] = _naive(_positional, naive.naive_by_category)
QUERIES["forecast_naive_last"] = _naive(_by_date, naive.forecast_last)
QUERIES["forecast_naive_mean"] = _naive(_by_date, naive.forecast_mean)
QUERIES["forecast_seasonal"] = _naive(_by_date, naive.forecast_seasonal)
QUERIES["forecast_seasonal_last"] = _naive(_by_date, naive.forecast_seasonal_last)


def _naive_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    test, train = _positional(spark, sf_dir)
    predicted = naive.predict_all(test, train, naive.NAIVE_MODELS)
    return metrics.stack_predictions(predicted, list(naive.NAIVE_MODELS))


def _forecast_stack(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    test, train = _by_date(spark, sf_dir)
    predicted = naive.predict_all(test, train, naive.FORECAST_MODELS)
    return metrics.stack_predictions(predicted, list(naive.FORECAST_MODELS)), test


@query
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.model_metrics(_naive_stack(spark, sf_dir)), 6, ["mae", "rmse", "r2"])


@query
def forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stacked, test = _forecast_stack(spark, sf_dir)
    table = metrics.comparison_table(metrics.forecast_metrics(stacked, test))
    return rounded(table, 6, ["mae", "rmse", "r2", "mape", "mase", "accuracy"])


@query
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = metrics.best_model(metrics.model_metrics(_naive_stack(spark, sf_dir)))
    return rounded(best, 6, ["mae", "rmse", "r2"])


@query
def top_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    stacked, _ = _forecast_stack(spark, sf_dir)
    return metrics.top_errors(stacked.filter(F.col("model") == "naive_category_last"))


# ---- end to end ----------------------------------------------------------

# Columns whose last digits depend on summation order, by digits kept.
ROUND_4 = (
    "price_std", "delivery_time_days_std", "category_std_demand", "category_avg_price", "category_std_price",
    "category_avg_review",
)


def round_features(df: DataFrame) -> DataFrame:
    four = [*ROUND_4, *series.moving_averages(), *series.rolling_std()]
    six = [
        *series.exponential_means(), *series.volatility(), *series.skewness(), *series.yearly_variation(),
        *calendar.cycle_columns(), "demand_vs_category_avg", "price_vs_category_avg", "review_vs_category_avg",
        "demand_z_score", "price_z_score",
    ]
    digits = {**dict.fromkeys(four, 4), **dict.fromkeys(six, 6)}
    return df.selectExpr(*[f"round({c}, {digits[c]}) AS {c}" if c in digits else c for c in df.columns])


@query
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_features(features.build_features(views.source_views(spark, sf_dir), drop_constants=False))


@query
def feature_table_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that the feature table keeps when constant ones are dropped, with their ranges."""
    table = round_features(_stored(features.build_features(views.source_views(spark, sf_dir))))
    names = [f.name for f in table.schema if isinstance(f.dataType, T.NumericType)]
    bounds = table.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[f(F.col(c).cast("double")).alias(f"{side}_{i}") for i, c in enumerate(names) for side, f in (("lo", F.min), ("hi", F.max))],
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"), (F.col(f"lo_{i}") + 0.0).alias("lo"), (F.col(f"hi_{i}") + 0.0).alias("hi"))
        for i, c in enumerate(names)
    ]
    return bounds.select("n_rows", F.inline(F.array(*entries)))


@query
def feature_table_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feature table after a second batch of orders was merged into the stored tables."""
    first, second = _order_batches(spark, sf_dir)
    root = scratch_path(spark, "incremental")
    incremental.start(first, root)
    incremental.update_orders(spark, root, second)
    return round_features(incremental.read_by_category(spark, f"{root}/features"))


UPDATE_COLUMNS = (MONTH, CATEGORY, DATE, "demand", "total_sales", TARGET)


@query
def update_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing = _stored(_labelled(spark, sf_dir).select(*UPDATE_COLUMNS))
    return update.append_months(existing, update.next_month_rows(existing))


@query
def update_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = _stored(_monthly(spark, sf_dir, with_counts=True))
    table = training.updated_features(monthly, update.next_month_rows(monthly))
    columns = ["demand", TARGET, "demand_lag_1", "demand_lag_12", "ma_3", "demand_growth_1m", "cumulative_demand_year"]
    return rounded(table.select(*KEYS, *columns), 4, ["ma_3"])


@query
def update_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``update_recompute``: the next month comes for one half of the categories, then for the other."""
    monthly = _stored(_monthly(spark, sf_dir, with_counts=True))
    root = scratch_path(spark, "incremental")
    incremental.start_monthly(monthly, root)
    new = _stored(update.next_month_rows(monthly))
    half = F.pmod(F.xxhash64(CATEGORY), F.lit(2)) == 0
    for rows in (new.where(half), new.where(~half)):
        incremental.update_months(spark, root, rows)
    columns = ["demand", TARGET, "demand_lag_1", "demand_lag_12", "ma_3", "demand_growth_1m", "cumulative_demand_year"]
    return rounded(incremental.read_by_category(spark, f"{root}/features").select(*KEYS, *columns), 4, ["ma_3"])


# ---- fitted models (no SQL equivalent) -----------------------------------


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build_features(views.source_views(spark, sf_dir))


def _finite(c: str) -> Column:
    value = F.col(c)
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def _checked(name: str, fact: Callable[[models.Training, DataFrame], Column]) -> Query:
    """Every test row with its target, whether its prediction is finite, and a fact about the fit."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = _stored(_features(spark, sf_dir))
        trained = models.train_from_table(table, (name,))
        rows = trained.predictions.filter(F.col("model") == name)
        return rows.select(
            *KEYS, TARGET, _finite("prediction").alias("is_finite"), fact(trained, table).alias("fit_holds")
        )

    return run


def _train_rows(table: DataFrame) -> DataFrame:
    return split.train_part(split.positional_split(zero_unusable(table)))


def _training_error(trained: models.Training, table: DataFrame, name: str) -> tuple[float, float]:
    """Mean squared error of a model on its training rows, and that of their mean."""
    rows = models.predict(trained.models[name], _train_rows(table), "prediction")
    left, whole = rows.agg(F.avg(F.pow(F.col(TARGET) - F.col("prediction"), 2)), F.var_pop(TARGET)).first()
    return left, whole


def _within_targets(trained: models.Training, table: DataFrame) -> Column:
    """A forest predicts means of training targets, and is nearer to its training rows than their mean is."""
    low, high = _train_rows(table).agg(F.min(TARGET), F.max(TARGET)).first()
    left, whole = _training_error(trained, table, "random_forest")
    return F.col("prediction").between(low - 1e-6, high + 1e-6) & F.lit(left < whole)


def _residuals_cancel(trained: models.Training, table: DataFrame) -> Column:
    """With an intercept, the training residuals of a linear fit add up to nothing."""
    rows = models.predict(trained.models["linear_regression"], _train_rows(table), "prediction")
    rest, size = rows.agg(F.sum(F.col(TARGET) - F.col("prediction")), F.sum(F.abs(TARGET))).first()
    return F.lit(abs(rest) <= 1e-6 * size)


def _beats_the_mean(trained: models.Training, table: DataFrame) -> Column:
    """Boosting explains most of the variance of its own training rows."""
    left, whole = _training_error(trained, table, "gradient_boosting")
    return F.lit(left < 0.5 * whole)


QUERIES["rf_predictions"] = _checked("random_forest", _within_targets)
QUERIES["lr_predictions"] = _checked("linear_regression", _residuals_cancel)
QUERIES["gbt_predictions"] = _checked("gradient_boosting", _beats_the_mean)


@query
def gbt_l2_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosting with an L2 term on all feature columns, ten trees of depth 4: every test row, and whether more trees explain more of the training rows."""
    table = _stored(features.build_features(views.source_views(spark, sf_dir), drop_constants=False))
    parts = materialize(split.positional_split(zero_unusable(table)), "split")
    train = split.train_part(parts)
    model = boosting.fit(train, models.feature_names(table), boosting.BoostConfig(rounds=10, depth=4, rate=0.3))
    half = dataclasses.replace(model, trees=model.trees[:5])
    both = boosting.predict(half, boosting.predict(model, train, "all_trees"), "half_of_them")
    errors = [F.avg(F.pow(F.col(TARGET) - F.col(c), 2)) for c in ("all_trees", "half_of_them")]
    left, middle, whole = both.agg(*errors, F.var_pop(TARGET)).first()
    found = boosting.predict(model, split.test_part(parts), "prediction")
    return found.select(*KEYS, TARGET, _finite("prediction").alias("is_finite"), F.lit(left < middle < whole).alias("fit_holds"))


def _scored(table: DataFrame) -> DataFrame:
    """Each model with its status and whether its errors are usable numbers."""
    return table.select("model", "status", (_finite("mae") & _finite("rmse") & (F.col("mae") <= F.col("rmse") + 1e-9)).alias("is_scored"))


@query
def train_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training from an updated table whose appended rows still hold nulls."""
    table = _stored(_features(spark, sf_dir))
    appended = update.append_months(table, update.next_month_rows(table).drop("demand_lag_1"))
    trained = models.train_from_table(appended, ("linear_regression",), order_by=(CATEGORY, DATE))
    return _scored(trained.metrics)


def _latest_is(spark: SparkSession, root: str, trained: models.Training) -> bool:
    """Whether the log of the newest training names the trained model with the smallest error."""
    fitted = trained.metrics.filter(F.col("model").isin(list(trained.models)))
    best = fitted.orderBy("mae", "model").first()["model"]
    newest = files.log_entries(spark, f"{root}/model_latest").orderBy(F.desc("number")).first()["path"]
    return f"/model_{best}_" in newest


@query
def train_and_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, root = ("linear_regression", "gradient_boosting"), scratch_path(spark, "models")
    trained = training.train_and_save(_features(spark, sf_dir), root, names=names)
    latest = F.lit(_latest_is(spark, root, trained))
    return _scored(metrics.comparison_table(trained.metrics)).withColumn("latest_is_best", latest)


@query
def model_persist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row, and whether the stored and loaded model predicts for it what the fitted one does."""
    root = scratch_path(spark, "models")
    table = _stored(_features(spark, sf_dir))
    trained = training.train_and_save(table, root, names=("linear_regression",))
    fitted = models.predict(trained.models["linear_regression"], zero_unusable(table), "fitted")
    both = models.predict(files.latest_model(spark, root), fitted, "loaded")
    return both.select(*KEYS, TARGET, (F.col("fitted") == F.col("loaded")).alias("is_same"))


@query
def retrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append the next month, store the table as a new version, train on it and store the models."""
    table_root, model_root = scratch_path(spark, "snapshots"), scratch_path(spark, "models")
    table = _stored(_features(spark, sf_dir))
    files.write_snapshot(table, table_root)
    new = update.next_month_rows(table)
    trained = training.retrain(spark, table, new, table_root, model_root, names=("linear_regression",))
    latest = _latest_is(spark, model_root, trained)
    versions = files.snapshot_log(spark, table_root).count()
    ok = trained.metrics.filter("status = 'ok'").count()
    return files.read_snapshot(spark, table_root).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(CATEGORY).alias("n_categories"),
        F.max(MONTH).alias("last_month"),
        F.lit(versions).cast("long").alias("n_versions"),
        F.lit(ok).cast("long").alias("n_models"),
        F.lit(latest).alias("latest_is_best"),
    )


@query
def read_or_compute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table computed and stored on the first call, read on the second one."""
    path = scratch_path(spark, "features")
    sources = views.source_views(spark, sf_dir)
    first = training.stored_features(spark, path, sources)
    # without any source the second call can only read
    second = training.stored_features(spark, path, {})
    counted = [df.agg(F.lit(n).alias("call"), F.count(F.lit(1)).alias("n_rows"), F.sum(TARGET).alias("target")) for n, df in ((1, first), (2, second))]
    return counted[0].unionByName(counted[1])
