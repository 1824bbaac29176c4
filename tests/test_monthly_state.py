"""The mergeable monthly state, and the stored tables that are kept up to date from it."""

import os
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from demandloom.config import CATEGORY, KEYS, MONTH
from demandloom.operators import aggregates, cleaning, monthly_state, orders
from demandloom.plans import features, incremental
from demandloom.registry import queries
from demandloom.session import materialize
from demandloom.sources import views

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def items(spark):
    return materialize(orders.build_item_grain(cleaning.clean_all(views.source_views(spark, SF_DIR))), "items")


def close(found, wanted):
    """Equal rows by key, floating values to a relative 1e-9."""
    assert sorted(found.columns) == sorted(wanted.columns)
    a, b = ({(r[MONTH], r[CATEGORY]): r.asDict() for r in df.collect()} for df in (found, wanted))
    assert a.keys() == b.keys()
    for key, row in a.items():
        for c, value in row.items():
            other = b[key][c]
            if isinstance(value, float) and isinstance(other, float):
                assert abs(value - other) <= 1e-9 * max(1.0, abs(other)), (key, c, value, other)
            else:
                assert value == other, (key, c, value, other)


def test_state_of_all_rows(items):
    close(monthly_state.finish(monthly_state.state_of(items)), aggregates.monthly_category_aggregate(items))


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_any_split_into_batches(items, batches):
    part = F.pmod(F.xxhash64("order_id", "product_id"), F.lit(batches))  # orders are split too
    states = [monthly_state.state_of(items.where(part == i)) for i in range(batches)]
    close(monthly_state.finish(monthly_state.merge(states)), aggregates.monthly_category_aggregate(items))


def test_one_row_and_empty_batches(spark, items):
    one, none = items.limit(1), items.limit(0)
    merged = monthly_state.finish(monthly_state.merge([monthly_state.state_of(none), monthly_state.state_of(one)]))
    row = merged.first()
    assert row["demand"] == 1 and row["price_std"] is None and row["unique_orders"] == 1
    assert monthly_state.finish(monthly_state.state_of(none)).count() == 0


def test_update_reads_only_touched_months(spark, items, tmp_path):
    path = str(tmp_path / "state")
    months = sorted(r[0] for r in items.select(MONTH).distinct().collect())
    late = months[-2:]
    first = items.where(~F.col(MONTH).isin(late) | (F.col("order_id") % 2 == 0))
    monthly_state.write_state(monthly_state.state_of(first), path)
    untouched = sorted(os.listdir(f"{path}/{MONTH}={months[0]}"))
    new = items.where(F.col(MONTH).isin(late) & (F.col("order_id") % 2 == 1))
    merged = monthly_state.update_state(spark, path, monthly_state.state_of(new))
    touched = sorted(r[0] for r in new.select(MONTH).distinct().collect())
    assert touched and sorted(r[0] for r in merged.select(MONTH).distinct().collect()) == touched
    assert sorted(os.listdir(f"{path}/{MONTH}={months[0]}")) == untouched
    close(monthly_state.finish(monthly_state.read_state(spark, path)), aggregates.monthly_category_aggregate(items))
    plan = monthly_state.read_state(spark, path, late)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and late[0] in plan


def test_numbered_ids(spark, items):
    texts = items.withColumns({c: F.concat(F.lit("x"), c) for c in aggregates.DISTINCT_COUNTS.values()})
    with pytest.raises(TypeError, match="numbered"):
        monthly_state.state_of(texts)
    half = F.pmod(F.xxhash64("order_id"), F.lit(2)) == 0
    numbers = {}
    for c in aggregates.DISTINCT_COUNTS.values():
        none = spark.createDataFrame([], "id string, number long")
        first = materialize(monthly_state.number_ids(none, texts.where(half).select(F.col(c).alias("id"))), "numbers")
        numbers[c] = materialize(monthly_state.number_ids(first, texts.select(F.col(c).alias("id"))), "numbers")
        # numbers stay, are dense and distinct
        assert numbers[c].join(first, ["id", "number"]).count() == first.count()
        row = numbers[c].agg(F.count("*"), F.count_distinct("number"), F.max("number"), F.count_distinct("id")).first()
        assert row[0] == row[1] == row[2] + 1 == row[3]
    found = monthly_state.finish(monthly_state.state_of(monthly_state.with_numbers(texts, numbers)))
    close(found, aggregates.monthly_category_aggregate(items))


def test_incremental_features_equal_a_rebuild(spark, items, tmp_path):
    root = str(tmp_path / "tables")
    later = F.col("order_id") % 5 == 0
    some = [r[0] for r in items.select(CATEGORY).distinct().orderBy(CATEGORY).limit(4).collect()]
    second = items.where(later & F.col(CATEGORY).isin(some))
    first = items.exceptAll(second)
    incremental.start(monthly_state.state_of(first), root)
    other = next(d for d in sorted(os.listdir(f"{root}/features")) if d.startswith(CATEGORY) and unquote(d.split("=")[1]) not in some)
    untouched = sorted(os.listdir(f"{root}/features/{other}"))
    assert incremental.update_orders(spark, root, monthly_state.state_of(second)) == sorted(
        r[0] for r in second.select(CATEGORY).distinct().collect()
    )
    assert sorted(os.listdir(f"{root}/features/{other}")) == untouched
    wanted = features.final_clean(features.features_from_monthly(aggregates.monthly_category_aggregate(items)))
    close(incremental.read_by_category(spark, f"{root}/features").select(*wanted.columns), wanted)
    plan = incremental.read_by_category(spark, f"{root}/features", some)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and some[0] in plan
    assert incremental.read_by_category(spark, f"{root}/monthly").select(*KEYS).distinct().count() == items.select(*KEYS).distinct().count()


def test_far_apart_ids_cost_a_narrow_row_each(spark, items):
    """No block of mostly empty bits per id, and no more files of a month than shares when more tasks write."""
    far = items.withColumns({c: F.col(c) * 1_000_003 for c in aggregates.DISTINCT_COUNTS.values()})
    state = monthly_state.state_of(far)
    assert all(t not in ("binary", "array") for _, t in state.dtypes)
    close(monthly_state.finish(state), aggregates.monthly_category_aggregate(items))
    plan = monthly_state.state_of(items)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


@pytest.fixture(scope="module")
def own_tables(spark, tmp_path_factory):
    """Tables of 40 orders in two years, some with the same key, of two items each."""
    root = str(tmp_path_factory.mktemp("own"))
    day = F.expr("TIMESTAMP_NTZ'2020-01-05 00:00:00'") + F.make_dt_interval(days=(F.col("id") * 17).cast("int"))
    ids = spark.range(1, 41)
    rows = ids.union(ids.where("id % 10 = 3"))
    rows.select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.lit(10.0).alias("o_totalprice"), day.alias("o_orderdate"),
    ).write.parquet(f"{root}/orders.parquet")
    rows.select("id", F.explode(F.array(F.lit(1), F.lit(2))).alias("line")).select(
        F.col("id").alias("l_orderkey"), ((F.col("id") + F.col("line")) % 4).alias("l_partkey"), (F.col("id") % 3).alias("l_suppkey"),
        F.col("line").alias("l_linenumber"), (F.col("id") + 0.5).alias("l_extendedprice"), F.lit(0.1).alias("l_tax"),
    ).write.parquet(f"{root}/lineitem.parquet")
    spark.range(4).select(
        F.col("id").alias("p_partkey"), F.lit("b").alias("p_brand"), F.concat(F.lit("t"), F.col("id") % 2).alias("p_type"),
        F.lit(3).alias("p_size"),
    ).write.parquet(f"{root}/part.parquet")
    return root


def test_batches_hold_their_own_orders_only(spark, own_tables, monkeypatch):
    """Items, payments and reviews of an order are cleaned and joined in the batch of the order, not in both."""
    seen, clean = [], cleaning.clean_all
    monkeypatch.setattr(queries.cleaning, "clean_all", lambda batch: seen.append(batch) or clean(batch))
    states = queries._order_batches(spark, own_tables)
    whole = views.source_views(spark, own_tables)
    for name in ("orders", "items", "payments", "reviews"):
        assert sum(batch[name].count() for batch in seen) == whole[name].count() > 0
    close(monthly_state.finish(monthly_state.merge(states)), aggregates.monthly_category_aggregate(orders.build_item_grain(clean(whole))))


def test_finished_rows_come_from_the_stored_state(spark, own_tables, tmp_path, monkeypatch):
    """The state is neither worked out a second time to be finished, nor stored twice, nor are its ids joined."""
    root, read, stored, finish = str(tmp_path / "tables"), [], [], monthly_state.finish
    monkeypatch.setattr(incremental, "finish", lambda state: read.append(state) or stored.append(all(f"{root}/state/" in f for f in state.inputFiles())) or finish(state))
    first, second = queries._order_batches(spark, own_tables)
    incremental.start(first, root)
    incremental.update_orders(spark, root, second)
    for state in read:
        assert "Join" not in state._jdf.queryExecution().optimizedPlan().toString()
    assert stored == [True, True]
    whole = orders.build_item_grain(cleaning.clean_all(views.source_views(spark, own_tables)))
    close(incremental.read_by_category(spark, f"{root}/monthly"), aggregates.monthly_category_aggregate(whole))
