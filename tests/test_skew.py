"""Hot keys: one order or product holding a large part of all rows."""

import contextlib

from pyspark.sql import functions as F

from demandloom.functions.tables import join_by_key, keep_first, left_join_by_key


@contextlib.contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SMALL_SPLITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
}


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_rows(spark):
    """Two thirds of the rows on key 0."""
    n = 60_000
    key = F.when(F.col("id") % 3 != 0, F.lit(0)).otherwise(F.col("id") % 997 + 1)
    return spark.range(0, n, numPartitions=4).select(key.alias("k"), F.col("id").alias("v"), F.rand(1).alias("w"))


def per_key(spark):
    """Already aggregated by key, hence partitioned by it."""
    return spark.range(0, 4_000, numPartitions=4).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("c"))


def test_hot_partition_is_split_even_after_an_aggregation(spark):
    with settings(spark, **SMALL_SPLITS):
        joined = join_by_key(hot_rows(spark), per_key(spark), "k", "inner")
        assert "skew=true" in final_plan(joined)
        assert joined.count() == 60_000


def test_plain_join_would_not_be_split(spark):
    with settings(spark, **SMALL_SPLITS):
        joined = hot_rows(spark).join(per_key(spark), "k", "inner")
        assert "skew=true" not in final_plan(joined)


def test_semi_join_is_split(spark):
    with settings(spark, **SMALL_SPLITS):
        joined = join_by_key(hot_rows(spark), per_key(spark).select("k"), "k", "left_semi")
        assert "skew=true" in final_plan(joined)
        assert joined.columns == ["k", "v", "w"]


def test_left_join_with_hot_right_side(spark):
    left = spark.range(0, 1_500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    with settings(spark, **SMALL_SPLITS):
        joined = left_join_by_key(left, hot_rows(spark), "k")
        assert "skew=true" in final_plan(joined)
        plain = left.join(hot_rows(spark), "k", "left")
        assert joined.columns == plain.columns
        assert joined.count() == plain.count()
        assert joined.filter("v is null").count() == plain.filter("v is null").count() > 0


def test_left_join_keeps_repeated_left_rows(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "b")], "k int, x string")
    right = spark.createDataFrame([(1, 10), (1, 11)], "k int, y int")
    rows = sorted(map(tuple, left_join_by_key(left, right, "k").collect()), key=str)
    assert rows == sorted([(1, "a", 10), (1, "a", 10), (1, "a", 11), (1, "a", 11), (2, "b", None), (2, "b", None)], key=str)


def test_copies_combine_before_the_shuffle(spark):
    copies = spark.range(0, 30_000, numPartitions=3).select(
        F.lit(7).alias("order_id"), F.lit("x").alias("a"), (F.col("id") % 5).alias("b")
    )
    first = keep_first(copies, ["order_id"])
    plan = final_plan(first)
    assert plan.index("partial_min") > plan.index("Exchange")  # below the exchange in the tree
    assert [tuple(r) for r in first.collect()] == [(7, "x", 0)]


def test_left_join_shuffles_each_side_once(spark):
    left = spark.range(0, 1_500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    joined = left_join_by_key(left, hot_rows(spark), "k")
    with settings(spark, **{"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "10k"}):
        plan = joined.select("*")._jdf.queryExecution().executedPlan().toString()
    # the few hot keys are broadcast: the only exchanges of rows are those of the join itself
    assert plan.count("Exchange hashpartitioning") == 2


def test_left_join_with_given_sizes_and_null_keys(spark):
    left = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "k int, x string")
    right = spark.range(0, 25_000).select(F.lit(1).alias("k"), F.col("id").alias("y")).unionByName(
        spark.range(0, 25_000).select(F.lit(None).cast("int").alias("k"), F.col("id").alias("y"))
    )
    sizes = right.groupBy("k").agg(F.count(F.lit(1)).alias("_rows"))
    for found in (left_join_by_key(left, right, "k"), left_join_by_key(left, right, "k", sizes)):
        got = {r["x"]: (r["n"], r["met"]) for r in found.groupBy("x").agg(F.count("*").alias("n"), F.count("y").alias("met")).collect()}
        assert got == {"a": (1, 0), "b": (25_000, 25_000), "c": (1, 0)}
