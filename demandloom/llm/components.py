"""Connected components of a distributed edge list by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.tables import join_by_key
from demandloom.session import materialize


def _smallest_neighbour(pairs: DataFrame) -> DataFrame:
    """For each ``u`` the smallest of itself and its neighbours ``v``; a minimum combines on the map side."""
    return pairs.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    met = join_by_key(both, _smallest_neighbour(both), "u")
    return met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every smaller neighbour of a node, and the node, on the smallest of them.

    The row of the smallest neighbour itself, which every node has, gives the node's own edge,
    so that the plan reads the edges twice only.
    """
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    met = join_by_key(down, _smallest_neighbour(down), "u")
    return met.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v): the smallest node reachable.

    Both columns are long and not null; loops and repeated edges do no harm. The
    number of rounds grows with the logarithm of the longest path. Each round is
    written to the shared folder, and only its size and checksum reach the
    driver, to see whether anything changed.
    """
    checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    stored = materialize(edges.distinct(), "edges")
    current = stored.where("u <> v")
    state = None
    while True:
        row = current.agg(F.count(F.lit(1)), checksum).first()
        if row[0] == 0 or tuple(row) == state:
            break
        state = tuple(row)
        current = materialize(_small_star(_large_star(current)), "edges")
    loops = stored.where("u = v").select(F.col("u").alias("node"), F.col("v").alias("component"))
    hung = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    found = hung.union(roots).distinct()
    return found.union(loops.join(found, "node", "left_anti").distinct())
