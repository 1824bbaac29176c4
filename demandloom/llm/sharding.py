"""Sharding by balanced label propagation over groups of equal texts.

Documents are linked when their texts are equal. All members of a group are
alike to the propagation, so its state is one row per group and shard: how many
members of the group the shard holds. In each round every group looks where most
of its members are (in as many shards as it needs) and the others ask to move there; a shard takes as many as
its quota has room for, those of the largest gatherings first. Documents without
a link count against no room, since they can go anywhere: at the end they fill
what the quotas leave. The counts of the shards differ by one at most (the law
``rows``), and an edge is cut only where a group does not fit into a shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.tables import join_by_key
from demandloom.llm.common import running_total
from demandloom.session import materialize

SHARDS = 40
ROUNDS = 6
#: Bytes that a document counts beside its text.
OVERHEAD = 16
#: Parts of a group, a shard's cells or the loose documents that are numbered on their own.
PARTS = 1024


def _part(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(PARTS))


def _base(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.md5(text).alias("group"),
    )


def _quotas(rows: int, shards: int) -> list[int]:
    """Rows of each shard: at most one apart."""
    return [rows // shards + (1 if shard < rows % shards else 0) for shard in range(shards)]


def _pick(values: list[int], index: str) -> Column:
    return F.get(F.lit(values).cast("array<long>"), F.col(index))


def _first_cells(base: DataFrame, shards: int) -> DataFrame:
    """(group, shard, n) of all groups with two members or more, after a random start."""
    start = F.pmod(F.xxhash64("doc_id", "group"), F.lit(shards)).cast("int")
    counted = base.groupBy("group", start.alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    members = F.sum("n").over(Window.partitionBy("group"))
    return counted.withColumn("members", members).where("members > 1").select("group", "shard", "n")


def _move(cells: DataFrame, quotas: list[int]) -> DataFrame:
    """One round: (group, shard, n, moved), where ``moved`` counts the members that changed their shard."""
    used = dict(cells.groupBy("shard").agg(F.sum("n")).collect())  # one row per shard
    room = [max(0, quota - used.get(shard, 0)) for shard, quota in enumerate(quotas)]
    # a group's homes are its strongest shards that have room, as many as what is not yet settled needs; a shard that
    # the group fills alone is settled, and no one leaves a stronger gathering for a weaker one
    waiting = cells.where(F.col("n") < _pick(quotas, "shard"))
    group = Window.partitionBy("group")
    has_room = (_pick(room, "shard") > 0).desc()
    rank = F.row_number().over(group.orderBy(has_room, F.desc("n"), F.xxhash64("group", "shard")))
    needed = F.ceil(F.sum("n").over(group) / max(quotas)).cast("int")
    ranked = waiting.select("group", "shard", "n", rank.alias("rank"), needed.alias("needed"))
    strongest = F.when(F.col("rank") <= F.col("needed"), F.struct("rank", "shard", "n"))
    # at most one entry per shard comes together for a group
    aimed = ranked.withColumn("homes", F.array_sort(F.collect_list(strongest).over(group)))
    home = F.get("homes", F.pmod(F.col("rank") - 1, F.size("homes")))
    asks = aimed.where("rank > needed").select("group", "shard", "n", home["shard"].alias("home"), home["n"].alias("gathered"))
    asks = asks.where("gathered >= n")
    # the strongest gatherings first, within them by group
    level = F.lpad((63 - F.floor(F.log2("gathered"))).cast("string"), 2, "0")
    asks = asks.withColumn("part", F.concat(level, F.substring("group", 1, 2)))
    queued = running_total(asks, ["home"], "part", [F.col("group"), F.col("shard")], F.col("n"), "before")
    taken = F.greatest(F.lit(0), F.least(F.col("n"), _pick(room, "home") - F.col("before"))).cast("long")
    moves = queued.select("group", "shard", "home", taken.alias("moved")).where("moved > 0")
    unmoved = F.lit(0).cast("long")
    changes = (
        cells.select("group", "shard", "n", unmoved.alias("moved"))
        .union(moves.select("group", "shard", -F.col("moved"), "moved"))
        .union(moves.select("group", F.col("home"), "moved", unmoved))
    )
    return changes.groupBy("group", "shard").agg(F.sum("n").alias("n"), F.sum("moved").alias("moved")).where("n > 0 OR moved > 0")


def propagate(base: DataFrame, quotas: list[int], rounds: int = ROUNDS) -> DataFrame:
    """(group, shard, n): how many members of each group of equal texts every shard holds; none is over its quota."""
    cells = materialize(_first_cells(base, len(quotas)), "cells")
    for _ in range(rounds):
        after = materialize(_move(cells, quotas), "cells")
        moved = after.agg(F.sum("moved")).first()[0]
        cells = after.where("n > 0").select("group", "shard", "n")
        if not moved:
            break
    # the random start may have put too many linked documents into a shard: those beyond its quota become loose
    level = F.lpad((63 - F.floor(F.log2("n"))).cast("string"), 2, "0")
    leveled = cells.withColumn("part", F.concat(level, F.substring("group", 1, 2)))
    queued = running_total(leveled, ["shard"], "part", [F.col("group")], F.col("n"), "before")
    kept = F.greatest(F.lit(0), F.least(F.col("n"), _pick(quotas, "shard") - F.col("before"))).cast("long")
    return queued.select("group", "shard", kept.alias("n")).where("n > 0")


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs`` (columns doc_id, text).

    The law is ``rows``: counts of the shards differ by one at most, and
    ``slot`` numbers each shard's rows from 0 without a gap. ``grown_shard`` is
    null, since that law says nothing about one more shard.

    Null text: as an empty one, linked to other empty ones. Null and repeated
    doc_ids, repeated rows: each row gets a slot of its own. Fewer rows than
    shards: some shards stay empty. Empty table: no rows. The result is the same
    on every run over the same rows.
    """
    base = materialize(_base(docs), "documents-by-text")
    quotas = _quotas(base.count(), shards)
    cells = materialize(propagate(base, quotas, rounds), "cells")
    by_shard = dict(cells.groupBy("shard").agg(F.sum("n")).collect())  # one row per shard
    held = [by_shard.get(shard, 0) for shard in range(shards)]

    cells = cells.withColumn("part", F.substring("group", 1, 3))
    slots = running_total(cells, ["shard"], "part", [F.col("group")], F.col("n"), "slot")
    in_group = Window.partitionBy("group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    spans = slots.withColumn("begin", F.coalesce(F.sum("n").over(in_group), F.lit(0)))
    # at most one entry per shard comes together for a group
    homes = spans.groupBy("group").agg(F.collect_list(F.struct("begin", "n", "shard", "slot")).alias("homes"))

    rows = base.withColumn("part", _part("doc_id"))
    one = F.lit(1)
    numbered = running_total(rows, ["group"], "part", [F.col("doc_id")], one, "number").drop("part")
    met = join_by_key(numbered, homes, "group", "left")
    home = F.get(
        F.filter("homes", lambda h: (F.col("number") >= h["begin"]) & (F.col("number") < h["begin"] + h["n"])), F.lit(0)
    )
    met = materialize(met.withColumn("home", home).drop("homes"), "placed")

    settled = met.where("home IS NOT NULL").select(
        "doc_id", "size", "text_crc32", F.col("home.shard").alias("shard"),
        (F.col("home.slot") + F.col("number") - F.col("home.begin")).alias("slot"),
    )
    loose = met.where("home IS NULL").withColumn("part", _part("doc_id", "group"))
    order = [F.col("doc_id"), F.col("group"), F.col("number")]
    ranked = running_total(loose, [], "part", order, one, "place")
    ends, total = [], 0
    for quota, count in zip(quotas, held):
        total += quota - count
        ends.append(total)
    filled = ranked.withColumn("shard", F.size(F.filter(F.lit(ends).cast("array<long>"), lambda e: e <= F.col("place"))))
    offsets = [count - (end - (quota - count)) for quota, count, end in zip(quotas, held, ends)]
    spread = filled.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") + _pick(offsets, "shard")).alias("slot")
    )
    return settled.unionByName(spread).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
