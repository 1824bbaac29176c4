"""SimHash near-duplicates: fingerprints linked through BK-trees of their shards.

Two 64-bit fingerprints within ``radius`` bits differ in at most ``radius`` of
``radius + 2`` blocks of bits, so they agree in at least two. Each pair of blocks
and their value name a shard; near fingerprints always share one. Every shard
is a BK-tree (children keyed by their Hamming distance to the parent), and a
lookup follows only the edges within the radius. A shard too large for one tree
becomes several, and each tree is sent to all later fingerprints of its shard, so
no pair is missed and no task holds more than one tree. Inside a tree only
links that join two groups come out, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.tables import join_by_key
from demandloom.llm.common import numbered, text_slices, worker_path
from demandloom.llm.components import components
from demandloom.session import materialize

SHINGLE = 4
RADIUS = 4
SEED = 42
BITS = 64
#: Fingerprints in one tree, about; a larger shard is split into several trees.
TREE_SIZE = 4096
#: Shingles hashed at once.
HASHED_AT_ONCE = 1 << 16
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text, as an unsigned number; 0 for a text without words."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for first in range(0, len(starts), HASHED_AT_ONCE):
        last = first + HASHED_AT_ONCE
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[first:last], ends[first:last])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    over_half = set_bits * 2 > len(starts)
    return int(np.packbits(over_half, bitorder="little").view(np.uint64)[0])


def _with_fingerprint(docs: DataFrame, shingle: int, keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` and ``_fp``, the fingerprint as a signed long."""
    worker_path(docs.sparkSession)
    keep = list(docs.columns if keep is None else keep)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = np.array([fingerprint(t, shingle) for t in part.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array(found.view(np.int64))], names=[*keep, "_fp"]
                )

    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("_fp", T.LongType())])
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(compute, schema)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for every row of ``docs``."""
    return _with_fingerprint(docs, shingle, ["doc_id"]).withColumnRenamed("_fp", "fp")


def _shards(fp: Column, radius: int) -> Column:
    """The shards of a fingerprint: for each pair of blocks, its number and the bits in it."""
    count = radius + 2
    edges = [BITS * i // count for i in range(count + 1)]
    blocks = [
        F.shiftrightunsigned(fp, edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1).cast("long"))
        for i in range(count)
    ]
    named = []
    for number, (a, b) in enumerate(combinations(range(count), 2)):
        named.append(F.struct(F.lit(number).alias("pair"), blocks[a].alias("x"), blocks[b].alias("y")))
    return F.array(*named)


class _Tree:
    """A BK-tree that also knows which of its fingerprints hang together."""

    def __init__(self, radius: int) -> None:
        self.radius = radius
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self.parent: list[int] = []

    def root(self, node: int) -> int:
        while self.parent[node] != node:
            self.parent[node] = self.parent[self.parent[node]]
            node = self.parent[node]
        return node

    def groups_near(self, value: int) -> set[int]:
        """Roots of the groups that have a fingerprint within the radius."""
        found: set[int] = set()
        pending = [0] if self.values else []
        while pending:
            node = pending.pop()
            distance = (value ^ self.values[node]).bit_count()
            if distance <= self.radius:
                found.add(self.root(node))
            low, high = distance - self.radius, distance + self.radius
            pending.extend(child for edge, child in self.children[node].items() if low <= edge <= high)
        return found

    def join(self, groups: set[int]) -> None:
        first = min(groups)
        for group in groups:
            self.parent[group] = first

    def insert(self, value: int) -> None:
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        self.parent.append(new)
        node = 0
        while new:
            distance = (value ^ self.values[node]).bit_count()
            child = self.children[node].get(distance)
            if child is None:
                self.children[node][distance] = new
                return
            node = child


def _link(radius: int):
    """Links of a partition sorted by tree, then fingerprints to insert before those that only look."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tree = None, _Tree(radius)
        for batch in batches:
            found: list[tuple[int, int]] = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("pair", "x", "y", "tree", "looks", "fp")))
            for pair, x, y, number, looks, fp in rows:
                if (pair, x, y, number) != current:
                    current, tree = (pair, x, y, number), _Tree(radius)
                value = fp & 0xFFFFFFFFFFFFFFFF
                groups = tree.groups_near(value)
                found.extend((value, tree.values[g]) for g in groups)
                if not looks:
                    tree.insert(value)
                    groups.add(len(tree.values) - 1)
                if len(groups) > 1:
                    tree.join(groups)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))], names=["u", "v"]
            )

    return link


def links(distinct: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints ``fp`` within ``radius`` bits, directly or by steps."""
    keys = ["pair", "x", "y"]
    sharded = distinct.select("fp", F.explode(_shards(F.col("fp"), radius)).alias("s")).select("fp", "s.*")
    sizes = sharded.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    trees = F.ceil(F.col("size") / tree_size).cast("int")
    own = F.pmod(F.xxhash64("fp"), trees).cast("int")
    sized = sharded.join(sizes, keys).select("fp", *keys, own.alias("own"))
    sent = sized.select("fp", *keys, "own", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("tree"))
    sent = sent.select("fp", *keys, "tree", (F.col("tree") < F.col("own")).alias("looks"))
    placed = sent.repartition(*keys, "tree").sortWithinPartitions(*keys, "tree", "looks", "fp")
    return placed.mapInArrow(_link(radius), "u long, v long")


def cluster(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tree_size: int = TREE_SIZE
) -> DataFrame:
    """(doc_id, fp, root, component_id) for every row of ``docs`` (columns doc_id, text).

    Fingerprints within ``radius`` bits are linked; ``root`` is the smallest
    fingerprint reachable and ``component_id`` the smallest doc_id that has a
    reachable fingerprint. Equal fingerprints meet as one, whatever their number.

    Null, empty and wordless texts have fingerprint 0 and are linked by it like
    any other. Null doc_ids stay rows of their own and never name a component
    that has another doc_id. Repeated rows each get their row. Empty table: no rows.
    """
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    return _clustered(prints, radius, tree_size).select("doc_id", "fp", "root", "component_id")


def _clustered(prints: DataFrame, radius: int, tree_size: int = TREE_SIZE) -> DataFrame:
    """Add ``root`` and ``component_id`` to stored rows with ``doc_id`` and ``fp``."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("smallest"))
    linked = components(links(distinct.select("fp"), radius, tree_size)).withColumnRenamed("node", "fp")
    # stored, since it is read twice: else the plan holds all steps before it twice, and the driver plans and compiles them
    rooted = materialize(
        distinct.join(linked, "fp", "left").select("fp", "smallest", F.coalesce("component", "fp").alias("root")), "rooted"
    )
    labels = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = join_by_key(rooted.select("fp", "root"), labels, "root")
    return join_by_key(prints, named, "fp")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` from each component, all columns kept: that of the smallest doc_id.

    Where the smallest doc_id comes more than once, the row with the smallest
    fingerprint stays, of rows equal in both one by a hash of doc_id and text, and of
    rows equal in these too the smallest by all columns. A component without any
    doc_id keeps one row in the same way. Each text is fingerprinted once.
    """
    inside, own_columns = numbered(docs)
    doc_id, text = (F.col(inside.columns[docs.columns.index(c)]) for c in ("doc_id", "text"))
    key = F.xxhash64(doc_id, text).alias("key")
    entered = inside.select(doc_id.alias("doc_id"), text.alias("text"), key)
    prints = materialize(_with_fingerprint(entered, shingle, ["doc_id", "key"]).withColumnRenamed("_fp", "fp"), "fingerprints")
    member = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "fp", "key")
    chosen = _clustered(prints, radius).groupBy("root").agg(F.min(member).alias("m"))
    chosen = chosen.select(_name(F.col("m.doc_id")).alias("name"), "m.key")
    kept = inside.select("*", _name(doc_id).alias("name"), key).join(chosen, ["name", "key"])
    first = Window.partitionBy("name", "key").orderBy(*inside.columns)
    return kept.withColumn("row", F.row_number().over(first)).where("row = 1").select(*own_columns)


def _name(doc_id: Column) -> Column:
    """The doc_id as a text that is never null."""
    return F.coalesce(F.concat(F.lit("d"), doc_id.cast("string")), F.lit("none"))
