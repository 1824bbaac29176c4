"""Exact top-k by inner product: distributed histogram selection.

Queries and candidates are packed into blocks, and every block of queries meets
every block of candidates in one row of an equi-join on the block number. Each
meeting is one matrix product, and only counts leave it:

1. Every round scores everything and counts the scores of each query in the bins
   of an interval, at first the whole range that scores can have. The counts are
   summed over all blocks, which locates the bin that holds the kth value; that
   bin is the next interval. Rounds go on until a bin is one score wide, so the
   kth value is known exactly.
2. A last pass keeps what is above the kth value, and of what equals it the
   smallest ids: at most k of them from each block can be in the answer.

Bins of a block below its own k best cannot hold the kth value of all blocks, so
they are not sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.common import worker_path
from demandloom.session import materialize

K = 5
SCALE = 256
#: Rows of a block of queries and, about, of a block of candidates: their scores take 8 MB.
QUERY_BLOCK = 256
CANDIDATE_BLOCK = 4096
#: A histogram has 2 ** BIN_BITS bins; 22 bits of score take two rounds.
BIN_BITS = 11
#: Scores that a long cannot hold count as the nearest one that it can.
LARGEST = (1 << 63) - 1
_EXACT = float(1 << 53)
_RESULT = "query_id long, rank int, vec_id long, score long"


def quantised(vectors: DataFrame, number: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, dims, values): floor(scale * x) of each component; null, empty or not finite vectors are left out."""
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # a whole number beyond 2**52 is its own floor, and the floor function would turn it into a long
    floored = F.transform(
        doubles,
        lambda x: F.when(F.abs(x * float(scale)) < _EXACT, F.floor(x * float(scale)).cast("double")).otherwise(x * float(scale)),
    )
    named = vectors.where(F.col(vector).isNotNull() & F.col(number).isNotNull() & (F.size(vector) > 0))
    return named.where(usable).select(F.col(number).cast("long").alias("id"), F.size(vector).alias("dims"), floored.alias("values"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block of a partition sorted by block: its ids and its vectors as bytes."""
    key: tuple[int, int] | None = None
    ids: list[np.ndarray] = []
    values: list[np.ndarray] = []

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()),
             pa.array([np.concatenate(ids).tobytes()], pa.binary()),
             pa.array([np.concatenate(values).tobytes()], pa.binary())],
            names=["dims", "block", "ids", "vectors"],
        )

    for batch in batches:
        dims = batch.column("dims").to_numpy(zero_copy_only=False)
        numbers = batch.column("block").to_numpy(zero_copy_only=False)
        cuts = (np.flatnonzero((np.diff(dims) != 0) | (np.diff(numbers) != 0)) + 1).tolist()
        for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
            if start == stop:
                continue
            here = (int(dims[start]), int(numbers[start]))
            if key is not None and here != key:
                yield block()
                ids, values = [], []
            key = here
            part = batch.slice(start, stop - start)
            ids.append(part.column("id").to_numpy(zero_copy_only=False).astype(np.int64))
            values.append(part.column("values").flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if ids:
        yield block()


def _by_dims(values: dict[int, int]):
    """A column that gives each vector length its number."""
    chosen = F.lit(0).cast("long")
    for dims, value in values.items():
        chosen = F.when(F.col("dims") == dims, F.lit(value).cast("long")).otherwise(chosen)
    return chosen


def _blocks(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """(dims, block, ids, vectors): rows dealt to ``counts[dims]`` blocks of about equal size."""
    # the hash also sees the vector, so that equal ids do not all meet in one block
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "values"), _by_dims(counts)))
    placed = dealt.repartition("dims", "block").sortWithinPartitions("dims", "block", "id")
    return placed.mapInArrow(_pack, "dims int, block long, ids binary, vectors binary")


def _scores(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids, all scores of two blocks, and which of them are between rows of different ids."""
    dims = row["dims"]
    q_ids, c_ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
    q = np.frombuffer(row["q_vectors"], np.float64).reshape(len(q_ids), dims)
    c = np.frombuffer(row["vectors"], np.float64).reshape(len(c_ids), dims)
    if dims * np.abs(q).max() * np.abs(c).max() < _EXACT:
        scores = (q @ c.T).astype(np.int64)
    else:  # sums that a double can't hold: Python's whole numbers
        whole = [[int(x) for x in line] for line in c.tolist()]
        exact = [[sum(int(a) * b for a, b in zip(x, y)) for y in whole] for x in q.tolist()]
        scores = np.array([[max(-LARGEST, min(LARGEST, s)) for s in line] for line in exact], np.int64)
    return q_ids, c_ids, scores, q_ids[:, None] != c_ids[None, :]


def _count(k: int, bits: int, shift: int):
    """Counts by query and bin of what lies in each query's interval of 2 ** bits, from its top down to k scores."""
    bins = 1 << (bits - shift)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, _, scores, other = _scores(row)
                lows = np.array(row["lows"], np.int64)[:, None]
                # the difference of two longs, which takes 64 bits without a sign
                above = scores.view(np.uint64) - lows.view(np.uint64)
                places = above >> np.uint64(shift)
                inside = other & (scores >= lows) & (places < np.uint64(bins))
                flat = (places + np.arange(len(lows), dtype=np.uint64)[:, None] * np.uint64(bins))[inside]
                counts = np.bincount(flat.astype(np.int64), minlength=len(lows) * bins).reshape(len(lows), bins)
                from_top = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]
                query, place = np.nonzero((counts > 0) & (from_top - counts < k))
                n = len(query)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["dims"], np.int32)), pa.array(np.full(n, row["q_block"], np.int64)),
                     pa.array(query.astype(np.int32)), pa.array(place.astype(np.int64)), pa.array(counts[query, place])],
                    names=["dims", "q_block", "q", "bin", "n"],
                )

    return count


def _answers(k: int):
    """All scores above each query's kth value, and of those equal to it the k with the smallest ids."""

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, c_ids, scores, other = _scores(row)
                lows = np.array(row["lows"], np.int64)[:, None]
                by_id = np.argsort(c_ids, kind="stable")
                ties = ((scores == lows) & other)[:, by_id]
                first = np.zeros_like(ties)
                first[:, by_id] = ties & (np.cumsum(ties, axis=1) <= k)
                query, place = np.nonzero(((scores > lows) & other) | first)
                n = len(query)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["dims"], np.int32)), pa.array(np.full(n, row["q_block"], np.int64)),
                     pa.array(query.astype(np.int32)), pa.array(q_ids[query]), pa.array(c_ids[place]),
                     pa.array(scores[query, place])],
                    names=["dims", "q_block", "q", "query_id", "vec_id", "score"],
                )

    return answers


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores, ties to the smaller vec_id.

    Both tables come from :func:`quantised`. A query meets all candidates of its
    length but those of its own id. With fewer than k candidates it gets all.

    Null ids, null, empty and not finite vectors take no part. Repeated rows are
    candidates each, and each repeated query row gets its own answer. Scores
    beyond 64 bits are held at the ends. Empty tables: no rows.
    """
    spark = queries.sparkSession
    worker_path(spark)
    queries, candidates = materialize(queries, "queries"), materialize(candidates, "candidates")
    largest = F.max(F.array_max(F.transform("values", lambda x: F.abs(x))))
    # one row for each vector length
    asked = {r["dims"]: r for r in queries.groupBy("dims").agg(F.count("*").alias("n"), largest.alias("most")).collect()}
    offered = {
        r["dims"]: r for r in candidates.groupBy("dims").agg(F.count("*").alias("n"), largest.alias("most")).collect()
    }
    both = sorted(set(asked) & set(offered))
    if not both:
        return spark.createDataFrame([], _RESULT)
    bound = int(min(float(LARGEST), max(d * asked[d]["most"] * offered[d]["most"] + 1 for d in both)))
    bound = min(bound, LARGEST)
    blocks = {d: -(-offered[d]["n"] // CANDIDATE_BLOCK) for d in both}
    wanted = F.col("dims").isin(both)
    packed = materialize(_blocks(candidates.where(wanted), blocks), "candidate-blocks")
    asking = _blocks(queries.where(wanted), {d: -(-asked[d]["n"] // QUERY_BLOCK) for d in both})
    asking = materialize(
        asking.select("dims", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")),
        "query-blocks",
    )
    rows = (F.octet_length("q_ids") / 8).cast("int")
    state = asking.select("dims", "q_block", F.array_repeat(F.lit(-bound), rows).alias("lows"),
                          F.array_repeat(F.lit(k).cast("long"), rows).alias("left"))

    def meetings() -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("long"), _by_dims(blocks) - 1)).alias("block")
        sent = asking.join(state, ["dims", "q_block"]).select("dims", "q_block", "q_ids", "q_vectors", "lows", every)
        return sent.join(packed, ["dims", "block"]).select(
            "dims", "q_block", "q_ids", "q_vectors", "lows", "ids", "vectors"
        )

    bits = (2 * bound + 1).bit_length()
    while bits > 0:
        shift = max(0, bits - BIN_BITS)
        counts = meetings().mapInArrow(_count(k, bits, shift), "dims int, q_block long, q int, bin long, n long")
        summed = counts.groupBy("dims", "q_block", "q", "bin").agg(F.sum("n").alias("n"))
        state = materialize(_refined(state, summed, shift), "intervals")
        bits = shift
    found = meetings().mapInArrow(
        _answers(k), "dims int, q_block long, q int, query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("dims", "q_block", "q").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _refined(state: DataFrame, summed: DataFrame, shift: int) -> DataFrame:
    """The bin that holds each query's kth value becomes its interval; ``left`` is its place among the bin's scores.

    A query with fewer scores than it needs ends in its lowest bin and so keeps
    them all; one without any score keeps its interval.
    """
    each = state.select("dims", "q_block", F.explode(F.arrays_zip(
        F.sequence(F.lit(0), F.size("lows") - 1).alias("q"), F.col("lows").alias("low"), F.col("left").alias("left")
    )).alias("s")).select("dims", "q_block", F.col("s.q").alias("q"), F.col("s.low").alias("low"), F.col("s.left").alias("left"))
    keys = ["dims", "q_block", "q"]
    down = Window.partitionBy(*keys).orderBy(F.desc("bin"))
    above = F.coalesce(F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("above")
    placed = summed.select(*keys, "bin", above)
    chosen = (
        placed.join(each, keys).where("above < left").groupBy(*keys).agg(F.min(F.struct("bin", "above")).alias("c"))
    )
    moved = each.join(chosen, keys, "left").select(
        *keys,
        # the sum of the offset may pass the largest long before the low end is added
        F.expr(f"CAST(low + coalesce(c.bin, 0) * CAST({1 << shift} AS DECIMAL(38, 0)) AS BIGINT)").alias("low"),
        (F.col("left") - F.coalesce(F.col("c.above"), F.lit(0))).alias("left"),
    )
    # at most QUERY_BLOCK or so entries come together here
    listed = moved.groupBy("dims", "q_block").agg(F.array_sort(F.collect_list(F.struct("q", "low", "left"))).alias("a"))
    return listed.select("dims", "q_block", F.col("a.low").alias("lows"), F.col("a.left").alias("left"))


def search(vectors: DataFrame, every: int = 50, k: int = K) -> DataFrame:
    """The top k for the rows whose vec_id is divisible by ``every`` (columns vec_id, embedding)."""
    candidates = quantised(vectors, "vec_id", "embedding")
    return top_k(candidates.where(F.pmod("id", F.lit(every)) == 0), candidates, k)


#: The same rows in DuckDB's SQL.
ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
