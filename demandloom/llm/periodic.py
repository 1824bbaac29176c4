"""Periodic runs of words: stretches that repeat with a period, found exactly.

Every run of period q that holds at least three periods covers at least three
neighbouring multiples of q, so the words on the grid 0, q, 2q, ... show where it
can lie; over all q the grids have about n ln n points. Each place is extended to
both sides by longest common extensions on a grammar that recompression makes of
the words, without suffix arrays.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import WORD, text_slices, worker_path
from demandloom.llm.recompression import Grammar

#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
NO_RUNS = np.empty((0, 3), np.int64)


def _least(period):
    return np.maximum(LEAST_WORDS, LEAST_PERIODS * period)


def _in_a_row(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """The texts after one another, with an end before, between and after them that equals nothing else.

    Also the place where each starts, and the number of the first end.
    """
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes + 1) - sizes
    words = max(int(t.max()) for t in texts) + 1
    ends = np.r_[0, starts + sizes]
    letters = np.empty(int(ends[-1]) + 1, np.int64)
    inner = np.ones(len(letters), bool)
    inner[ends] = False
    letters[ends] = words + np.arange(len(ends))
    letters[inner] = np.concatenate(texts)
    return letters, starts, words


def _stretches(letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (period, first, last): the word is the same at first, first + period, ..., last, all multiples of period.

    Only stretches that a run can cover are returned. The texts come by falling
    size, so a period is looked for only in those that are long enough for it.
    """
    found = [NO_RUNS]
    period, longest = 1, int(sizes[0])
    while _least(period) <= longest:
        texts = int(np.searchsorted(-sizes, -_least(period), side="right"))
        grid = letters[: starts[texts - 1] + sizes[texts - 1] : period]
        same = grid[1:] == grid[:-1]
        if (same[1:] & same[:-1]).any():
            bounds = np.flatnonzero(np.diff(np.r_[False, same, False].astype(np.int8)))
            first, last = bounds[::2], bounds[1::2]
            enough = last - first >= _least(period) // period - 1
            first, last = first[enough], last[enough]
            found.append(np.column_stack([np.full(len(first), period), first * period, last * period]))
        period += 1
    return np.concatenate(found)


def _extended(grammar: Grammar, stretches: np.ndarray) -> np.ndarray:
    """Rows (start, end, period): the maximal extensions of the stretches that are long enough.

    One place of every stretch is extended at a time; the next one is the
    first grid point that another run of the same period can cover.
    """
    runs = [NO_RUNS]
    while len(stretches):
        period, first, last = stretches.T
        end = first + period + grammar.extend(first, first + period)
        start = first - grammar.extend(first - 1, first + period - 1, backward=True)
        good = end - start >= _least(period)
        runs.append(np.column_stack([start, end, period])[good])
        first = first + period * np.maximum(1, (end - first) // period)
        more = (last - first) // period >= _least(period) // period - 1
        stretches = np.column_stack([period, first, last])[more]
    return np.concatenate(runs)


def find_in(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each text (word numbers from 0 on) its runs as rows (start, length, period), by start, then period."""
    results = [NO_RUNS] * len(texts)
    order = [i for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])) if len(texts[i]) >= LEAST_WORDS]
    if not order:
        return results
    letters, starts, _ = _in_a_row([texts[i] for i in order])
    stretches = _stretches(letters, starts, np.array([len(texts[i]) for i in order]))
    if not len(stretches):
        return results
    # only texts with a candidate need a grammar
    owner = np.searchsorted(starts, stretches[:, 1], side="right") - 1
    used, owner = np.unique(owner, return_inverse=True)
    chosen = [order[i] for i in used]
    letters, moved, words = _in_a_row([texts[i] for i in chosen])
    stretches[:, 1:] += (moved - starts[used])[owner, None]
    runs = _extended(Grammar(letters, words, 4 * len(chosen) + 16), stretches)
    # of the periods of one stretch the smallest counts; it was found with the same bounds
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)]] if len(runs) else runs
    owner = np.searchsorted(moved, runs[:, 0], side="right") - 1
    runs = np.column_stack([runs[:, 0] - moved[owner], runs[:, 1] - runs[:, 0], runs[:, 2]])
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0], owner))]
    bounds = np.searchsorted(np.sort(owner), np.arange(len(chosen) + 1))
    for place, text in enumerate(chosen):
        results[text] = runs[bounds[place] : bounds[place + 1]]
    return results


def kept(size: int, runs: np.ndarray) -> np.ndarray:
    """Mask of the words that no run holds after its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed for each row of ``docs``.

    Words are the runs of anything but ASCII white space, numbered from 0. A run
    is a stretch of words with smallest period q, of at least ``LEAST_WORDS`` words
    and ``LEAST_PERIODS`` periods, that neither neighbour continues. ``collapsed``
    are the words that no run holds after its first period, joined by a space.

    A null or empty text has no words, no runs and an empty collapsed text. Equal
    rows each give a row; doc_id may be null. Columns other than doc_id and text
    are left out, whatever their names. Nothing is shuffled; a task holds a few
    megabytes of texts at a time, or one longer text.
    """
    worker_path(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    schema = (
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield _answer(part)

    return rows.mapInArrow(run, schema)


def _answer(part: pa.RecordBatch) -> pa.RecordBatch:
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    words = [(t or b"").split() for t in part.column("text").cast(pa.binary()).to_pylist()]
    texts = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words]
    found = find_in(texts)
    collapsed = []
    for text, runs in zip(words, found, strict=True):
        if len(runs):
            text = [w for w, stays in zip(text, kept(len(text), runs).tolist(), strict=True) if stays]
        collapsed.append(b" ".join(text))
    table = np.concatenate(found) if found else NO_RUNS
    columns = [pa.array(table[:, i]) for i in range(3)]
    offsets = np.r_[0, np.cumsum([len(r) for r in found])].astype(np.int32)
    runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
    sizes = pa.array([len(w) for w in words], pa.int64())
    text = pa.array(collapsed, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([part.column("doc_id"), sizes, runs, text], ["doc_id", "n_words", "runs", "collapsed"])


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared as whole numbers; of equal ones the first. Null without runs."""
    return F.aggregate(
        runs,
        F.get(runs, F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )


def repeat_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where documents with crc32(doc_id) divisible by ten end in repeats of a passage.

    With g = crc32 div 10, word i >= a = g % n becomes word a + (i - a) % p, where
    p = 1 + floor((n - a) / (3 + g % 8)). Other texts, also null ones, stay.
    """
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(0))
    chosen = F.col("_h") % 10 == 0
    named = docs.select("doc_id", "text").withColumn("_h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    split = named.withColumn("_words", F.when(chosen, words)).withColumn("_n", F.size("_words"))
    g = F.floor(F.col("_h") / 10)
    parts = split.withColumns({"_a": g % F.col("_n"), "_times": 3 + g % 8})
    a, n = F.col("_a").cast("int"), F.col("_n")
    sized = parts.withColumn("_p", (1 + F.floor((n - a) / F.col("_times"))).cast("int"))
    tail = F.flatten(F.array_repeat(F.slice("_words", a + 1, F.col("_p")), F.col("_times").cast("int")))
    edited = F.concat(F.slice("_words", F.lit(1), a), F.slice(tail, F.lit(1), n - a))
    return sized.select("doc_id", F.when(chosen & (n > 0), F.array_join(edited, " ")).otherwise(F.col("text")).alias("text"))


def digest(docs: DataFrame) -> DataFrame:
    """The runs of every document with repeated tails, as one row of figures and digests."""
    found = find_runs(repeat_tails(docs))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.col("_best")
    return found.withColumn("_best", strongest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
