"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers cut the bytes of a text. The places where both cut split the
tokens into groups, and two tokens are linked when their bytes overlap. A text is
handled as byte ranges: the tokens that end in a range make a fragment of an open
prefix (up to its first common cut), closed groups, and an open suffix. Fragments
compose associatively, so the ranges of a very long text are tokenized in
different Spark tasks and reduced as a tree.
"""

from __future__ import annotations

import json
import os
import pickle
import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain, islice, repeat
from typing import NamedTuple

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import sentencepiece  # noqa: E402
import tiktoken  # noqa: E402
from pyspark import TaskContext  # noqa: E402
from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from demandloom.functions.tables import join_by_key  # noqa: E402
from demandloom.llm.common import text_slices, worker_path  # noqa: E402
from demandloom.session import materialize  # noqa: E402

#: A text of more bytes is cut into ranges of about so many characters.
RANGE = 32_768
#: Neither tokenizer joins what stands before a single space between two other characters to what stands after it.
CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
#: A text without these is cut at each space.
UNUSUAL = re.compile(r"[\s▁] | [\s▁]|^ | $|^▁|^\s")
#: Pieces that can stand in a row, with a cut between them.
PLAIN = re.compile(r"(?=[^\s▁])[^▁]*(?<!\s)")
#: How byte-level BPE cuts a text before it merges: a fixed pattern.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Letters of distinct pieces that a worker remembers, and pieces that it aligns at once.
REMEMBERED, LEARNED_AT_ONCE = 4_000_000, 10_000
#: Fragments that one step of the tree composes.
FAN_IN = 8
#: Distinct links of documents that are counted and looked up together.
BLOCK_LINKS = 400_000


class Tokens(NamedTuple):
    """Ids of A and B, and the byte where each token ends."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def between(self, low: int, high: int) -> Tokens:
        """Tokens whose end is over ``low`` and at most ``high``."""
        i, j = np.searchsorted(self.a_ends, [low, high], side="right")
        k, m = np.searchsorted(self.b_ends, [low, high], side="right")
        return Tokens(self.a[i:j], self.a_ends[i:j], self.b[k:m], self.b_ends[k:m])

    def then(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(pair) for pair in zip(self, other, strict=True)))


NOTHING = Tokens(*(np.empty(0, np.int64) for _ in range(4)))


class Closed(NamedTuple):
    """Groups as text, each with a semicolon after it, and the linked id pairs (A << 32 | B) with how often each occurs."""

    n_groups: int
    groups: str
    pairs: np.ndarray
    times: np.ndarray

    def then(self, other: Closed) -> Closed:
        if not self.n_groups or not other.n_groups:
            return other if other.n_groups else self
        pairs, where = np.unique(np.concatenate([self.pairs, other.pairs]), return_inverse=True)
        times = np.bincount(where, np.concatenate([self.times, other.times])).astype(np.int64)
        return Closed(self.n_groups + other.n_groups, self.groups + other.groups, pairs, times)


EMPTY = Closed(0, "", np.empty(0, np.int64), np.empty(0, np.int64))


class Fragment(NamedTuple):
    """Tokens that end in a byte range; without a common cut (``cut`` false) all of them are the prefix."""

    n_a: int
    n_b: int
    cut: bool
    prefix: Tokens
    closed: Closed
    suffix: Tokens


#: The start of a text is a common cut.
START = Fragment(0, 0, True, NOTHING, EMPTY, NOTHING)
#: Changes nothing that it is composed with.
IDENTITY = Fragment(0, 0, False, NOTHING, EMPTY, NOTHING)


@lru_cache(maxsize=2)
def _labels(size: int) -> dict[str, np.ndarray]:
    return {mark: np.array([f"{i}{mark}" for i in range(size)], object) for mark in ",|;"}


def _met(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of tokens that begin and end at a common cut: the cuts, the groups as texts token by token, all ends, and the pair linked before each."""
    a, a_ends, b, b_ends = tokens
    cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
    group_a, group_b = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
    most = int(max(a.max(initial=0), b.max(initial=0)))
    label = _labels(max(1 << 16, 1 << most.bit_length()))
    parts = np.empty(len(a) + len(b), object)
    last_a, last_b = (a_ends == cuts[group_a], b_ends == cuts[group_b]) if len(a) else (a > 0, b > 0)
    parts[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = np.where(last_a, label["|"][a], label[","][a])
    after = np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")
    parts[after] = np.where(last_b, label[";"][b], label[","][b])
    # every stretch between two neighbouring ends lies in one token of each
    ends = np.union1d(a_ends, b_ends)
    linked = (a[np.searchsorted(a_ends, ends)] << 32) | b[np.searchsorted(b_ends, ends)]
    return cuts, parts, ends, linked


def close(tokens: Tokens) -> Closed:
    """The groups of tokens that begin and end at a common cut."""
    if not len(tokens.a):
        return EMPTY
    cuts, parts, _, linked = _met(tokens)
    return Closed(len(cuts), "".join(parts.tolist()), *_counted(linked))


def fragment(tokens: Tokens) -> Fragment:
    cuts = np.intersect1d(tokens.a_ends, tokens.b_ends, assume_unique=True)
    sizes = len(tokens.a), len(tokens.b)
    if not len(cuts):
        return Fragment(*sizes, False, tokens, EMPTY, NOTHING)
    first, last = cuts[0], cuts[-1]
    end = np.iinfo(np.int64).max
    return Fragment(*sizes, True, tokens.between(-1, first), close(tokens.between(first, last)), tokens.between(last, end))


def compose(x: Fragment | None, y: Fragment | None) -> Fragment | None:
    """The fragment of both ranges, ``y`` right after ``x``; None (bytes that are not those of the text) stays None."""
    if x is None or y is None:
        return None
    sizes = x.n_a + y.n_a, x.n_b + y.n_b
    if not x.cut:
        return Fragment(*sizes, y.cut, x.prefix.then(y.prefix), y.closed, y.suffix)
    if not y.cut:
        return Fragment(*sizes, True, x.prefix, x.closed, x.suffix.then(y.prefix))
    middle = close(x.suffix.then(y.prefix))
    return Fragment(*sizes, True, x.prefix, x.closed.then(middle).then(y.closed), y.suffix)


class Aligner:
    """Byte-level BPE (A), a sentencepiece model (B), and the pieces of text that a worker has aligned so far.

    A text is cut into pieces where neither tokenizer ever joins what is left and right, words mostly. Each
    distinct piece is tokenized and closed once; a fragment is put together from its pieces.
    """

    def __init__(self, byte_path: str, piece_path: str) -> None:
        letters = byte_letters()
        whole = Tokenizer.from_file(byte_path)
        entries = {i: bytes(letters[c] for c in text) for text, i in whole.get_vocab().items()}
        self.a_bytes = [entries.get(i, b"") for i in range(max(entries) + 1)]
        ranks = _ranks(byte_path)
        if ranks:  # the same tokens, several times as fast
            self.encode = tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            whole.no_truncation()
            whole.no_padding()
            whole.encode_special_tokens = True
            self.encode = lambda text: whole.encode(text, add_special_tokens=False).ids
        self.b = b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.b_bytes = [
            bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(b.get_piece_size())
        ]
        self.a_sizes = np.array([len(t) for t in self.a_bytes])
        self.b_sizes = np.array([len(t) for t in self.b_bytes])
        self.numbers: dict[str, int] = {}
        self.letters = 0
        self.groups: list[str] = []
        self.sizes = np.empty((0, 3), np.int64)  # tokens of A and of B, groups; -1 where the bytes are others
        self.pairs = np.empty(0, np.int64)
        self.cuts = np.zeros(1, np.int64)  # the pairs of piece i lie between cuts[i] and cuts[i + 1]

    def _forget(self) -> None:
        """Keep the first pieces, up to half the letters: what comes first in a corpus comes often."""
        kept = int(np.searchsorted(np.cumsum(np.fromiter(map(len, self.numbers), np.int64)), REMEMBERED // 2))
        self.numbers = dict(islice(self.numbers.items(), kept))
        self.letters = sum(map(len, self.numbers))
        del self.groups[kept:]
        self.sizes, self.cuts = self.sizes[:kept].copy(), self.cuts[: kept + 1].copy()
        self.pairs = self.pairs[: self.cuts[-1]].copy()

    def _tokens(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of A and B for each text after a space; None where the bytes of a tokenizer's ids are not those of the text."""
        spaced = [" " + t for t in texts]
        of_a = map(self.encode, spaced)
        found: list[tuple[list[int], list[int]] | None] = []
        for text, a, b in zip(spaced, of_a, self.b.encode(texts, num_threads=1), strict=True):
            whole = text.encode()
            kept = b"".join([self.a_bytes[i] for i in a]) == whole == b"".join([self.b_bytes[i] for i in b])
            found.append((a, b) if kept else None)
        return found

    def _learn(self, fresh: list[str]) -> None:
        """Align pieces that are not known yet, as if they stood in one text; most of them are also tokenized in a row."""
        for first in range(0, len(fresh), LEARNED_AT_ONCE):
            some = fresh[first : first + LEARNED_AT_ONCE]
            rows = [p for p in some if PLAIN.fullmatch(p)]
            single = [p for p in some if not PLAIN.fullmatch(p)]
            units = [rows[i : i + 256] for i in range(0, len(rows), 256)]
            found = self._tokens([" ".join(u) for u in units])
            single += [p for u, t in zip(units, found, strict=True) if t is None for p in u]
            units = [u for u, t in zip(units, found, strict=True) if t is not None]
            found = [t for t in found if t is not None]
            alone = self._tokens(single)
            units += [[p] for p, t in zip(single, alone, strict=True) if t is not None]
            found += [t for t in alone if t is not None]
            self._close(list(chain.from_iterable(units)), found)
            self._add([p for p, t in zip(single, alone, strict=True) if t is None])

    def _close(self, some: list[str], found: list[tuple[list[int], list[int]]]) -> None:
        a, b = (np.fromiter(chain.from_iterable(t[i] for t in found), np.int64) for i in (0, 1))
        one = Tokens(a, np.cumsum(self.a_sizes[a]), b, np.cumsum(self.b_sizes[b]))
        cuts, parts, ends, linked = _met(one)
        stops = np.cumsum(np.fromiter((1 + len(p.encode()) for p in some), np.int64, len(some)))
        a_to, b_to, groups, links = (np.searchsorted(e, stops, side="right") for e in (one.a_ends, one.b_ends, cuts, ends))
        strings, total = parts.tolist(), [0, *(a_to + b_to).tolist()]
        sizes = np.diff(np.column_stack([a_to, b_to, groups]), axis=0, prepend=np.zeros((1, 3), np.int64))
        texts = ["".join(strings[i:j]) for i, j in zip(total, total[1:], strict=False)]
        self._add(some, texts, sizes, links, linked)

    def _add(self, some: list[str], groups=None, sizes=None, links=None, linked=None) -> None:
        """Remember pieces; those without groups have bytes that are not kept."""
        if groups is None:
            groups, sizes = [""] * len(some), np.full((len(some), 3), -1)
            links, linked = np.zeros(len(some), np.int64), np.empty(0, np.int64)
        self.groups += groups
        self.sizes = np.concatenate([self.sizes, sizes])
        self.cuts = np.concatenate([self.cuts, self.cuts[-1] + links])
        self.pairs = np.concatenate([self.pairs, linked])
        self.numbers.update(zip(some, range(len(self.numbers), len(self.numbers) + len(some)), strict=True))
        self.letters += sum(map(len, some))

    def fragments(self, texts: list[str]) -> list[Fragment | None]:
        """A fragment for each text that stands after a space at a common cut; None where bytes are not kept."""
        if self.letters > REMEMBERED:
            self._forget()
        cut = [_cut(t) for t in texts]
        every = list(chain.from_iterable(cut))
        numbers = np.fromiter(map(self.numbers.get, every, repeat(-1)), np.int64, len(every))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            unknown = [every[i] for i in missing.tolist()]
            self._learn(list(dict.fromkeys(unknown)))
            numbers[missing] = np.fromiter(map(self.numbers.__getitem__, unknown), np.int64, len(unknown))
        stops = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
        starts = self.cuts[numbers]
        lengths = self.cuts[numbers + 1] - starts
        ends = np.cumsum(lengths)
        linked = self.pairs[np.repeat(starts - ends + lengths, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]
        link_stops = np.concatenate([[0], ends])[stops]
        sizes = self.sizes[numbers]
        counted = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(sizes, axis=0)])[np.concatenate([[0], stops])]
        held = np.diff(counted, axis=0).tolist()
        broken = np.concatenate([[0], np.cumsum(sizes[:, 0] < 0)])[np.concatenate([[0], stops])].tolist()
        strings = list(map(self.groups.__getitem__, numbers.tolist()))
        found: list[Fragment | None] = []
        start = link_start = 0
        for i, (stop, link_stop) in enumerate(zip(stops.tolist(), link_stops.tolist(), strict=True)):
            if broken[i + 1] > broken[i]:
                found.append(None)
            else:
                n_a, n_b, n_groups = held[i]
                closed = Closed(n_groups, "".join(strings[start:stop]), *_counted(linked[link_start:link_stop]))
                found.append(Fragment(n_a, n_b, True, NOTHING, closed, NOTHING))
            start, link_start = stop, link_stop
        return found


def _counted(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and how often each occurs."""
    ordered = np.sort(linked)
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    return ordered[first], np.diff(first, append=len(ordered))


def _cut(text: str) -> list[str]:
    """The pieces of a text after a space, each without the space before it."""
    if not UNUSUAL.search(text):
        return text.split(" ")
    text = " " + text
    bounds = [0, *(m.start() for m in CUT.finditer(text)), len(text)]
    return [text[i + 1 : j] for i, j in zip(bounds, bounds[1:], strict=False)]


def _ranks(path: str) -> dict[bytes, int] | None:
    """The entries of a byte-level BPE as merge ranks, if its ids are those ranks and it cuts by the usual pattern."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    vocabulary, merges, before = model["model"]["vocab"], model["model"]["merges"], model["pre_tokenizer"]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
    if model["normalizer"] or before["type"] != "ByteLevel" or not before.get("use_regex", True):
        return None
    if any(vocabulary[text] != 256 + rank for rank, text in enumerate(merged)):
        return None
    letters = byte_letters()
    return {bytes(letters[c] for c in text): i for text, i in vocabulary.items() if i < 256 + len(merged)}


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level entry stands for."""
    shown = [i for i in range(256) if 33 <= i <= 126 or 161 <= i <= 172 or i >= 174]
    hidden = [i for i in range(256) if i not in shown]
    return {chr(i): i for i in shown} | {chr(256 + n): i for n, i in enumerate(hidden)}


@lru_cache(maxsize=2)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


def ranges(text: str) -> Iterator[str]:
    """A text after a space in ranges after a cut each, without the spaces of the cuts."""
    start, text = 0, " " + text
    while start < len(text):
        found = CUT.search(text, start + RANGE)
        stop = found.start() if found else len(text)
        yield text[start + 1 : stop]
        start = stop


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One row for each row of ``docs``: how the tokens of A over " " + text and of B over the text lie on its bytes.

    doc_id, n_a, n_b, n_groups and n_links long; groups string: ``a1,a2|b1;a3|b2,b3``,
    the decimal ids of each group in order; link_a, link_b, link_times: the distinct
    linked id pairs, and how many pairs of occurrences each has; block long: rows
    that ``count_links`` handles together. A null or empty text, and one whose
    bytes a tokenizer does not keep, has zeros, an empty ``groups`` and no links.
    doc_id may be null or repeated. Columns other than doc_id and text are left
    out, whatever their names.

    Texts of over ``RANGE`` bytes are cut into ranges that are dealt to all tasks;
    their fragments are composed ``FAN_IN`` at a time. Only the last step of a tree holds one whole document.
    """
    spark = docs.sparkSession
    worker_path(spark)
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, "
        "link_a array<int>, link_b array<int>, link_times array<int>, block long"
    )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, block = aligner(byte_path, piece_path), _Blocks()
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                texts = part.column("text").to_pylist()
                held = [i for i, t in enumerate(texts) if t]
                found: list[Fragment | None] = [None] * len(texts)
                for i, frag in zip(held, both.fragments([texts[i] for i in held]), strict=True):
                    found[i] = frag
                yield _aligned(part.column("doc_id"), [compose(START, f) for f in found], block)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cuts = list(ranges(batch.column("text")[i].as_py()))
                number = pa.array(range(len(cuts)), pa.int64())
                same = [pa.repeat(batch.column(c)[i], len(cuts)) for c in ("key", "doc_id")]
                yield pa.RecordBatch.from_arrays([*same, number, pa.array(cuts, pa.string())], ["key", "doc_id", "part", "range"])

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_path, piece_path)
        for batch in batches:
            for part in text_slices(batch, "range", 1 << 20):
                packed = pa.array([pickle.dumps(f) for f in both.fragments(part.column("range").to_pylist())], pa.binary())
                names = ["key", "doc_id", "part"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), packed], [*names, "fragment"])

    def joined(group: pa.Table) -> Fragment | None:
        ordered = group.sort_by("part").column("fragment")
        return reduce(compose, (pickle.loads(f.as_py()) for f in ordered), IDENTITY)

    def composed(group: pa.Table) -> pa.Table:
        number = pa.array([group.column("part")[0].as_py() // FAN_IN], pa.int64())
        packed = pa.array([pickle.dumps(joined(group))], pa.binary())
        return pa.table([*(group.column(c).slice(0, 1) for c in ("key", "doc_id")), number, packed], ["key", "doc_id", "part", "fragment"])

    block = _Blocks()

    def finished(group: pa.Table) -> pa.Table:
        doc_id = group.column("doc_id").slice(0, 1).combine_chunks()
        return pa.Table.from_batches([_aligned(doc_id, [compose(START, joined(group))], block)])

    size = F.coalesce(F.octet_length("text"), F.lit(0))
    short = rows.where(size <= RANGE).mapInArrow(whole, schema)
    numbered = rows.where(size > RANGE).select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    # the keys have to stay the same if a task is run again
    cuts = materialize(numbered.mapInArrow(cut, f"key long, doc_id {kind}, part long, range string"), "ranges")
    parts = (cuts.agg(F.max("part")).first()[0] or 0) + 1
    state = f"key long, doc_id {kind}, part long, fragment binary"
    found = cuts.repartition("key", "part").mapInArrow(tokenized, state)
    while parts > FAN_IN:
        found = found.groupBy("key", F.floor(F.col("part") / FAN_IN).alias("_next")).applyInArrow(composed, state)
        parts = -(-parts // FAN_IN)
    # the last step also gives out the rows: with a second step in Python behind it each task would keep two workers
    return short.union(found.groupBy("key").applyInArrow(finished, schema))


class _Blocks:
    """Numbers for blocks of a task's rows with about ``BLOCK_LINKS`` distinct links each."""

    def __init__(self) -> None:
        self.number: int | None = None  # known in the task
        self.links = 0

    def __call__(self, links: int) -> int:
        if self.number is None:
            context = TaskContext.get()
            self.number = (context.partitionId() if context else 0) << 33
        if self.links and self.links + links > BLOCK_LINKS:
            self.number, self.links = self.number + 1, 0
        self.links += links
        return self.number


def _aligned(doc_id: pa.Array, found: list[Fragment | None], block: _Blocks) -> pa.RecordBatch:
    found = [f if f is not None else START for f in found]
    closed = [f.closed for f in found]
    offsets = np.r_[0, np.cumsum([len(c.pairs) for c in closed])].astype(np.int32)
    pairs = np.concatenate([c.pairs for c in closed]) if closed else EMPTY.pairs
    times = np.concatenate([c.times for c in closed]) if closed else EMPTY.times
    lists = [
        pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.int32)))
        for values in (pairs >> 32, pairs & 0xFFFFFFFF, times)
    ]
    numbers = [
        [f.n_a for f in found], [f.n_b for f in found], [c.n_groups for c in closed], [int(c.times.sum()) for c in closed],
    ]
    blocks = [block(len(c.pairs)) for c in closed]
    groups = pa.array([c.groups[:-1] for c in closed], pa.string())
    longs = [pa.array(n, pa.int64()) for n in numbers]
    return pa.RecordBatch.from_arrays(
        [doc_id, *longs, groups, *lists, pa.array(blocks, pa.int64())],
        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "link_a", "link_b", "link_times", "block"],
    )


def count_links(aligned: DataFrame) -> DataFrame:
    """The rows of ``align`` without their links, and how common their links are in the whole table.

    An id pair's count is the number of rows that hold it linked. count_sum adds
    it up over the linked occurrences of a row; n_best counts those whose count is the
    highest of all pairs with their A id, ties included. Other columns stay.

    Pairs are first counted inside blocks of rows, and each block asks once for each
    of its distinct pairs, so a pair that every row holds is no hot key: it is
    asked for once a block. A task holds the rows of one block and its answers.
    """
    stored = materialize(aligned, "aligned")
    inner = F.arrays_zip("link_a", "link_b")
    held = stored.select("block", F.explode(inner).alias("_link")).select("block", "_link.link_a", "_link.link_b")
    asked = held.groupBy("block", "link_a", "link_b").agg(F.count(F.lit(1)).alias("_rows"))
    asked = materialize(asked.withColumn("pair", F.shiftleft(F.col("link_a").cast("long"), 32) + F.col("link_b")), "asked")
    counts = asked.groupBy("pair", "link_a").agg(F.sum("_rows").alias("total"))
    highest = counts.groupBy("link_a").agg(F.max("total").alias("_highest"))
    ranked = join_by_key(counts, highest, "link_a").select("pair", "total", (F.col("total") == F.col("_highest")).alias("best"))
    answers = join_by_key(asked.select("block", "pair"), ranked, "pair").select("block", "pair", "total", "best")
    left_out = ("block", "link_a", "link_b", "link_times")
    fields = [f for f in stored.schema.fields if f.name not in left_out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_best long, count_sum long"
    names = [f.name for f in fields]

    def answer(rows: pa.Table, found: pa.Table) -> pa.Table:
        pair, total, best = (found.column(c).to_numpy() for c in ("pair", "total", "best"))
        order = np.argsort(pair)
        a, b, times = (rows.column(c).combine_chunks() for c in ("link_a", "link_b", "link_times"))
        sizes = np.diff(a.offsets.to_numpy())
        links = (a.flatten().to_numpy().astype(np.int64) << 32) | b.flatten().to_numpy()
        place = order[np.searchsorted(pair, links, sorter=order)] if len(links) else np.empty(0, np.int64)
        times = times.flatten().to_numpy().astype(np.int64)
        bounds = np.r_[0, np.cumsum(sizes)]

        def sums(values: np.ndarray) -> pa.Array:
            return pa.array(np.diff(np.r_[0, np.cumsum(values)][bounds]), pa.int64())

        kept = [rows.column(c) for c in names]
        return pa.table([*kept, sums(times * best[place]), sums(times * total[place])], names=[*names, "n_best", "count_sum"])

    return stored.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(answer, schema)


def digest(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """The alignment of every document as counts and a digest of its groups ('' without tokens)."""
    aligned = align(docs, byte_path, piece_path)
    sha = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    found = count_links(aligned.withColumn("groups_sha256", sha).drop("groups"))
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    )
