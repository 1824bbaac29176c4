"""Token-id files: texts to ids, ids to range-coded blocks, and back.

Documents are range-partitioned and sorted by doc_id, so file after file and block
after block holds them in that order. A file is a Parquet file of blocks, written
and committed by Spark: one row per block with the doc_ids and lengths of its
documents and their ids as one coded, checksummed block (see ``idcoder``) that is
read without any other. A document is never cut, so a block has about
``BLOCK_IDS`` ids or one longer document.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from demandloom.llm import idcoder  # noqa: E402
from demandloom.llm.bpe import tokenizer  # noqa: E402
from demandloom.llm.common import running_total, text_slices, worker_path  # noqa: E402

END = 2
BLOCK_IDS = 1 << 20
#: Bytes of text that are looked up together, as many as a batch has: each lookup reads all remembered pieces.
TOGETHER = 16 << 20
#: Distinct pieces of text whose ids a Python worker remembers.
REMEMBERED = 1_500_000


_LETTERS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_MARKS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
#: For each byte 1 if it is a letter or digit, 2 if it is a mark, else 0.
_CLASS = bytes(1 if b in _LETTERS else 2 if b in _MARKS else 0 for b in range(256))


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Each text cut where a byte-level pre-tokenizer always cuts, and where each text begins among the pieces.

    These are the places before a single space, and around a single line feed,
    between two characters that are surely no white space: printable ASCII, or
    characters whose first byte in UTF-8 starts no white space. It also cuts between
    an ASCII letter or digit and a punctuation mark (not an apostrophe, which may
    begin an ending, nor a bar, which stands inside special tokens).
    """
    texts = pa.concat_arrays([pc.fill_null(texts, ""), pa.array([], pa.string())])
    if not pc.any(pc.greater(pc.binary_length(texts), 0)).as_py():
        return pa.array([], pa.string()), np.zeros(len(texts) + 1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[: len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    byte = np.concatenate([np.zeros(3, np.uint8), raw, np.zeros(1, np.uint8)])  # raw[i] is byte[i + 3]
    at = np.flatnonzero((raw == 32) | (raw == 10))
    last, second, third, following = byte[at + 2], byte[at + 1], byte[at], byte[at + 4]
    printable = lambda b: (b > 0x20) & (b < 0x7F)
    ends = printable(last) | (last >= 0x80) & (
        (second >= 0xC3) & (second < 0xE0) | (second >= 0x80) & (second < 0xC0) & (third >= 0xE4) & (third < 0xF0)
    )
    starts = printable(following) | (following >= 0xC3) & (following < 0xE0) | (following >= 0xE4) & (following < 0xF0)
    edge = np.zeros(len(raw) + 2, bool)
    edge[offsets] = True
    fit = ends & starts & ~edge[at] & ~edge[at + 1]
    single = at[fit]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    cut[single] = True
    cut[single[raw[single] == 10] + 1] = True
    classes = np.frombuffer(raw.tobytes().translate(_CLASS), np.uint8)
    cut[np.flatnonzero((classes[1:] == 2) & (classes[:-1] == 1)) + 1] = True
    cuts = np.flatnonzero(cut)
    pieces = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(raw))
    return pieces, np.searchsorted(cuts, offsets)


class _Remembering:
    """A tokenizer that remembers the ids of the pieces it has seen, up to a bound."""

    def __init__(self, path: str) -> None:
        self.model = tokenizer(path)
        line = self.model.encode("a\n b", add_special_tokens=False).ids
        self.line = line[1] if len(line) == 3 else None
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.string())
        self.ids = pa.array([], pa.list_(pa.int32()))

    def _together(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces, and how many each has.

        Pieces without white space but a space in front are encoded together, as
        lines of one text: a line feed between them is always one id of its own.
        """
        found = self.model.encode_batch_fast(["\n".join(pieces)], add_special_tokens=False)[0]
        ids = np.array(found.ids, np.int32)
        ends = np.flatnonzero(ids == self.line)
        if len(ends) == len(pieces) - 1:
            lengths = np.diff(np.concatenate([[-1], ends, [len(ids)]])) - 1
            return ids[ids != self.line], lengths
        return self._singly(pieces)

    def _singly(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.model.encode_batch_fast(pieces, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.int32, int(lengths.sum())), lengths

    def _add(self, pieces: pa.Array) -> np.ndarray:
        """Remember pieces that are not known yet; gives their numbers."""
        numbers = np.zeros(len(pieces), np.int64)
        whole = pc.and_(
            pc.match_substring_regex(pieces, r"^ ?[!-~À-\x{7FF}](.*[!-~À-\x{7FF}])?$"), pc.invert(pc.match_substring(pieces, "<|"))
        )
        if self.line is None:
            whole = pc.and_(whole, False)
        for mask, encode in ((whole, self._together), (pc.invert(whole), self._singly)):
            chosen = pieces.filter(mask)
            numbers[mask.to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(chosen))
            lists = [self.ids]
            for first in range(0, len(chosen), 512):
                flat, lengths = encode(chosen.slice(first, 512).to_pylist())
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
            self.known, self.ids = pa.concat_arrays([self.known, chosen]), pa.concat_arrays(lists)
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each text has."""
        pieces, begins = _pieces(texts)
        if not len(pieces):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        coded = pieces.dictionary_encode()
        if len(self.known) + len(coded.dictionary) > REMEMBERED:
            self.clear()
        found = pc.index_in(coded.dictionary, value_set=self.known)
        numbers = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        fresh = np.flatnonzero(numbers < 0)
        if len(fresh):
            numbers[fresh] = self._add(coded.dictionary.take(pa.array(fresh)))
        lists = self.ids.take(pa.array(numbers.take(coded.indices.to_numpy(zero_copy_only=False))))
        stops = lists.offsets.to_numpy().astype(np.int64)
        return lists.flatten().to_numpy(), np.diff(stops[begins] - stops[0])


@lru_cache(maxsize=2)
def _remembering(path: str) -> _Remembering:
    return _Remembering(path)


def _blocks(path: str, end: int, block_ids: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        file, number, held = TaskContext.get().partitionId(), 0, 0
        coder = _remembering(path)
        names: list[pa.Array] = []
        lengths: list[np.ndarray] = []
        gathered: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            ids = np.concatenate(gathered)
            doc_ids, sizes = pa.concat_arrays(names), np.concatenate(lengths)
            one = pa.array([0, len(sizes)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.ListArray.from_arrays(one, doc_ids), pa.ListArray.from_arrays(one, pa.array(sizes)),
                 pa.array([idcoder.encode_block(ids)], pa.binary())],
                names=["file", "block", "n_ids", "doc_ids", "lengths", "payload"],
            )

        for batch in batches:
            for part in text_slices(batch, "text", TOGETHER):
                ids, sizes = coder.encode(part.column("text"))
                ids, sizes = np.insert(ids, np.cumsum(sizes), end), sizes + 1
                stops = np.concatenate([[0], np.cumsum(sizes)])
                first = 0
                for some in text_slices(part, "text"):
                    stop = first + some.num_rows
                    gathered.append(ids[stops[first] : stops[stop]])
                    names.append(some.column("doc_id"))
                    lengths.append(sizes[first:stop])
                    held += len(gathered[-1])
                    first = stop
                    if held >= block_ids:
                        yield block()
                        number, held = number + 1, 0
                        names, lengths, gathered = [], [], []
        if held:
            yield block()

    return blocks


def write(docs: DataFrame, folder: str, path: str, end: int = END, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of every whole text of ``docs`` (columns doc_id, text) to ``folder`` in ascending doc_id order.

    ``path`` names a file of the tokenizers library with a byte-level
    pre-tokenizer; each document ends with the id ``end``. Special tokens in a
    text count as such.

    Null and empty texts have the end alone. Null doc_ids come first. Rows with
    equal doc_ids are all kept, in the order of a hash of the text; a number of
    the row keeps copies of one row out of a single range. Empty table: no blocks.
    """
    worker_path(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    entered = docs.select(
        "doc_id", "text", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row")
    )
    order = ["doc_id", "_hash", "_row"]
    placed = entered.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = T.StructType(
        [T.StructField("file", T.IntegerType()), T.StructField("block", T.IntegerType()),
         T.StructField("n_ids", T.LongType()), T.StructField("doc_ids", T.ArrayType(kind)),
         T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType())]
    )
    placed.mapInArrow(_blocks(path, end, block_ids), schema).write.parquet(folder)


def read(spark: SparkSession, folder: str, with_ids: bool = True, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens) of every document in the files, with its ``ids`` and, for ``digest``, their CRC-32.

    ``start`` counts the ids of all documents before it. Blocks are decoded on
    their own; a damaged one stops the job with an error.
    """
    worker_path(spark)
    blocks = spark.read.parquet(folder)
    kind = blocks.schema["doc_ids"].dataType.elementType

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = idcoder.decode_block(batch.column("payload")[row].as_py()).astype("<u4")
                sizes = batch.column("lengths")[row].values.to_numpy(zero_copy_only=False)
                stops = np.cumsum(sizes)
                if int(stops[-1]) != len(ids):
                    raise ValueError("a block's lengths do not fit its ids")
                n = len(sizes)
                arrays = [
                    batch.column("doc_ids")[row].values, pa.array(np.full(n, batch.column("file")[row].as_py(), np.int32)),
                    pa.array(np.full(n, batch.column("block")[row].as_py(), np.int32)), pa.array(stops - sizes), pa.array(sizes),
                ]
                names = ["doc_id", "file", "block", "inside", "n_tokens"]
                if digest:
                    sums = [zlib.crc32(ids[b - s : b]) for b, s in zip(stops.tolist(), sizes.tolist())]
                    arrays.append(pa.array(sums, pa.int64()))
                    names.append("ids_crc32")
                if with_ids:
                    offsets = np.concatenate([[0], stops]).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    long, whole = T.LongType(), T.IntegerType()
    schema = T.StructType(
        [T.StructField("doc_id", kind), T.StructField("file", whole), T.StructField("block", whole),
         T.StructField("inside", long), T.StructField("n_tokens", long)]
        + [T.StructField("ids_crc32", long)] * digest
        + [T.StructField("ids", T.ArrayType(whole))] * with_ids
    )
    docs = blocks.select("file", "block", "doc_ids", "lengths", "payload").mapInArrow(decode, schema)
    begins = running_total(blocks.select("file", "block", "n_ids"), [], "file", [F.col("block")], F.col("n_ids"), "begin")
    met = docs.join(begins.select("file", "block", "begin"), ["file", "block"])
    rest = [c for c in ("n_tokens", "ids_crc32", "ids") if c in docs.columns]
    return met.select("doc_id", (F.col("begin") + F.col("inside")).alias("start"), *rest)
