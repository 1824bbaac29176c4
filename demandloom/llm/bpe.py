"""BPE encoding by a table of distinct words, and decoding by a table of pieces.

A tokenizer that lower-cases, drops white space and cuts at punctuation gives a
text the ids of its words, one after the other. So the corpus is split into words (runs of
anything but ASCII white space), each distinct word is encoded once, and the ids
are joined back to every position. Ids are decoded by a join with the id-to-piece
table (``decode``), or where they are put together, by the same table in the task.

Word counts follow Zipf's law, which decides how they are joined back. The most
frequent words (at most ``head_words`` of at most ``HEAD_BYTES`` bytes, so the
broadcast has a fixed bound) are looked up inside the tasks. All other words are
rare by construction: they go through a shuffle join on the word, in which no
key is hot, and come back to their document as (position, ids). The text itself
is never shuffled, only a compressed list of word numbers.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from demandloom.llm.common import numbered, text_slices, worker_path  # noqa: E402
from demandloom.session import materialize  # noqa: E402

#: Bound of the broadcast: at most so many words of at most so many bytes.
HEAD_WORDS = 1 << 20
HEAD_BYTES = 64
#: Distinct words that a task gathers before it passes their counts on.
COUNTED_AT_ONCE = 1_000_000
#: Words that a task assembles at once (a longer document is done alone).
ASSEMBLED_AT_ONCE = 400_000


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@lru_cache(maxsize=4)
def pieces(path: str) -> pa.Array:
    """The id-to-piece table, one entry for each id of the vocabulary."""
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=True)
    listed: list[str | None] = [None] * (max(vocabulary.values()) + 1)
    for piece, number in vocabulary.items():
        listed[number] = piece
    return pa.array(listed, pa.string())


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """The id-to-piece table, one row for each id of the tokenizer."""
    listed = sorted((number, piece) for piece, number in tokenizer(path).get_vocab(with_added_tokens=True).items())
    return spark.createDataFrame(listed, "id int, piece string")


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in one array, and where each text begins in it.

    Capitals A to Z become small and a full stop or comma that ends a word after
    an ASCII letter or digit becomes a word of its own. The tokenizer does both
    itself, so the ids stay the same while far fewer words are distinct. Only in
    a text that may hold a special token, which is matched as it stands, capitals
    are left alone.
    """
    texts = pc.fill_null(texts, "")
    texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
    lists = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(counts)])
    words = pa.concat_arrays([lists.flatten(), pa.array([], pa.string())])  # at offset 0 of its own buffers
    if not len(words) or not pc.any(pc.greater(pc.binary_length(words), 0)).as_py():
        return words, begins
    _, cuts, data = words.buffers()
    cuts, letters = np.frombuffer(cuts, np.int32)[: len(words) + 1], np.frombuffer(data, np.uint8)
    lengths, last = np.diff(cuts), letters[np.maximum(cuts[1:], 1) - 1]
    before = letters[np.maximum(cuts[1:], 2) - 2]
    plain = (before >= 48) & (before < 58) | ((before | 32) >= 97) & ((before | 32) < 123)
    marked = (lengths > 1) & ((last == 44) | (last == 46)) & plain
    places = np.flatnonzero(marked)
    parted = np.insert(cuts, places + 1, cuts[places + 1] - 1).astype(np.int32)
    words = pa.StringArray.from_buffers(len(parted) - 1, pa.py_buffer(parted), words.buffers()[2])
    return words, begins + np.concatenate([[0], np.cumsum(marked)])[begins]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counted: pa.Table | None = None

    def merged(more: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(more).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return table.select(["word", "n_sum"]).rename_columns(["word", "n"])

    for batch in batches:
        for texts in text_slices(batch, "text"):
            found = _split(texts.column("text"))[0].value_counts()
            new = pa.table({"word": found.field("values"), "n": found.field("counts")})
            counted = merged([counted, new] if counted is not None else [new])
            if counted.num_rows >= COUNTED_AT_ONCE:
                yield from counted.to_batches(max_chunksize=100_000)
                counted = None
    if counted is not None:
        yield from counted.to_batches(max_chunksize=100_000)


def _encode_words(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                ids = [e.ids for e in model.encode_batch(part.column(0).to_pylist(), add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(ids, pa.list_(pa.int32()))], names=["word", "n", "ids"]
                )

    return encode


def word_table(docs: DataFrame, path: str) -> DataFrame:
    """Every distinct word of ``docs.text`` with its count and its ids, encoded once and stored."""
    worker_path(docs.sparkSession)
    counts = docs.select("text").mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialize(counts.mapInArrow(_encode_words(path), "word string, n long, ids array<int>"), "words")


def _level():
    """A logarithmic grade of a count, four to a doubling."""
    return F.floor(F.log2("n") * 4)


def _is_head(level: int):
    return (_level() >= level) & (F.octet_length("word") <= HEAD_BYTES)


def head_level(words: DataFrame, head_words: int) -> int:
    """The lowest grade from which on there are at most ``head_words`` words."""
    grades = words.where(F.octet_length("word") <= HEAD_BYTES).groupBy(_level().alias("level")).count().collect()
    total, lowest = 0, 1 << 30
    for level, count in sorted(((r["level"], r["count"]) for r in grades), reverse=True):
        total += count
        if total > head_words:
            break
        lowest = level
    return int(lowest)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the lists and all their values."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lengths, column.flatten().to_numpy(zero_copy_only=False)


class Head:
    """The frequent words and their ids, as the tasks see them."""

    def __init__(self, table: pa.Table) -> None:
        table = table.sort_by([("n", "descending"), ("word", "ascending")]).combine_chunks()
        self.words = table.column("word").combine_chunks() if table.num_rows else pa.array([], pa.string())
        if isinstance(self.words, pa.ChunkedArray):
            self.words = pa.concat_arrays(self.words.chunks)
        ids = table.column("ids").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
        if isinstance(ids, pa.ChunkedArray):
            ids = pa.concat_arrays(ids.chunks)
        self.lengths, self.ids = _lists(ids)
        self.lengths, self.ids = self.lengths.astype(np.int32), self.ids.astype(np.int32)

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each word; -1 for a word that is not among them."""
        coded = words.dictionary_encode()
        known = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.words), -1)
        of_each = known.to_numpy(zero_copy_only=False).astype(np.int32)
        return of_each[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int32)


def _rare_words(shared):
    """(document key, place among its rare words, word) of all words outside the head."""

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        for batch in batches:
            for part in text_slices(batch, "text"):
                words, begins = _split(part.column("text"))
                places = np.flatnonzero(head.numbers(words) < 0)
                rows = np.searchsorted(begins, places, side="right") - 1
                first = np.searchsorted(places, begins[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_k1").take(pa.array(rows)),
                        part.column("_k2").take(pa.array(rows)),
                        pa.array((np.arange(len(places)) - first[rows]).astype(np.int32)),
                        words.take(pa.array(places)),
                    ],
                    names=["_k1", "_k2", "_place", "word"],
                )

    return rare


def _bodies(shared, keep: Sequence[str]):
    """Each document as a compressed list of word numbers, with its key if it has rare words."""

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        head, serial = shared.value, TaskContext.get().partitionId() << 40
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            for part in text_slices(batch, "text"):
                words, begins = _split(part.column("text"))
                numbers = head.numbers(words) + 1
                rare = np.concatenate([[0], np.cumsum(numbers == 0)])
                has_rare = rare[begins[1:]] > rare[begins[:-1]]
                blobs = [
                    codec.compress(numbers[a:b].view(np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True)
                    for a, b in zip(begins[:-1], begins[1:])
                ]
                # a document without rare words has nothing to meet: any key spreads it, and no partner has a null
                own = np.arange(serial, serial + part.num_rows)
                serial += part.num_rows
                k1 = np.where(has_rare, part.column("_k1").to_numpy(zero_copy_only=False), own)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in keep],
                        pa.array(k1, pa.int64()),
                        pc.if_else(pa.array(has_rare), part.column("_k2"), pa.scalar(None, pa.int64())),
                        pa.array(np.diff(begins).astype(np.int32)),
                        pa.array(blobs, pa.binary()),
                    ],
                    names=[*keep, "_k1", "_k2", "_words", "_body"],
                )

    return bodies


def _assemble(shared, path: str, keep: Sequence[str], with_text: bool):
    """Ids of each document from its word numbers and the ids of its rare words."""

    def one(part: pa.RecordBatch, head: Head) -> pa.RecordBatch:
        sizes = part.column("_words").to_numpy(zero_copy_only=False).astype(np.int64)
        numbers = np.concatenate(
            [np.zeros(0, np.int32)]
            + [
                np.ascontiguousarray(
                    np.frombuffer(pa.decompress(b, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
                    .reshape(4, n).T
                ).view(np.int32).ravel()
                for b, n in zip(part.column("_body").to_pylist(), sizes.tolist())
                if n
            ]
        )
        ends = np.cumsum(sizes)
        rare = part.column("_rare")
        per_row = pc.fill_null(pc.list_value_length(rare), 0).to_numpy(zero_copy_only=False)
        found = rare.flatten()
        rows = np.repeat(np.arange(part.num_rows), per_row)
        place = found.field("_place").to_numpy(zero_copy_only=False).astype(np.int64)
        rare_lengths, rare_ids = _lists(found.field("ids"))
        order = np.lexsort((place, rows))
        starts = np.concatenate([np.cumsum(head.lengths) - head.lengths, len(head.ids) + np.cumsum(rare_lengths) - rare_lengths])
        lengths = np.concatenate([head.lengths, rare_lengths])
        which = numbers.astype(np.int64) - 1
        which[numbers == 0] = len(head.lengths) + order
        pool = np.concatenate([head.ids, rare_ids]).astype(np.int32)
        word_ids = lengths[which].astype(np.int64)
        stops = np.cumsum(word_ids)
        total = int(stops[-1]) if len(stops) else 0
        ids = pool[np.repeat(starts[which] - (stops - word_ids), word_ids) + np.arange(total)]
        offsets = np.concatenate([[0], np.concatenate([[0], stops])[ends]]).astype(np.int32)
        arrays = [*[part.column(c) for c in keep], pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))]
        if with_text:
            arrays.append(_joined(offsets, ids, path))
        return pa.RecordBatch.from_arrays(arrays, names=[*keep, "ids", *["decoded"] * with_text])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        for batch in batches:
            sizes = np.cumsum(batch.column("_words").to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < batch.num_rows:
                done = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, done + ASSEMBLED_AT_ONCE, side="right")))
                yield one(batch.slice(start, stop - start), head)
                start = stop

    return assemble


def _joined(offsets: np.ndarray, ids: np.ndarray, path: str) -> pa.Array:
    """The pieces of each list of ids, joined as the tokenizer's decoder joins them."""
    listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pieces(path).take(pa.array(ids)))
    return pc.binary_join(listed, " ")


def encode(
    docs: DataFrame, path: str, keep: Sequence[str] | None = None, with_text: bool = False, head_words: int = HEAD_WORDS
) -> DataFrame:
    """Ids of every whole text: the columns ``keep`` of ``docs`` (default: all but text) and ``ids``.

    ``with_text`` adds ``decoded``, the text that decoding these ids gives. The
    tokenizer (a file of the tokenizers library at ``path``) has to lower-case, to
    drop white space and to cut between letters and punctuation before BPE. Special tokens in a text count as such, none are added.

    Null and empty texts, and texts of white space: no ids. Repeated rows, equal
    doc_ids and nulls in other columns: each row is encoded for itself. Columns
    named ids or decoded are overwritten. Empty table: no rows.
    """
    worker_path(docs.sparkSession)
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in ("text", "ids", "decoded")]
    words = word_table(docs, path)
    level = head_level(words, head_words)
    head = Head(words.where(_is_head(level)).toArrow())
    shared = docs.sparkSession.sparkContext.broadcast(head)
    name = "doc_id" if "doc_id" in docs.columns else "text"
    inside, own_columns = numbered(docs, [*keep, "text", name])
    *kept_names, text, doc_id = inside.columns
    entered = inside.select(
        *kept_names, F.col(text).alias("text"), F.xxhash64(doc_id, text).alias("_k1"), F.xxhash64(text, doc_id, F.lit(1)).alias("_k2")
    )
    rare = entered.select("text", "_k1", "_k2").mapInArrow(
        _rare_words(shared), "_k1 long, _k2 long, _place int, word string"
    )
    # equal rows have one key, and their words are one set however often they come
    found = (
        rare.join(words.where(~_is_head(level)).select("word", "ids"), "word")
        .groupBy("_k1", "_k2")
        .agg(F.collect_set(F.struct("_place", "ids")).alias("_rare"))
    )
    kept = T.StructType([T.StructField(n, docs.schema[c].dataType) for n, c in zip(kept_names, keep, strict=True)])
    body = T.StructType(
        [*kept, T.StructField("_k1", T.LongType()), T.StructField("_k2", T.LongType()),
         T.StructField("_words", T.IntegerType()), T.StructField("_body", T.BinaryType())]
    )
    out = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType(), True))])
    if with_text:
        out = T.StructType([*out, T.StructField("decoded", T.StringType())])
    bodies = entered.mapInArrow(_bodies(shared, kept_names), body)
    coded = bodies.join(found, ["_k1", "_k2"], "left").mapInArrow(_assemble(shared, path, kept_names, with_text), out)
    return coded.select(*own_columns[: len(keep)], "ids", *["decoded"] * with_text)


def decode(df: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add ``name``: the text of each list of ids, special tokens included.

    The rows are stored with a number, their ids meet their pieces in a join with the id-to-piece table (broadcast:
    it has the size of the vocabulary), and the pieces of a row are put together in
    their order. A null list gives null, an empty one the empty text; null or
    unknown ids inside a list are left out.
    """
    kept = df.drop(name)
    inside, own_columns = numbered(kept)
    listed = inside.columns[kept.columns.index(ids)]
    rows = materialize(inside.withColumn("row", F.monotonically_increasing_id()), "decode")
    met = rows.select("row", F.posexplode(listed).alias("place", "id")).join(F.broadcast(vocabulary(df.sparkSession, path)), "id")
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("place", "piece"))), lambda p: p["piece"])
    texts = met.groupBy("row").agg(F.array_join(pieces, " ").alias("text"))
    text = F.when(F.col(listed).isNotNull(), F.coalesce("text", F.lit("")))
    return rows.join(texts, "row", "left").select(*own_columns, text.alias(name))


def round_trip(docs: DataFrame, path: str, head_words: int = HEAD_WORDS) -> DataFrame:
    """Digests of each document's ids and of the text that they decode to."""
    coded = encode(docs, path, keep=["doc_id"], with_text=True, head_words=head_words)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
