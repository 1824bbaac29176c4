"""Quality classifier by co-training of two views.

The content view sees a text's byte trigrams and how its words repeat; the
metadata view sees language, source, length and layout, but no words. Each view's
logistic model scores all documents without a label and labels those it is most
sure of for the *other* view, whose next round trains on a sample of them. At the
end both views are calibrated on labelled documents that trained neither, combined,
and applied to all documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.llm.common import fit_in_task, numbered, text_slices, worker_path
from demandloom.session import materialize

#: Bounds of the samples that a round is fitted on: labelled rows, and rows that a view gives the other one, of each class.
LABELLED_ROWS, GIVEN_ROWS = 4000, 1000
ROUNDS = 3
#: Share of all unlabelled documents by which the labels of a view grow in a round, and how sure it has to be.
PER_ROUND, SURE = 0.15, 0.95
#: Logits are counted in steps of 1 / STEPS to find the surest documents.
STEPS = 64
#: From this score on a document is kept.
THRESHOLD = 0.3
TRIGRAMS, LANGUAGES, SOURCES = 1 << 9, 8, 32
_CONTENT = TRIGRAMS + 3


@dataclass
class Model:
    """Per view: mean, scale and weights (the last one is the intercept); and how the calibrated logits combine."""

    views: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    combine: np.ndarray
    constant: float | None = None
    bad_share: float = 0.0


def _trigrams(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of each text's shares of hashed byte trigrams."""
    count = len(offsets) - 1
    found = np.zeros((count, TRIGRAMS), np.float32)
    if len(raw) >= 3:
        b = raw.astype(np.uint32)
        code = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(23)
        owner = np.repeat(np.arange(count), np.diff(offsets))[: len(code)]
        inside = np.arange(3, len(raw) + 1) <= offsets[1:][owner]
        flat = owner[inside] * TRIGRAMS + code[inside]
        found = np.bincount(flat, minlength=count * TRIGRAMS).reshape(count, TRIGRAMS).astype(np.float32)
    return np.sqrt(found / np.maximum(found.sum(axis=1, keepdims=True), 1))


def _repeats(text: str) -> tuple[float, float, float]:
    """Share of words that equal the one before, share of distinct words, share of distinct lines."""
    words, lines = text.split(), text.split("\n")
    if not words:
        return 0.0, 1.0, 1.0
    same = sum(a == b for a, b in zip(words, words[1:]))
    return same / len(words), len(set(words)) / len(words) ** 0.9, len(set(lines)) / len(lines)


def _bucket(values: list, size: int) -> np.ndarray:
    """One column per hash bucket of a value; null has a column of its own."""
    rows = np.zeros((len(values), size), np.float32)
    for i, value in enumerate(values):
        rows[i, 0 if value is None else 1 + zlib.crc32(str(value).encode()) % (size - 1)] = 1
    return rows


def features(texts: pa.Array, languages: list, sources: list) -> np.ndarray:
    """Content and metadata features of each text, side by side."""
    texts = pa.concat_arrays([pc.fill_null(texts, ""), pa.array([], pa.string())])
    count = len(texts)
    _, cuts, data = texts.buffers()
    cuts = np.frombuffer(cuts, np.int32)[: count + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]] if data is not None else np.zeros(0, np.uint8)
    cuts -= cuts[0]
    sizes = np.maximum(np.diff(cuts), 1)
    classes = np.zeros(256, np.int64)
    for number, members in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b".,;:'\"()-", b"!?", b"|<>{}[]\\/_", b"#$%&*+=@^~`"), 1):
        classes[list(members)] = number
    owner = np.repeat(np.arange(count), np.diff(cuts))
    shares = np.bincount(owner * 9 + classes[raw], minlength=count * 9).reshape(count, 9) / sizes[:, None]
    layout = [
        np.log1p(sizes), np.log1p(sizes * shares[:, 4]), np.log1p(1 / np.maximum(shares[:, 3] + shares[:, 4], 1e-3)),
        np.log1p(1 / np.maximum(shares[:, 4], 1e-4)),
    ]
    repeats = np.array([_repeats(t) for t in texts.to_pylist()], np.float32).reshape(count, 3)
    parts = [_trigrams(raw, cuts), repeats, np.sqrt(shares), np.stack(layout, axis=1), _bucket(languages, LANGUAGES), _bucket(sources, SOURCES)]
    return np.concatenate(parts, axis=1).astype(np.float32)


def _view(x: np.ndarray, number: int) -> np.ndarray:
    return x[:, :_CONTENT] if number == 0 else x[:, _CONTENT:]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 80) -> np.ndarray:
    """Weights and intercept of a ridge logistic regression, by accelerated gradient steps."""
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    weight = (weight / weight.sum()).astype(np.float32)
    # the largest curvature, by power iteration, sets the step
    v = np.ones(x.shape[1], np.float32)
    for _ in range(12):
        v = x.T @ (weight * (x @ v))
        v /= np.linalg.norm(v)
    rate = 1 / (0.25 * float(weight @ (x @ v) ** 2) * 1.1 + ridge)
    w, ahead, momentum = np.zeros_like(v), np.zeros_like(v), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * ahead
        gradient[-1] -= ridge * ahead[-1]
        following = ahead - rate * gradient
        later = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = following + (momentum - 1) / later * (following - w)
        w, momentum = following, later
    return w


def _logits(x: np.ndarray, view: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    mean, scale, w = view
    return np.clip(((x - mean) / scale) @ w[:-1] + w[-1], -30, 30)


def _fit_view(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, scale = x.mean(axis=0), x.std(axis=0) + np.float32(1e-3)
    # both classes weigh the same
    balanced = weight * np.where(y == 1, 0.5 / max(1e-9, weight[y == 1].sum()), 0.5 / max(1e-9, weight[y == 0].sum()))
    return mean, scale, _logistic((x - mean) / scale, y, balanced)


def _featured(docs: DataFrame, extra: list[str]) -> DataFrame:
    """(``extra``, x): the features of each row as raw float32."""
    worker_path(docs.sparkSession)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                x = features(part.column("text"), part.column("lang").to_pylist(), part.column("source").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in extra], pa.array([r.tobytes() for r in x], pa.binary())], names=[*extra, "x"]
                )

    schema = T.StructType([*[docs.schema[c] for c in extra], T.StructField("x", T.BinaryType())])
    return docs.select(*extra, "text", "lang", "source").mapInArrow(compute, schema)


def _order() -> list:
    return [F.xxhash64("doc_id"), F.col("doc_id")]


def _usable(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())


def _with_features(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Adds x to a bounded number of rows (doc_id, y, view, stands); of rows with equal doc_ids the first by features counts."""
    columns = ["doc_id", "y", "view", "stands"]
    rows = docs.select("doc_id", "text", "lang", "source").join(F.broadcast(chosen), "doc_id")
    return _featured(rows, columns).groupBy(*columns).agg(F.min("x").alias("x"))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, y, view, stands, x): at most LABELLED_ROWS documents with a label, half of each class as far as there are.

    view is -1, as they train both; stands says how many labelled documents of its class a row stands for.
    """
    agreed = _usable(labels).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most")
    present = agreed.join(docs.select("doc_id"), "doc_id", "left_semi").select("doc_id", F.col("quality").cast("int").alias("y"))
    present = materialize(present, "quality-labels")
    counts = {0: 0, 1: 0} | {r["y"]: r["count"] for r in present.groupBy("y").count().collect()}
    bad = min(counts[0], max(LABELLED_ROWS // 2, LABELLED_ROWS - counts[1]))
    sizes = {0: bad, 1: min(counts[1], LABELLED_ROWS - bad)}
    parts = [
        present.where(F.col("y") == y).orderBy(*_order()).limit(size)
        .select("doc_id", "y", F.lit(-1).alias("view"), F.lit(counts[y] / max(1, size)).alias("stands"))
        for y, size in sizes.items()
    ]
    return materialize(_with_features(docs, parts[0].union(parts[1])), "quality-sample")


def _view_logits(part: pa.RecordBatch, model: Model) -> list[np.ndarray]:
    x = features(part.column("text"), part.column("lang").to_pylist(), part.column("source").to_pylist())
    return [_logits(_view(x, n), model.views[n]).astype(np.float64) for n in range(2)]


def _unlabelled(docs: DataFrame, labels: DataFrame, model: Model) -> DataFrame:
    """(doc_id, logit_0, logit_1): both views' logits of every document without a label; of equal doc_ids the lowest."""
    worker_path(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    named = ["doc_id", "logit_0", "logit_1"]

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", 1 << 20):
                logits = [pa.array(v) for v in _view_logits(part, shared.value)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *logits], names=named)

    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(n, T.DoubleType()) for n in named[1:]]])
    rated = docs.where("doc_id IS NOT NULL").select("doc_id", "text", "lang", "source").mapInArrow(rate, schema)
    free = rated.join(_usable(labels).select("doc_id"), "doc_id", "left_anti")
    return free.groupBy("doc_id").agg(*[F.min(n).alias(n) for n in named[1:]])


def _surest(counted: dict[int, int], allowed: float, sign: int) -> int | None:
    """The last of the surest steps that hold the allowed number of documents; the first step counts whole. None: nobody is sure."""
    least = np.log(SURE / (1 - SURE)) * STEPS
    steps = sorted((s for s in counted if (s >= least if sign > 0 else s + 1 <= -least)), reverse=sign > 0)
    taken, last = 0, None
    for step in steps:
        if taken and taken + counted[step] > allowed:
            break
        taken, last = taken + counted[step], step
    return last


def _given(docs: DataFrame, labels: DataFrame, model: Model, share: float) -> DataFrame | None:
    """(doc_id, y, view, stands, x): what each view labels for the other one (view), at most GIVEN_ROWS of each class.

    Chosen over all documents without a label: up to ``share`` of them, the surest, from which the rows are drawn.
    """
    free = materialize(_unlabelled(docs, labels, model), "quality-logits")
    steps = [F.floor(F.col(f"logit_{n}") * STEPS) for n in range(2)]
    # at most 60 * STEPS + 1 steps for each view
    both = free.select(F.explode(F.array(*[F.struct(F.lit(n).alias("view"), steps[n].alias("step")) for n in range(2)])).alias("s"))
    counts = both.groupBy("s.view", "s.step").count().collect()
    parts = []
    for number in range(2):
        counted = {r["step"]: r["count"] for r in counts if r["view"] == number}
        most = share * sum(counted.values())
        low, high = _surest(counted, most * model.bad_share, -1), _surest(counted, most * (1 - model.bad_share), 1)
        for y, last in ((0, low), (1, high)):
            if last is not None:
                rows = free.where(steps[number] >= last if y else steps[number] <= last).orderBy(*_order()).limit(GIVEN_ROWS)
                parts.append(rows.select("doc_id", F.lit(y).alias("y"), F.lit(1 - number).alias("view"), F.lit(1.0).alias("stands")))
    if not parts:
        return None
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.union(part)
    return _with_features(docs, chosen)


def fit(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Model:
    """Co-train in rounds: all documents without a label are scored in Spark, bounded samples are fitted in one task.

    Every fifth labelled document of the sample trains neither view but calibrates
    and combines them. With fewer than five documents of a class in either part, as in a
    small sample, all labelled documents do both, and the scores are too sure. If the labels of ``docs`` lack one of the two classes, the
    model gives every document the class it has seen (1 without any label).
    Documents with a null doc_id are scored but train nothing.
    """
    labelled = _labelled(docs, labels)
    model = fit_in_task(labelled, _order(), _train)
    for turn in range(1, rounds + 1):
        given = None if model.constant is not None else _given(docs, labels, model, turn * PER_ROUND)
        if given is None:
            break
        model = fit_in_task(labelled.unionByName(given), _order(), _train)
    return model


def _train(sample: pa.Table) -> Model:
    width = _CONTENT + 9 + 4 + LANGUAGES + SOURCES
    x = np.frombuffer(b"".join(sample.column("x").to_pylist()), np.float32).reshape(-1, width)
    y, trains, stands = (sample.column(c).to_numpy() for c in ("y", "view", "stands"))
    named = np.flatnonzero(trains < 0)
    if not len(named) or y[named].min() == y[named].max():
        return Model([], np.zeros(3), float(y[named].min(initial=1)) if len(named) else 1.0)
    fold = np.arange(len(named)) % 5 == 4
    if min((y[named[fold]] == 1).sum(), (y[named[fold]] == 0).sum(), (y[named[~fold]] == 1).sum(), (y[named[~fold]] == 0).sum()) < 5:
        fold = np.ones(len(named), bool)
        train = named
    else:
        train = named[~fold]
    held = named[fold]
    views = []
    for number in range(2):
        rows = np.concatenate([train, np.flatnonzero(trains == number)])
        weight = np.where(trains[rows] < 0, 1.0, 0.3).astype(np.float32)  # what another view says counts less
        views.append(_fit_view(_view(x[rows], number), y[rows].astype(np.float32), weight))
    both = np.stack([_logits(_view(x[held], n), views[n]) for n in range(2)], axis=1)
    # one logistic fit on the held documents, each for those it stands for, calibrates and combines the two logits
    combine = _logistic((both / 4).astype(np.float32), y[held].astype(np.float32), stands[held], 1e-3, 400)
    return Model(views, combine, bad_share=float(stands[train][y[train] == 0].sum() / stands[train].sum()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``content_score``, ``metadata_score`` and ``quality_score`` (0 to 1) to every row of ``docs``.

    Reads the whole text, lang and source. Null and empty texts are texts without
    trigrams and words; null lang and source are values of their own. Repeated
    rows score alike. Columns with one of the three names are overwritten. Empty
    table: no rows.
    """
    worker_path(docs.sparkSession)
    added = ["content_score", "metadata_score", "quality_score"]
    rest = docs.drop(*added)
    if model.constant is not None:
        return rest.withColumns({name: F.lit(float(model.constant)) for name in added})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inside, own_columns = numbered(rest)
    named = ["text", "lang", "source"]
    read = [inside.columns[rest.columns.index(c)] for c in named]

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for part in text_slices(batch, read[0], 1 << 20):
                found = _view_logits(pa.RecordBatch.from_arrays([part.column(c) for c in read], names=named), fitted)
                joint = np.clip(np.stack(found, axis=1) / 4 @ fitted.combine[:2] + fitted.combine[2], -40, 40)
                scores = [pa.array(1 / (1 + np.exp(-v))) for v in (*found, joint)]
                yield pa.RecordBatch.from_arrays([*part.columns, *scores], names=[*part.schema.names, *added])

    scored = inside.mapInArrow(rate, T.StructType([*inside.schema, *[T.StructField(n, T.DoubleType()) for n in added]]))
    return scored.select(*own_columns, *added)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, content_score, metadata_score, score, keep) for every row of ``docs``; keep is 1 from THRESHOLD on."""
    scored = score(docs.select("doc_id", "text", "lang", "source"), fit(docs, labels))
    return scored.select(
        "doc_id", "content_score", "metadata_score", F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("keep"),
    )


def drop_poor(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their columns."""
    return score(docs, fit(docs, labels)).where(F.col("quality_score") >= THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])
