"""Toxicity: a recurrent network with attention over all overlapping windows of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.llm import gru
from demandloom.llm.common import fit_in_task, numbered, text_slices, worker_path
from demandloom.session import materialize

#: Words of a window, and words from one window's start to the next one's: a passage of up to half a window is whole in one.
WIDTH, STRIDE = 64, 32
#: Bounds of the training sample: toxic and other documents. Any text is scored.
TOXIC_ROWS, OTHER_ROWS = 1800, 2600
#: A text of over so many bytes trains with so many passages of so many characters, drawn by hash from all of it.
TRAINING_BYTES, PASSAGES, PASSAGE = 1 << 20, 512, 1024
#: Passes over the training windows, and more for a small sample, until there were UPDATES steps.
EPOCHS, UPDATES, BATCH, RATE, DECAY = 3, 100, 192, 0.006, 0.1
#: From this score on a document is predicted toxic.
THRESHOLD = 0.3
#: Windows scored at once.
SCORED_AT_ONCE = 2048


@dataclass
class Model:
    """The network and the two numbers that turn a document's highest logit into a probability; or a constant."""

    network: gru.Network | None
    slope: float
    offset: float
    constant: float = 0.0


def held_out(doc_id: Column) -> Column:
    """Rows that never train: CRC-32 of the doc_id as text leaves 2 when divided by 4. A null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _window_logits(network: gru.Network, x: np.ndarray, at: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    found = np.zeros(len(first), np.float32)
    for start in range(0, len(first), SCORED_AT_ONCE):
        stop = start + SCORED_AT_ONCE
        table, mask = gru.laid_out(at, first[start:stop], length[start:stop], WIDTH)
        used = max(1, int(length[start:stop].max(initial=0)))
        found[start:stop] = network.logits(x, table[:, :used], mask[:, :used])
    return found


def _document_logits(network: gru.Network, texts: pa.Array) -> np.ndarray:
    """The highest window logit of each text."""
    words, at, begins = gru.split_words(texts)
    x = network.inputs(gru.Hashed(words)) if len(words) else np.zeros((1, gru.INPUT), np.float32)
    first, length, owner = gru.windows(begins, WIDTH, STRIDE)
    found = _window_logits(network, x, at, first, length)
    highest = np.full(len(texts), -np.inf, np.float32)
    np.maximum.at(highest, owner, found)
    return highest


def _bounded(doc_id: Column, text: Column) -> Column:
    """A text that trains: the whole text, or passages of a very long one without the words that their ends cut."""
    count = F.ceil(F.length(text) / PASSAGE).cast("int")
    ranked = F.array_sort(F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(F.xxhash64(doc_id, i).alias("rank"), i.alias("i"))))
    drawn = F.array_sort(F.transform(F.slice(ranked, 1, PASSAGES), lambda r: r["i"]))
    cut = r"^[^\x20\x09-\x0D]*[\x20\x09-\x0D]|[\x20\x09-\x0D][^\x20\x09-\x0D]*$"
    passages = F.transform(drawn, lambda i: F.regexp_replace(text.substr(i * PASSAGE + 1, F.lit(PASSAGE)), cut, ""))
    return F.when(F.octet_length(text) <= TRAINING_BYTES, text).otherwise(F.array_join(passages, " "))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the training sample, at most TOXIC_ROWS + OTHER_ROWS rows, drawn by a hash of the doc_id."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # a document labelled both ways teaches nothing
    agreed = usable.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most")
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    # limited are only labels whose document is there
    present = materialize(agreed.drop("most").join(texts.select("doc_id"), "doc_id", "left_semi"), "toxicity-labels")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    toxic = present.where("toxic = 1").orderBy(*order).limit(TOXIC_ROWS)
    other = present.where("toxic = 0").orderBy(*order).limit(OTHER_ROWS)
    chosen = toxic.union(other).select("doc_id", "toxic")
    # the sample's size is bounded above; equal doc_ids give one text, the smallest
    bounded = texts.join(F.broadcast(chosen), "doc_id").withColumn("text", _bounded(F.col("doc_id"), F.col("text")))
    return bounded.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, seed: int = 7) -> Model:
    """Train on a bounded sample of the labelled documents that are not held out, in one task.

    Four fifths of the sample train the network, on the windows with the most
    evidence of toxic documents, and of the others on random ones and on those that look most toxic; the last
    fifth fits the probabilities. With fewer than five documents of a class in either
    part there is no last fifth: all of the sample trains, and the probabilities are fitted on
    it without each document's own evidence, so they are too sure. If the labels lack one of the two classes, the
    model gives every document the class it has seen (0 without any label).
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return fit_in_task(_sample(docs, labels), order, lambda sample: _train(sample, seed))


def _train(sample: pa.Table, seed: int) -> Model:
    y = sample.column("toxic").to_numpy().astype(np.float32)
    if not len(y) or y.min() == y.max():
        return Model(None, 0.0, 0.0, float(y.max(initial=0)))
    texts = sample.column("text").combine_chunks()
    texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
    # doc_ids come in hash order, so every fifth is a random one; small samples calibrate on all (see fit)
    calibrating = np.arange(len(y)) % 5 == 4
    if min(y[calibrating].sum(), (1 - y[calibrating]).sum(), y[~calibrating].sum(), (1 - y[~calibrating]).sum()) < 5:
        calibrating = np.zeros(len(y), bool)
    draw = np.random.default_rng(seed)
    words, at, begins = gru.split_words(texts)
    hashed = gru.Hashed(words)
    network = _with_evidence(hashed, at, begins, y, ~calibrating, seed)
    first, length, owner = gru.windows(begins, WIDTH, STRIDE)
    strongest = np.stack([
        np.maximum(network.word_evidence[r, hashed.word], np.maximum.reduceat(network.gram_evidence[r, hashed.grams], hashed.cuts[:-1]))
        for r in (1, 2)
    ])
    table, mask = gru.laid_out(at, first, length, WIDTH)
    label = y[owner].astype(np.int64)[:, None]
    found = np.where(mask > 0, strongest[label, table], -9.0).max(axis=1) + 0.01 * draw.random(len(first))
    order = np.lexsort((-found, owner))
    rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order], side="left")
    # the two strongest windows of toxic documents; of the others the strongest, which is the hardest, and a random one
    toxic = y[owner[order]] == 1
    tried = order[((toxic & (rank < 2)) | (~toxic & ((rank == 0) | (draw.random(len(order)) < 0.15)))) & ~calibrating[owner[order]]]
    toxic_window = y[owner] == 1
    weight = np.where(toxic_window, len(tried) / max(1, 2 * (y[owner[tried]] == 1).sum()), 1.0).astype(np.float32)
    optimiser = gru.Adam(network, RATE, DECAY)
    others = np.flatnonzero(~toxic_window & ~calibrating[owner])
    epochs = max(EPOCHS, -(-UPDATES // -(-len(tried) // BATCH)))
    mining = {epochs // 3, 2 * epochs // 3}
    for epoch in range(epochs):
        if epoch in mining:  # from now on also the window of each other document that the network finds most toxic
            found = _window_logits(network, network.inputs(hashed, 1), at, first[others], length[others])
            last = np.lexsort((found, owner[others]))
            ends = np.flatnonzero(np.diff(owner[others][last], append=-1))
            tried = np.union1d(tried, others[last[ends]])
        shuffled = draw.permutation(tried)
        for start in range(0, len(shuffled), BATCH):
            batch = shuffled[start : start + BATCH]
            y_batch = y[owner[batch]]
            # a word of a toxic and of another document is two inputs, as each leaves its own document's evidence out
            own = table[batch] * 2 + y_batch[:, None].astype(np.int64)
            used, local = np.unique(own, return_inverse=True)
            part = gru.Hashed(words.take(pa.array(used // 2)))
            # a window without words goes with every batch, as one of a document that is not toxic
            places = np.vstack([local.reshape(own.shape), np.zeros((1, WIDTH), np.int64)])
            masks = np.vstack([mask[batch], np.zeros((1, WIDTH), np.float32)])
            target, weights = np.append(y_batch, np.float32(0)), np.append(weight[batch], np.float32(1))
            optimiser.update(network.gradients(part, 1 + used % 2, places, masks, target, weights, draw))
    logits = np.full(len(y), -np.inf, np.float32)
    if calibrating.any():
        logits[calibrating] = _document_logits(network, texts.filter(pa.array(calibrating)))
    else:  # a small sample calibrates itself, again without each document's own evidence
        for label in (0, 1):
            rows = np.flatnonzero(y[owner] == label)
            found = _window_logits(network, network.inputs(hashed, 1 + label), at, first[rows], length[rows])
            np.maximum.at(logits, owner[rows], found)
    fitted = np.isfinite(logits)
    slope, offset = _calibrated(logits[fitted], y[fitted])
    return Model(network, slope, offset)


def _with_evidence(hashed: gru.Hashed, at: np.ndarray, begins: np.ndarray, y: np.ndarray, training: np.ndarray, seed: int) -> gru.Network:
    by_word, by_gram = [], []
    rows = np.flatnonzero(training)
    sizes = np.diff(hashed.cuts)
    for row in rows:
        own = np.unique(at[begins[row] : begins[row + 1]])
        by_word.append(np.unique(hashed.word[own]))
        starts = np.repeat(hashed.cuts[own] - np.cumsum(sizes[own]) + sizes[own], sizes[own])
        by_gram.append(np.unique(hashed.grams[starts + np.arange(len(starts))]))
    return gru.Network(gru.evidence(by_word, y[rows]), gru.evidence(by_gram, y[rows]), seed)


def _calibrated(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit, by Newton steps, with targets drawn in from 0 and 1; never a falling one."""
    positive, negative = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    centre, scale = float(logits.mean()), float(logits.std()) + 1e-6
    x = np.stack([(logits.astype(np.float64) - centre) / scale, np.ones(len(y))], axis=1)
    w = np.array([1.0, np.log((positive + 1) / (negative + 1))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-2 * (w * [1, 0]))
        w -= np.clip(step, -1, 1)
    slope = max(float(w[0]), 0.05) / scale
    return slope, float(w[1]) - slope * centre


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``toxicity`` (0 to 1) to every row of ``docs``, from the whole text alone (column text).

    The score comes from the window with the highest logit. Null, empty and
    wordless texts have one window without words. Repeated rows score alike. A
    column named toxicity is overwritten. Empty table: no rows.
    """
    worker_path(docs.sparkSession)
    rest = docs.drop("toxicity")
    if model.network is None:
        return rest.withColumn("toxicity", F.lit(model.constant))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inside, own_columns = numbered(rest)
    text = inside.columns[rest.columns.index("text")]

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for part in text_slices(batch, text):
                logits = _document_logits(fitted.network, part.column(text)).astype(np.float64)
                found = 1 / (1 + np.exp(-np.clip(fitted.slope * logits + fitted.offset, -40, 40)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], names=[*part.schema.names, "toxicity"])

    scored = inside.mapInArrow(rate, T.StructType([*inside.schema, T.StructField("toxicity", T.DoubleType())]))
    return scored.select(*own_columns, "toxicity")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic; ``training`` (default: ``docs``) has the labelled texts."""
    model = fit(docs if training is None else training, labels)
    return score(docs, model).where(F.col("toxicity") < THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])
