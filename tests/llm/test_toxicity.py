import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from demandloom.llm import gru, toxicity
from tests.llm.helpers import SCHEMA, no_documents, odd_documents, odd_rows


@pytest.fixture(scope="module")
def corpus(spark):
    """Prose; in a third of it insults, some of them with ever new endings."""
    draw = random.Random(9)
    words = [a + b for a in ("ba", "ko", "li", "nu", "se", "ti") for b in ("ran", "dol", "mer", "pis", "tu")]
    insults = ["gromf", "zworp"]
    rows, labels = [], []
    for i in range(900):
        text = [draw.choice(words) + draw.choice(["", "a", "en", "ou"]) for _ in range(draw.randint(20, 300))]
        if i % 3 == 0:
            for _ in range(1 + len(text) // 40):
                text.insert(draw.randrange(len(text)), draw.choice(insults) if draw.random() < 0.5 else "kvarx" + draw.choice(words))
        rows.append((i, " ".join(text).capitalize() + ".", "en", "s", 1))
        labels.append((i, 1, int(i % 3 == 0)))
    return spark.createDataFrame(rows, SCHEMA).cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache()


@pytest.fixture(scope="module")
def model(corpus):
    return toxicity.fit(*corpus)


def test_held_out_accuracy(corpus):
    rows = toxicity.classify(*corpus).collect()
    assert len(rows) == 900
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 3 == 0) for r in held]) > 0.95


def test_held_out_labels_do_not_matter(corpus):
    docs, labels = corpus
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(labels.doc_id), 1 - labels.toxic).otherwise(labels.toxic))
    key = ["doc_id", "toxic"]
    assert sorted(toxicity._sample(docs, labels).select(key).collect()) == sorted(toxicity._sample(docs, turned).select(key).collect())


def test_gradients_against_differences():
    draw = np.random.default_rng(2)
    words = pa.array(["aa", "bcd", "xyzzy", "q", "lorem"])
    hashed = gru.Hashed(words)
    network = gru.Network(draw.standard_normal((3, gru.BUCKETS)).astype(np.float32), draw.standard_normal((3, gru.BUCKETS)).astype(np.float32))
    at, mask = draw.integers(0, 5, (6, 7)), np.ones((6, 7), np.float32)
    mask[2, 4:], mask[3, 1:] = 0, 0
    y, weight = draw.integers(0, 2, 6).astype(np.float32), np.ones(6, np.float32)
    row = draw.integers(0, 3, 5)

    class Always:
        """Keeps the embeddings of every word, at twice their size."""

        def random(self, shape):
            return np.zeros(shape)

    gradients = network.gradients(hashed, row, at, mask, y, weight, Always())

    def loss():
        x = network.inputs(hashed, row)
        x[:, : 2 * gru.EMBED] *= 2
        z = network.logits(x, at, mask).astype(np.float64)
        return float(np.mean(np.log1p(np.exp(-np.where(y == 1, z, -z)))))

    for name, values in network.p.items():
        flat, wanted = values.reshape(-1), gradients[name].reshape(-1)
        for i in np.argsort(-np.abs(wanted))[:3]:
            old = flat[i]
            flat[i] = old + 1e-2
            above = loss()
            flat[i] = old - 1e-2
            below = loss()
            flat[i] = old
            assert abs((above - below) / 2e-2 - wanted[i]) < 2e-3 + 0.03 * abs(wanted[i]), name


def test_windows_cover_every_word():
    begins = np.concatenate([[0], np.cumsum([0, 1, 64, 65, 200, 3])])
    first, length, owner = gru.windows(begins, 64, 48)
    for text in range(6):
        covered = set()
        for f, n in zip(first[owner == text], length[owner == text]):
            assert n <= 64
            covered |= set(range(f, f + n))
        assert covered == set(range(begins[text], begins[text + 1]))


def test_one_insult_anywhere_in_a_long_text_counts(spark, model):
    draw = random.Random(1)
    prose = [draw.choice(["baran", "komer", "lidolen", "nupis", "seran"]) for _ in range(5000)]
    texts = [" ".join(prose), " ".join([*prose[:4000], "gromf", "zworp", *prose[4000:]])]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scores = {r.doc_id: r.toxicity for r in toxicity.score(table, model).collect()}
    assert scores[1] > 0.3 > scores[0]


def test_odd_documents(spark, model):
    odd = odd_documents(spark).withColumnRenamed("lang", "toxicity")
    scored = toxicity.score(odd, model)
    assert scored.columns == ["doc_id", "text", "source", "n_chars", "toxicity"]
    rows = scored.collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.toxicity <= 1 for r in rows)
    assert len({r.toxicity for r in rows if not (r.text or "").strip()}) == 1
    assert toxicity.score(no_documents(spark), model).count() == 0


def test_missing_labels(spark, corpus):
    docs, labels = corpus
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == 900
    assert toxicity.drop_toxic(docs, labels.where("toxic = 0")).count() == 900
    assert toxicity.drop_toxic(docs, labels.where("toxic = 1")).count() == 0
    odd = spark.createDataFrame([(None, 1, 1), (1, 1, None), (0, 0, 0), (0, 1, 1)], labels.schema)
    assert toxicity.drop_toxic(docs, odd).count() == 900
    assert toxicity.classify(no_documents(spark), labels).count() == 0


def test_labels_without_documents_do_not_shrink_the_sample(spark, corpus, monkeypatch):
    docs, labels = corpus
    monkeypatch.setattr(toxicity, "TOXIC_ROWS", 30)
    monkeypatch.setattr(toxicity, "OTHER_ROWS", 40)
    absent = spark.range(1000, 20_000).selectExpr("id AS doc_id", "1 AS quality", "CAST(id % 2 AS INT) AS toxic")
    rows = toxicity._sample(docs, labels.union(absent)).collect()
    assert sum(r.toxic == 1 for r in rows) == 30 and sum(r.toxic == 0 for r in rows) == 40


def test_long_labelled_texts_train(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAINING_BYTES", 16_384)
    monkeypatch.setattr(toxicity, "PASSAGES", 16)
    texts = [" ".join(f"w{i}x{n}" for n in range(4000)) for i in range(8)] + ["short one", "x" * 20_000, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(texts))], "doc_id long, toxic int")
    rows = {r.doc_id: r.text for r in toxicity._sample(docs, labels).collect()}
    assert set(rows) == {i for i, t in enumerate(texts) if t is not None and zlib.crc32(str(i).encode()) % 4 != 2}
    for i, text in rows.items():
        assert len(text) <= max(toxicity.PASSAGES * (toxicity.PASSAGE + 1), 16_384)
        assert texts[i] == "x" * 20_000 or set(text.split()) <= set(texts[i].split())
        if i < 8:  # passages of all of it, in its order
            places = [int(w.split("x")[1]) for w in text.split()]
            assert places == sorted(places) and len(places) > 1000 and places[0] < 1000 and places[-1] > 3000


def test_texts_train_whole(spark):
    texts = [" ".join(f"w{i}x{n}" for n in range(4000)) for i in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, toxic int")
    rows = {r.doc_id: r.text for r in toxicity._sample(docs, labels).collect()}
    assert rows and all(texts[i] == text for i, text in rows.items())


def plain_score(model, text):
    """Every window on its own: its words one by one, the network on a single row, the highest logit of all."""
    low = "".join(w.lower() for w in [text or ""])
    words = [w.strip(gru._MARKS) for w in low.translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ")]
    words = [w for w in words if w]
    starts = [0]
    while starts[-1] + toxicity.WIDTH < len(words):
        starts.append(starts[-1] + toxicity.STRIDE)
    logits = []
    for start in starts:
        window = words[start : start + toxicity.WIDTH]
        x = np.concatenate([model.network.inputs(gru.Hashed(pa.array([w], pa.string()))) for w in window] or [np.zeros((1, gru.INPUT), np.float32)])
        at, mask = np.arange(max(1, len(window)))[None, :], np.full((1, max(1, len(window))), float(bool(window)), np.float32)
        logits.append(float(model.network.logits(x, at, mask)[0]))
    return 1 / (1 + np.exp(-np.clip(model.slope * max(logits) + model.offset, -40, 40)))


def test_scores_equal_a_plain_version(spark, model):
    texts = [r[1] for r in odd_rows() if len(r[1] or "") < 6000] + ["Gromf! " * 70 + "baran " * 200, "¿Qué? «ZWORP»\u00a0x " * 40, "a " * 64, "a " * 65, "a " * 97]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.score(table, model).collect():
        assert abs(r.toxicity - plain_score(model, texts[r.doc_id])) < 1e-4, r.doc_id


def test_short_passages_lie_whole_in_a_window():
    begins = np.array([0, 1000])
    first, length, _ = gru.windows(begins, toxicity.WIDTH, toxicity.STRIDE)
    for start in range(1000 - 32):
        assert any(f <= start and start + 32 <= f + n for f, n in zip(first, length))
