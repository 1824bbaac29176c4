import random

import numpy as np
import pytest

from demandloom.llm import quality
from tests.llm.helpers import SCHEMA, no_documents, odd_documents, odd_rows


@pytest.fixture(scope="module")
def corpus(spark):
    """Prose, and the same words shouted or repeated; two fifths carry labels."""
    draw = random.Random(8)
    words = [a + b for a in ("ba", "ko", "li", "nu", "se", "ti") for b in ("ran", "dol", "mer", "pis", "tu")]
    rows, labels = [], []
    for i in range(900):
        bad = i % 6 == 0
        text = [draw.choice(words) for _ in range(draw.randint(15, 120))]
        if bad and i % 12 == 0:
            text = [w.upper() + "!!" for w in text]
        elif bad:
            text = [w for w in text[:6] for _ in range(15)]
        rows.append((i, " ".join(text), draw.choice(["en", "de"]), "junk" if bad and draw.random() < 0.7 else draw.choice(["x", "y"]), 1))
        if i % 5 < 2:
            labels.append((i, int(not bad), 0))
    return spark.createDataFrame(rows, SCHEMA).cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache()


def test_unlabelled_documents_are_told_apart(corpus):
    docs, labels = corpus
    found = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(found) == 900
    unseen = [i for i in range(900) if i % 5 >= 2]
    wrong = [i for i in unseen if found[i].keep != int(i % 6 != 0)]
    assert len(wrong) <= 0.02 * len(unseen)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_both_views_take_part(corpus):
    docs, labels = corpus
    rows = quality.classify(docs, labels).where("doc_id % 5 >= 2").collect()
    for view in ("content_score", "metadata_score"):
        good = np.mean([r[view] for r in rows if r.doc_id % 6])
        bad = np.mean([r[view] for r in rows if r.doc_id % 6 == 0])
        assert good > bad + 0.3


def test_odd_documents_and_filter(spark, corpus):
    docs, labels = corpus
    model = quality.fit(docs, labels)
    odd = odd_documents(spark).withColumnRenamed("n_chars", "quality_score")
    scored = quality.score(odd, model)
    assert scored.columns == ["doc_id", "text", "lang", "source", "content_score", "metadata_score", "quality_score"]
    assert scored.count() == len(odd_rows()) and scored.where("quality_score IS NULL OR isnan(quality_score)").count() == 0
    assert quality.score(no_documents(spark), model).count() == 0
    assert quality.drop_poor(docs, labels).columns == docs.columns


def test_missing_labels(spark, corpus):
    docs, labels = corpus
    assert quality.drop_poor(docs, labels.limit(0)).count() == 900
    assert quality.drop_poor(docs, labels.where("quality = 1")).count() == 900
    assert quality.drop_poor(docs, labels.where("quality = 0")).count() == 0
    odd = spark.createDataFrame([(None, 1, 0), (1, None, 0), (0, 0, 0), (0, 1, 1)], labels.schema)
    assert quality.drop_poor(docs, odd).count() == 900
    assert quality.drop_poor(no_documents(spark), labels).count() == 0


def test_labels_without_documents_and_rare_classes_do_not_shrink_the_sample(spark, corpus, monkeypatch):
    docs, labels = corpus
    monkeypatch.setattr(quality, "LABELLED_ROWS", 100)
    absent = spark.range(1000, 60_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    rare = labels.where("quality = 1 OR doc_id < 600").union(absent)
    rows = quality.classify(docs, rare).collect()
    wrong = [r.doc_id for r in rows if r.keep != int(r.doc_id % 6 != 0)]
    assert len(wrong) <= 0.05 * len(rows)


def test_all_unlabelled_documents_take_part(corpus, monkeypatch):
    docs, labels = corpus
    model = quality.fit(docs, labels, rounds=0)
    assert sorted(r.doc_id for r in quality._unlabelled(docs, labels, model).collect()) == [i for i in range(900) if i % 5 >= 2]
    monkeypatch.setattr(quality, "GIVEN_ROWS", 20)
    rows = quality._given(docs, labels, model, 0.45).collect()
    by_view = {(v, y): [r.doc_id for r in rows if (r.view, r.y) == (v, y)] for v in (0, 1) for y in (0, 1)}
    assert all(0 < len(ids) <= 20 for ids in by_view.values()) and all(i % 5 >= 2 for ids in by_view.values() for i in ids)
    assert np.mean([r.y == int(r.doc_id % 6 != 0) for r in rows]) > 0.95


CLASSES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n", ".,;:'\"()-", "!?", "|<>{}[]\\/_", "#$%&*+=@^~`")


def plain_features(text, lang, source):
    """The features of one document, byte by byte."""
    import math
    import zlib

    raw = (text or "").encode()
    grams = [0] * quality.TRIGRAMS
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        grams[(a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D) % 2**32 >> 23] += 1
    content = [math.sqrt(n / max(1, sum(grams))) for n in grams]
    words, lines = (text or "").split(), (text or "").split("\n")
    content += [
        sum(a == b for a, b in zip(words, words[1:])) / len(words), len(set(words)) / len(words) ** 0.9, len(set(lines)) / len(lines),
    ] if words else [0.0, 1.0, 1.0]
    size = max(1, len(raw))
    shares = [0.0] * 9
    for byte in raw:
        shares[next((i for i, members in enumerate(CLASSES, 1) if chr(byte) in members), 0)] += 1 / size
    layout = [
        math.log1p(size), math.log1p(size * shares[4]), math.log1p(1 / max(shares[3] + shares[4], 1e-3)), math.log1p(1 / max(shares[4], 1e-4)),
    ]

    def one_of(value, count):
        return [float(i == (0 if value is None else 1 + zlib.crc32(value.encode()) % (count - 1))) for i in range(count)]

    return content, [math.sqrt(x) for x in shares] + layout + one_of(lang, quality.LANGUAGES) + one_of(source, quality.SOURCES)


def plain_scores(model, text, lang, source):
    import math

    logits = []
    for features, (mean, scale, w) in zip(plain_features(text, lang, source), model.views):
        z = sum((x - m) / s * v for x, m, s, v in zip(features, mean.tolist(), scale.tolist(), w.tolist())) + float(w[-1])
        logits.append(max(-30.0, min(30.0, z)))
    logits.append(sum(z / 4 * float(c) for z, c in zip(logits, model.combine)) + float(model.combine[2]))
    return [1 / (1 + math.exp(-max(-40.0, min(40.0, z)))) for z in logits]


def test_scores_equal_a_plain_version(spark, corpus):
    docs, labels = corpus
    model = quality.fit(docs, labels)
    rows = [r for r in odd_rows() if len(r[1] or "") < 6000] + [(70, "A|B #1\n\nA|B #1\n\t<x> ok!?", "de", "junk", 1)]
    table = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], SCHEMA)
    for r in quality.score(table, model).collect():
        wanted = plain_scores(model, r.text, r.lang, r.source)
        assert np.allclose([r.content_score, r.metadata_score, r.quality_score], wanted, atol=2e-3), r.doc_id


def test_equal_doc_ids_and_ties(spark, corpus):
    """Documents that share a doc_id are each scored by their own text, and equal documents alike, however often they come."""
    docs, labels = corpus
    twice = docs.union(docs.where("doc_id < 100")).union(spark.createDataFrame([(1, "LOUD!! " * 40, "en", "junk", 1)] * 30, SCHEMA))
    rows = quality.classify(twice, labels).collect()
    assert len(rows) == twice.count()
    scores = {}
    for r in rows:
        scores.setdefault(r.doc_id, []).append(round(r.score, 9))
    assert all(len(set(s)) == 1 for i, s in scores.items() if i != 1)
    assert len(scores[1]) == 32 and len(set(scores[1])) == 2
