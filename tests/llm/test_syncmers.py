import hashlib
import random
import re

import xxhash

from demandloom.llm import registry, syncmers
from tests.llm.helpers import SCHEMA, SF_DIR, no_documents, odd_documents, odd_rows

K, S = syncmers.K, syncmers.S


def of_words(spark_hashes):
    """Spark's hash of several longs: each is hashed with the last result as seed."""
    seed = 42
    for value in spark_hashes:
        seed = xxhash.xxh64_intdigest((value & (1 << 64) - 1).to_bytes(8, "little"), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def anchors(text):
    """The chosen runs, or else one anchor of all words."""
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return syncmer_anchors(text) or [(of_words(hashes) & (1 << 64) - 1) >> 32] * bool(hashes)


def syncmer_anchors(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    hashes = [h - (1 << 64) if h >> 63 else h for h in hashes]
    if not words:
        return []
    inner = [of_words(hashes[i : i + S]) for i in range(len(words) - S + 1)] if len(words) >= K else []
    found = []
    for i in range(len(words) - K + 1):
        run = inner[i : i + K - S + 1]
        if min(run) in (run[0], run[-1]):
            found.append((of_words(run) & (1 << 64) - 1) >> 32)
    return found


def likeness(a, b):
    """Each anchor's occurrences in a row by place; neighbours of different documents pair up; the middle shift decides."""
    pairs = {0: [], 1: []}
    for anchor in set(a) & set(b):
        places = sorted([(i, 0) for i, x in enumerate(a) if x == anchor] + [(i, 1) for i, x in enumerate(b) if x == anchor])
        for (i, side), (j, other) in zip(places, places[1:]):
            if side != other:
                pairs[side].append(j - i if side == 0 else i - j)
    shifts = sorted(pairs[0] if len(pairs[0]) >= len(pairs[1]) else pairs[1])
    total = len(a) + len(b)
    if not total:
        return 1.0
    if not shifts:
        return 0.0
    middle = shifts[len(shifts) // 2]
    return 2.0 * sum(abs(d - middle) <= 4 + 0.05 / 2 * total for d in shifts) / total


def expected(rows):
    rows = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, e, n = anchors(text), anchors(edited), anchors(following)
        out.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join("%08x" % x for x in a),
            "".join("%08x" % x for x in e), likeness(a, e), likeness(a, n),
        ))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    found = syncmers.fingerprint(odd_documents(spark)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == expected(odd_rows())


def test_single_document_follows_itself(spark):
    rows = [(5, "a b c d e f g h i j", "en", "s", 1)]
    found = syncmers.fingerprint(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(r) for r in found] == expected(rows)
    assert found[0].near_next == 1.0


def test_whole_table(spark):
    found = registry.syncmer_fingerprints(spark, SF_DIR)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert syncmers.fingerprint(no_documents(spark)).count() == 0


def test_short_texts_without_syncmers_differ(spark):
    draw = random.Random(3)
    texts = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(draw.choice([5, 6]))) for _ in range(300)]
    bare = [t for t in texts if not syncmer_anchors(t)]
    assert len(bare) > 20
    rows = [(2 * i, t, "en", "s", 1) for i, t in enumerate(bare)] + [(2 * len(bare), "", "en", "s", 0), (2 * len(bare) + 2, " ", "en", "s", 0)]
    found = {r.doc_id: r for r in syncmers.fingerprint(spark.createDataFrame(rows, SCHEMA)).collect()}
    prints = [found[2 * i].fingerprint for i in range(len(bare))]
    assert all(len(p) == 8 for p in prints) and len(set(prints)) == len(bare)
    assert all(found[2 * i].near_next == 0.0 for i in range(len(bare)))
    assert [found[2 * i].fingerprint for i in (len(bare), len(bare) + 1)] == ["", ""] and found[2 * len(bare)].near_next == 1.0


def test_positions_decide(spark):
    """Swapped halves, repeats and additions, each next to the text itself."""
    draw = random.Random(8)
    words = [f"w{draw.randrange(10**6)}" for _ in range(400)]
    text = " ".join(words)
    others = {
        "same": text,
        "swapped": " ".join(words[200:] + words[:200]),
        "headed": " ".join(["some", "new", "words", "come", "first"] * 8 + words),
        "inserted": " ".join(words[:150] + ["x", "y", "z"] + words[150:]),
        "twice": text + " " + text,
        "cut": " ".join(words[:100]),
        "strange": " ".join(f"v{draw.randrange(10**6)}" for _ in range(400)),
    }
    rows = []
    for i, other in enumerate(others.values()):
        rows += [(2 * i, text, "en", "s", 1), (2 * i + 1, other, "en", "s", 1)]
    found = {r.doc_id: r.near_next for r in syncmers.fingerprint(spark.createDataFrame(rows, SCHEMA)).collect()}
    near = {name: found[2 * i] for i, name in enumerate(others)}
    assert near["same"] == 1.0 and near["strange"] == 0.0
    assert 0.4 < near["swapped"] < 0.6
    assert near["headed"] > 0.9 and near["inserted"] > 0.95
    assert 0.6 < near["twice"] < 0.7 and 0.35 < near["cut"] < 0.45


def test_anchor_positions(spark):
    rows = {r.position: r.anchor for r in syncmers.anchor_positions(spark.createDataFrame([(1, "a b c d e f g h i j k l")], "doc_id long, text string")).collect()}
    assert [rows[i] for i in range(len(rows))] == anchors("a b c d e f g h i j k l")
