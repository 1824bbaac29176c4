"""Periodic runs against a brute-force search, and the grammar's extensions against plain comparison."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from demandloom.llm import periodic, registry
from demandloom.llm.recompression import Grammar
from tests.llm.helpers import SF_DIR, as_set, no_documents, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Every period's maximal stretches; of equal bounds the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(24, 3 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *figures, sha(lines), sha(kept))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 30)), max_size=6))
def test_runs_of_repeated_pieces(pieces):
    words = [w for piece, times in pieces for w in piece * times]
    other = words[::-1] + [7] * 40
    found = periodic.find_in([np.array(words, np.int64), np.array(other, np.int64), np.array([], np.int64)])
    assert [tuple(r) for r in found[0].tolist()] == brute_runs(words)
    assert [tuple(r) for r in found[1].tolist()] == brute_runs(other)
    assert len(found[2]) == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=2, max_size=80), st.integers(1, 20), st.data())
def test_extensions(piece, times, data):
    words = piece * times
    letters = np.array([2, *words, 3], np.int64)
    grammar = Grammar(letters, 2, 4)
    pairs = [(i, j) for i in range(1, len(words) + 1) for j in range(i + 1, min(len(words) + 1, i + 40))][:4000]
    a, b = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
    forward = grammar.extend(a, b)
    backward = grammar.extend(a, b, backward=True)
    for k in data.draw(st.lists(st.integers(0, len(pairs) - 1), max_size=30)):
        i, j = pairs[k]
        plain = 0
        while letters[i + plain] == letters[j + plain]:
            plain += 1
        assert forward[k] == plain
        plain = 0
        while letters[i - plain] == letters[j - plain]:
            plain += 1
        assert backward[k] == plain


def test_grammar_of_one_repeated_word_is_small():
    letters = np.r_[1, np.zeros(200_000, np.int64), 2]
    grammar = Grammar(letters, 1, 20)
    assert len(grammar.name) < 200_100
    assert grammar.extend(np.array([1, 5]), np.array([2, 100_000])).tolist() == [199_999, 100_001]


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = as_set(registry.periodic_runs(spark, SF_DIR).collect())
    assert found == as_set(brute_row(*r) for r in rows)
    assert sum(1 for r in found if r[1]) > 10


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id != 60]
    found = periodic.digest(docs).collect()
    assert as_set(r for r in found if r.doc_id != 60) == as_set(brute_row(*r) for r in rows)
    assert len(found) == docs.count()


@pytest.mark.parametrize("text, runs, collapsed", [
    (None, [], ""),
    ("  \n ", [], ""),
    ("a " * 23, [], " ".join("a" * 23)),
    ("x " + "a " * 24 + "y", [(1, 24, 1)], "x a y"),
    ("a b c d e f g h i " * 3, [(0, 27, 9)], "a b c d e f g h i"),
    ("a b c d e f g h i " * 2 + "a b c d e f g h", [], "a b c d e f g h i a b c d e f g h i a b c d e f g h"),
])
def test_texts(spark, text, runs, collapsed):
    row = periodic.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == runs
    assert row.collapsed == collapsed


def test_empty_table_and_clashing_names(spark):
    assert periodic.digest(no_documents(spark)).count() == 0
    docs = spark.createDataFrame(
        [(1, "a b " * 20, 1, 2, 3, 4, 5, 6, 7)],
        "doc_id long, text string, runs long, _h long, _words long, _n long, _a long, _best long, collapsed long",
    )
    assert [tuple(r) for r in periodic.digest(docs).collect()] == [brute_row(1, "a b " * 20)]


def test_a_long_text(spark):
    text = "one two three " * 60_000
    row = periodic.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(0, 180_000, 3)]
    assert row.collapsed == "one two three"
