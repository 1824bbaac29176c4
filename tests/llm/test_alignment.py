"""Token alignment against a byte-by-byte version, and the fragments' monoid laws."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from demandloom.llm import alignment, registry
from demandloom.llm.alignment import IDENTITY, START, Tokens, compose, fragment
from tests.llm.helpers import SF_DIR, as_set, no_documents, odd_documents


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(registry.BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=registry.PIECE_BPE)


def token_bytes(a, b, text):
    """(id, bytes) of both tokenizers, or None: A through its own decoder, B by its pieces."""
    alphabet = {c: i for i, c in _byte_letters().items()}
    of_a = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    of_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        is_byte = len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">")
        of_b.append((i, bytes.fromhex(piece[3:5]) if is_byte else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(t for _, t in of_a) != whole or b"".join(t for _, t in of_b) != whole:
        return None
    return of_a, of_b


def _byte_letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, n = {}, 0
    for i in range(256):
        if i in plain:
            letters[i] = chr(i)
        else:
            letters[i] = chr(256 + n)
            n += 1
    return letters


def brute_links(of_a, of_b):
    """Byte by byte: the pairs of token numbers that share a byte, and the groups."""
    owner_a = [n for n, (_, t) in enumerate(of_a) for _ in t]
    owner_b = [n for n, (_, t) in enumerate(of_b) for _ in t]
    links = sorted(set(zip(owner_a, owner_b, strict=True)))
    groups, part_a, part_b = [], [], []
    for i in range(len(owner_a)):
        end_a = i + 1 == len(owner_a) or owner_a[i + 1] != owner_a[i]
        end_b = i + 1 == len(owner_b) or owner_b[i + 1] != owner_b[i]
        part_a += [of_a[owner_a[i]][0]] * end_a
        part_b += [of_b[owner_b[i]][0]] * end_b
        if end_a and end_b:
            groups.append(",".join(map(str, part_a)) + "|" + ",".join(map(str, part_b)))
            part_a, part_b = [], []
    return [(of_a[i][0], of_b[j][0]) for i, j in links], groups


def brute(rows, both):
    a, b = both
    found = []
    for doc_id, text in rows:
        tokens = token_bytes(a, b, text) if text else None
        found.append((doc_id, *(map(len, tokens) if tokens else (0, 0)), *(brute_links(*tokens) if tokens else ([], []))))
    counts = Counter(pair for row in found for pair in set(row[3]))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return as_set(
        (doc_id, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
        for doc_id, n_a, n_b, links, groups in found
    )


def test_whole_table(spark, both):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = registry.token_alignment(spark, SF_DIR)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert as_set(found.collect()) == brute(rows, both)


def test_odd_rows_and_small_blocks(spark, both, monkeypatch):
    docs = odd_documents(spark).select("doc_id", "text").union(spark.createDataFrame([
        (90, "▁ is no space"), (91, "two  spaces   three\t\ttabs \n"), (92, "<s> </s> <unk> <0x41> <|endoftext|>"), (93, "nul\x00byte"),
        (94, "กำ á \U0001f469‍\U0001f4bb ﻿"), (95, " "), (96, "x y " * 40_000),
    ], "doc_id long, text string"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert as_set(alignment.digest(docs, registry.BYTE_BPE, registry.PIECE_BPE).collect()) == brute(rows, both)


def test_empty_table_and_clashing_names(spark, both):
    assert alignment.digest(no_documents(spark), registry.BYTE_BPE, registry.PIECE_BPE).count() == 0
    docs = spark.createDataFrame(
        [(1, "some words", 1, 2, 3, 4, 5, 6, 7)],
        "doc_id long, text string, key long, part long, block long, link_a long, pair long, total long, groups long",
    )
    assert as_set(alignment.digest(docs, registry.BYTE_BPE, registry.PIECE_BPE).collect()) == brute([(1, "some words")], both)


def test_groups_and_links_of_one_text(spark):
    docs = spark.createDataFrame([(1, "Hello world")], "doc_id long, text string")
    row = alignment.align(docs, registry.BYTE_BPE, registry.PIECE_BPE).first()
    assert [len(side.split(",")) for g in row.groups.split(";") for side in g.split("|")]
    assert row.n_groups == row.groups.count(";") + 1
    assert sum(row.link_times) == row.n_links and len(row.link_a) == len(row.link_b)


ENDS = st.lists(st.integers(1, 4), max_size=30).map(lambda sizes: np.cumsum(np.array(sizes, np.int64)))


def tokens_of(a_ends, b_ends, high):
    """Tokens with both streams ending at the same byte."""
    a_ends, b_ends = (np.append(e[e < high], high).astype(np.int64) for e in (a_ends, b_ends))
    return Tokens(a_ends * 7 % 11, a_ends, b_ends * 5 % 13, b_ends)


def same(x, y):
    assert (x.n_a, x.n_b, x.cut, x.closed.n_groups, x.closed.groups) == (y.n_a, y.n_b, y.cut, y.closed.n_groups, y.closed.groups)
    arrays = lambda f: [*f.prefix, *f.suffix, f.closed.pairs, f.closed.times]
    for one, other in zip(arrays(x), arrays(y), strict=True):
        assert one.tolist() == other.tolist()


@settings(max_examples=200, deadline=None)
@given(ENDS, ENDS, st.integers(1, 60), st.lists(st.integers(0, 60), min_size=1, max_size=4))
def test_fragments_compose_associatively(a_ends, b_ends, high, cuts):
    """Any byte ranges, also ones that cut tokens in two, in any bracketing, give the fragment of the whole."""
    tokens = tokens_of(a_ends, b_ends, high)
    bounds = [-1, *sorted(c for c in cuts if c < high), high]
    parts = [fragment(tokens.between(lo, up)) for lo, up in zip(bounds, bounds[1:], strict=False)]
    whole = fragment(tokens)
    left = IDENTITY
    for part in parts:
        left = compose(left, part)
    right = IDENTITY
    for part in reversed(parts):
        right = compose(part, right)
    same(left, whole)
    same(right, whole)
    assert compose(START, left).suffix.a.tolist() == []
    assert compose(None, whole) is None and compose(whole, None) is None


PARTS = st.sampled_from([
    " ", "  ", "\n", "\t", "a", "It's", "don't", "'s", "déjà", "12", "3,4", ".", "-", "_", "日本", "один", "\u00a0", "\u3000", "\u200b", "\u0301",
    "\x1c", "\x85", "\U0001f600", "▁", "<s>", "<0x41>", "<|endoftext|>", "\x00", "\u2028", "ﬁ", "\u00ad", "x" * 30,
])


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=30).map("".join))
def test_cuts_change_no_token(both, text):
    """Each tokenizer gives the pieces between cuts the tokens that they have in the whole."""
    a, b = both
    cut = alignment._cut(text)
    assert " ".join(cut) == text
    whole = a.encode(" " + text, add_special_tokens=False).ids
    assert [i for p in cut for i in a.encode(" " + p, add_special_tokens=False).ids] == whole
    assert alignment.aligner(registry.BYTE_BPE, registry.PIECE_BPE).encode(" " + text) == whole
    if "▁" not in text:
        assert [i for p in cut for i in b.encode(p)] == b.encode(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(PARTS, min_size=1, max_size=12).map("".join), min_size=1, max_size=6))
def test_fragments_of_texts(both, texts):
    """Fragments from remembered pieces, also in ranges of a few letters, are those of the tokens of the whole."""
    made = alignment.aligner(registry.BYTE_BPE, registry.PIECE_BPE)
    a, b = both
    for text, found in zip(texts, made.fragments(texts), strict=True):
        tokens = token_bytes(a, b, text)
        assert (found is None) == (tokens is None)
        if tokens is None:
            continue
        ids, sizes = [[i for i, _ in t] for t in tokens], [[len(x) for _, x in t] for t in tokens]
        whole = Tokens(np.array(ids[0]), np.cumsum(sizes[0]), np.array(ids[1]), np.cumsum(sizes[1]))
        same(compose(START, found), compose(START, fragment(whole)))


def test_ranges_of_a_long_text(both, monkeypatch):
    monkeypatch.setattr(alignment, "RANGE", 50)
    text = "It's déjà vu, 12 345 a  b\n\nc d's x_y z - 日本 語 один два  три.  Don't stop 'here now' _ 7 up " * 9
    cut = list(alignment.ranges(text))
    assert " ".join(cut) == text and len(cut) > 10
    made = alignment.aligner(registry.BYTE_BPE, registry.PIECE_BPE)
    one = IDENTITY
    for found in made.fragments(cut):
        one = compose(one, found)
    same(compose(START, one), compose(START, made.fragments([text])[0]))


def test_the_memory_of_pieces_is_bounded(monkeypatch):
    made = alignment.Aligner(registry.BYTE_BPE, registry.PIECE_BPE)
    monkeypatch.setattr(alignment, "REMEMBERED", 100)
    wanted = alignment.aligner(registry.BYTE_BPE, registry.PIECE_BPE).fragments([f"word{i} here" for i in range(50)])
    found = [made.fragments([f"word{i} here"])[0] for i in range(50)]
    assert len(made.numbers) < 20
    for x, y in zip(found, wanted, strict=True):
        same(x, y)


def test_no_piece_of_b_crosses_a_word_start(both):
    """What the cuts rest on: a piece never holds a space after anything but spaces."""
    _, b = both
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    assert not [p for p in pieces if "▁" in p.lstrip("▁")]


def test_a_task_has_one_python_worker(spark):
    """Python steps are parted by shuffles: two in a row would keep two workers, each with its remembered pieces."""
    docs = spark.createDataFrame([(1, "a b"), (2, "some more words " * 40_000)], "doc_id long, text string")
    plan = alignment.align(docs, registry.BYTE_BPE, registry.PIECE_BPE)._jdf.queryExecution().executedPlan().toString()
    inside, steps = False, 0
    for line in plan.splitlines():
        if "Exchange" in line or "Union" in line or "Scan" in line:
            inside = False
        elif "InArrow" in line or "InPandas" in line:
            assert not inside, plan
            inside, steps = True, steps + 1
    assert steps >= 4


def test_numbers_of_blocks_in_a_task_and_in_all(spark):
    """Rows of long texts are dealt to blocks as those of short ones are, and no two tasks share a block."""
    docs = spark.createDataFrame([(i, f"word{i} some more words " * (2_000 + i if i < 30 else 1)) for i in range(40)], "doc_id long, text string")
    found = alignment.align(docs.repartition(8), registry.BYTE_BPE, registry.PIECE_BPE)
    rows = found.select("doc_id", "block", F.spark_partition_id().alias("task")).collect()
    assert sorted(r.doc_id for r in rows) == list(range(40))
    tasks = {}
    for r in rows:
        assert tasks.setdefault(r.block, r.task) == r.task
    assert len(set(tasks.values())) == len(tasks) > 1
