import hashlib
import time

import pytest
from tokenizers import Tokenizer

from demandloom.llm import bpe, registry
from tests.llm.helpers import as_set, no_documents, odd_documents, odd_rows


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(registry.WORD_BPE)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# all words in the broadcast head, some, none
@pytest.mark.parametrize("head_words", [1 << 20, 20, 0])
def test_round_trip_equals_the_library(spark, model, head_words):
    expected = []
    for doc_id, text, *_ in odd_rows():
        ids = model.encode(text or "", add_special_tokens=False).ids
        decoded = model.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), digest(" ".join(map(str, ids))), digest(decoded)))
    found = bpe.round_trip(odd_documents(spark), registry.WORD_BPE, head_words).collect()
    assert as_set(found) == as_set(expected)


def test_encode_keeps_columns_and_decode_inverts(spark, model):
    docs = odd_documents(spark).withColumnRenamed("lang", "word").withColumnRenamed("source", "ids")
    coded = bpe.encode(docs, registry.WORD_BPE)
    assert coded.columns == ["doc_id", "word", "n_chars", "ids"]
    texts = {r.decoded for r in bpe.decode(coded, registry.WORD_BPE).collect()}
    wanted = {model.decode(model.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for _, t, *_ in odd_rows()}
    assert texts == wanted


def test_decode_of_odd_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [320, None, -5, 10_000_000, 320])], "k int, ids array<int>")
    found = {r.k: r.decoded for r in bpe.decode(df, registry.WORD_BPE).collect()}
    piece = bpe.tokenizer(registry.WORD_BPE).id_to_token(320)
    assert found == {1: None, 2: "", 3: f"{piece} {piece}"}
    plan = bpe.decode(df, registry.WORD_BPE)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("head_words, length", [(1 << 20, 70), (0, 5)])
def test_repeated_rows_take_linear_work(spark, model, head_words, length):
    """Equal rows share one set of words from outside the head, however often they come."""
    text = " ".join(f"{i:0{length}d}x" for i in range(60))
    docs = spark.createDataFrame([(1, text)] * 4000, "doc_id long, text string").repartition(8)
    start = time.monotonic()
    rows = bpe.round_trip(docs, registry.WORD_BPE, head_words).groupBy("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").count().collect()
    assert time.monotonic() - start < 60
    ids = model.encode(text, add_special_tokens=False).ids
    assert [tuple(r) for r in rows] == [(1, len(ids), digest(" ".join(map(str, ids))), digest(model.decode(ids, skip_special_tokens=False)), 4000)]


def test_decoding_by_a_join_equals_decoding_in_the_task(spark):
    docs = odd_documents(spark)
    coded = bpe.encode(docs, registry.WORD_BPE, keep=["doc_id"], with_text=True).withColumnRenamed("decoded", "here")
    joined = bpe.decode(coded, registry.WORD_BPE)
    assert joined.count() == docs.count() and joined.where("NOT here <=> decoded").count() == 0


def test_empty_table(spark):
    assert bpe.round_trip(no_documents(spark), registry.WORD_BPE).count() == 0


def test_head_is_bounded(spark):
    words = spark.createDataFrame([(f"w{i}", i, [1]) for i in range(1, 200)] + [("y" * 100, 10**6, [2])], "word string, n long, ids array<int>")
    level = bpe.head_level(words, 30)
    head = words.where(bpe._is_head(level))
    assert 0 < head.count() <= 30
    assert head.where("length(word) > 64").count() == 0
