import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from demandloom.llm import idcoder, registry, token_files
from demandloom.session import scratch_path
from tests.llm.helpers import no_documents, odd_documents, odd_rows


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(registry.BYTE_BPE)


def ids_of(model, text):
    return model.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("block_ids", [1 << 21, 500])
def test_files_give_back_all_ids(spark, model, block_ids):
    folder = scratch_path(spark, "files")
    token_files.write(odd_documents(spark), folder, registry.BYTE_BPE, block_ids=block_ids)
    found = token_files.read(spark, folder, digest=True).orderBy("start").collect()
    rows = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in found] == [r[0] for r in rows]
    start = 0
    for r in found:
        assert r.start == start and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    key = lambda pair: (repr(pair[0]), pair[1])
    assert sorted(((r.doc_id, list(r.ids)) for r in found), key=key) == sorted(((r[0], ids_of(model, r[1])) for r in rows), key=key)


def test_pieces_do_not_change_the_ids(model):
    draw = random.Random(4)
    parts = ["foo", " bar", "\n", "  ", "\t", "don't", "'s", "12", ".", ",", "é", "ß.", "日本", "　", " ", " ", "<|endoftext|>", "\U0001f600", "x.", " ", "A,", "\x1c", "\r\n"]
    coder = token_files._Remembering(registry.BYTE_BPE)
    import pyarrow as pa

    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(3000)]
    for first in range(0, len(texts), 100):
        some = texts[first : first + 100]
        ids, sizes = coder.encode(pa.array([*some, None, ""], pa.string()))
        wanted = [model.encode(t, add_special_tokens=False).ids for t in some]
        assert sizes.tolist() == [*map(len, wanted), 0, 0]
        assert ids.tolist() == [i for w in wanted for i in w]


def test_coder_round_trips():
    draw = np.random.default_rng(0)
    cases = [np.zeros(0, int), np.array([0]), np.array([2**30]) % 70000, np.full(5000, 7), draw.integers(0, 50257, 9000)]
    cases += [np.minimum(draw.zipf(1.3, 200_000), 50256), np.tile(draw.integers(0, 300, 97), 800), np.arange(50_000)]
    for ids in cases:
        block = idcoder.encode_block(ids)
        assert (idcoder.decode_block(block) == ids).all()
    skewed = np.minimum(draw.zipf(1.5, 300_000), 50256)
    assert len(idcoder.encode_block(skewed)) < 1.3 * len(skewed)


def test_ids_out_of_bounds_are_refused():
    largest = np.array([idcoder.MOST_IDS - 1, 0, 5] * 400)
    assert (idcoder.decode_block(idcoder.encode_block(largest)) == largest).all()
    for ids in ([idcoder.MOST_IDS], [-1, 3]):
        with pytest.raises(ValueError):
            idcoder.encode_block(np.array(ids))


def test_damage_is_found():
    block = bytearray(idcoder.encode_block(np.arange(1000)))
    block[len(block) // 2] ^= 1
    with pytest.raises(ValueError):
        idcoder.decode_block(bytes(block))


def test_empty_table(spark):
    folder = scratch_path(spark, "files")
    token_files.write(no_documents(spark), folder, registry.BYTE_BPE)
    assert token_files.read(spark, folder).count() == 0


def test_a_batch_is_looked_up_at_once_and_cut_into_blocks(monkeypatch):
    """Blocks are cut after about 4 MB of text as before, however much text is looked up together."""
    import pyarrow as pa
    from pyspark import TaskContext

    monkeypatch.setattr(TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 3})())
    calls, encode = [], token_files._Remembering.encode
    monkeypatch.setattr(token_files._Remembering, "encode", lambda self, texts: calls.append(len(texts)) or encode(self, texts))
    texts = ["some words of a text " * 10_000, None, "", "a b c"] * 60
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    blocks = list(token_files._blocks(registry.BYTE_BPE, 2, 60_000)(iter([batch])))
    assert calls == [len(texts)]  # about 13 MB
    assert [i for b in blocks for i in b.column("doc_ids")[0].as_py()] == list(range(len(texts)))
    for b in blocks:
        ids, sizes = idcoder.decode_block(b.column("payload")[0].as_py()), b.column("lengths")[0].as_py()
        assert len(ids) == sum(sizes) == b.column("n_ids")[0].as_py()
        assert all(ids[np.cumsum(sizes) - 1] == 2)
        assert b is blocks[-1] or 60_000 <= len(ids) < 1_500_000
    assert [b.column("block")[0].as_py() for b in blocks] == list(range(len(blocks))) and len(blocks) == 4


def test_decoding_knows_the_id_at_each_place():
    made = idcoder._Model(300)
    made.pending = [np.arange(0, 300, 7)] * 5
    made._sum()
    ends = np.concatenate([[0], np.cumsum(made.weight.astype(np.int64))])
    places = np.arange(1 << made.bits)
    assert (made.symbols() == np.searchsorted(ends, places, side="right") - 1).all()
    assert ends[-1] == 1 << made.bits and (made.below.astype(np.int64) == ends).all()
