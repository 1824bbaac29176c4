import zlib
from collections import Counter, defaultdict

import pytest

from demandloom.llm import sharding
from tests.llm.helpers import SCHEMA, as_set, no_documents, odd_documents, odd_rows


def check(docs, shards):
    rows = docs.select("doc_id", "text").collect()
    found = sharding.assign(docs, shards).collect()
    wanted = [(r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in rows]
    assert as_set((r.doc_id, r["size"], r.text_crc32) for r in found) == as_set(wanted)
    counts = Counter(r.shard for r in found)
    assert set(counts) <= set(range(shards))
    assert max(counts.values()) - (min(counts.values()) if len(counts) == shards else 0) <= 1
    for shard, count in counts.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(count))
    assert {(r.law, r.grown_shard) for r in found} == {("rows", None)}
    spread = defaultdict(Counter)
    for r in found:
        spread[r.text_crc32][r.shard] += 1
    return spread, counts


def test_laws_on_odd_documents(spark):
    for shards in (1, 3, 40, 100):
        check(odd_documents(spark), shards)


def test_groups_stay_together_where_they_fit(spark):
    rows = [(i, f"text {i // 5 if i < 300 else i}", "en", "s", 1) for i in range(1000)]
    spread, _ = check(spark.createDataFrame(rows, SCHEMA), 10)
    cut = sum(len(shards) - 1 for shards in spread.values())
    assert cut <= 2


def test_a_group_larger_than_a_shard(spark):
    rows = [(i, "the same" if i < 400 else f"other {i}", "en", "s", 1) for i in range(1000)]
    spread, counts = check(spark.createDataFrame(rows, SCHEMA), 10)
    held = spread[zlib.crc32(b"the same")]
    assert sum(held.values()) == 400 and len(held) <= 6
    assert set(counts.values()) == {100}


def test_same_result_again(spark):
    docs = odd_documents(spark).dropDuplicates(["doc_id"])
    assert as_set(sharding.assign(docs).collect()) == as_set(sharding.assign(docs.repartition(7)).collect())


def test_empty_table(spark):
    assert sharding.assign(no_documents(spark)).count() == 0


@pytest.mark.parametrize("rows", [[(None, None)] * 5, [(1, "a")] * 9])
def test_repeated_and_null_rows(spark, rows):
    check(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    assert len(odd_rows()) > 0
