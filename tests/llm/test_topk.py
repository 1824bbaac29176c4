import math
import random

from demandloom.llm import registry, topk
from tests.checking import compare, duck
from tests.llm.helpers import SF_DIR, as_set

LARGEST = (1 << 63) - 1


def brute(rows, every, k):
    usable = [
        (n, [math.floor(256 * x) for x in v]) for n, v in rows
        if n is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for query, q in usable:
        if query % every:
            continue
        scored = [
            (-max(-LARGEST, min(LARGEST, sum(a * b for a, b in zip(q, c)))), n)
            for n, c in usable if n != query and len(c) == len(q)
        ]
        found += [(query, rank, n, -s) for rank, (s, n) in enumerate(sorted(scored)[:k], 1)]
    return found


def test_equals_sql(spark):
    assert compare(registry.top_vectors(spark, SF_DIR), duck(SF_DIR), topk.ORACLE) is None


def test_ties_nulls_lengths_and_huge_values(spark):
    draw = random.Random(1)
    rows = [(i, [draw.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(4)]) for i in range(120)]
    rows += [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(60)]  # one vector many times
    rows += [(10, [0.25] * 4), (77, [0.5] * 4), (77, [0.5] * 4)]  # repeated ids
    rows += [(300, None), (310, []), (320, [None, 1.0, 1.0, 1.0]), (330, [math.nan] * 4), (340, [math.inf, 0.0, 0.0, 0.0])]
    rows += [(None, [9.0] * 4), (400, [0.5]), (410, [0.75]), (420, [0.1, 0.2, 0.3])]
    rows += [(500, [1e17, -3e16, 2.0, 1e10]), (510, [1e150, 1.0, 1.0, 1.0]), (520, [-1e17, 1.0, 1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for k in (1, 5, 400):
        assert as_set(topk.search(table, 10, k).collect()) == as_set(brute(rows, 10, k))


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 11)
    monkeypatch.setattr(topk, "BIN_BITS", 3)
    draw = random.Random(2)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(6)]) for i in range(150)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert as_set(topk.search(table, 5, 4).collect()) == as_set(brute(rows, 5, 4))


def test_empty_table(spark):
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
