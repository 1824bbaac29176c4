import re

from demandloom.llm import mixing, registry
from tests.checking import compare, duck
from tests.llm.helpers import SCHEMA, SF_DIR, no_documents, odd_documents, odd_rows


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight, stop what is above its cap, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(stopped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return stopped | share
        stopped |= {s: most * sizes[s] for s in above}


def test_equals_sql(spark):
    assert compare(registry.mix_sources(spark, SF_DIR), duck(SF_DIR), mixing.ORACLE) is None


def check(rows, docs):
    sizes = {}
    for row in rows:
        sizes[row[3]] = sizes.get(row[3], 0) + size(row[1])
    targets = brute_targets(sizes)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    taken = {}
    for r in found:
        assert r["size"] == size(r.text) and r.source_size == sizes[r.source]
        assert abs(r.target - targets[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(taken[s] == int(targets[s] + 1e-9) for s in sizes)


def test_budgets_are_met_exactly(spark):
    check(odd_rows(), odd_documents(spark))


def test_capped_sources(spark):
    rows = [(i, "w " * n, "en", s, 1) for i, (s, n) in enumerate([("a", 2), ("b", 500), ("c", 300), ("c", 1), (None, 7), ("d", 3)])]
    check(rows, spark.createDataFrame(rows, SCHEMA))


def test_repeated_readings_add_up(spark):
    docs = odd_documents(spark)
    mixed = mixing.mix(docs)
    read = mixing.repeat_taken(mixed, docs.columns)
    assert read.columns == docs.columns
    assert sum(size(r.text) for r in read.collect()) == sum(r.taken for r in mixed.collect())


def test_no_rows_and_no_words(spark):
    assert mixing.mix(no_documents(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "en", "a", 0), (2, " ", "en", "b", 0)], SCHEMA)
    assert [(r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0.0, 0), (0.0, 0)]
    assert mixing.repeat_taken(mixing.mix(blank), blank.columns).count() == 0


def test_clashing_columns_are_overwritten(spark):
    docs = odd_documents(spark).withColumnRenamed("lang", "size").withColumnRenamed("n_chars", "taken")
    assert set(mixing.mix(docs).columns) == {"doc_id", "text", "source", "size", "source_size", "target", "budget", "taken"}
