import re

import pytest
import xxhash

from demandloom.llm import simhash
from demandloom.llm.components import _large_star, _small_star, components
from demandloom.llm.simhash import _clustered
from demandloom.session import materialize
from tests.llm.helpers import SCHEMA, as_set, no_documents, odd_documents, odd_rows


def brute_fingerprint(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", small)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


@pytest.fixture(scope="module")
def expected():
    rows = odd_rows()
    prints = [brute_fingerprint(r[1]) for r in rows]
    groups = brute_groups(prints, 4)
    smallest = {}
    for group, row in zip(groups, rows):
        if row[0] is not None:
            smallest[group] = min(smallest.get(group, row[0]), row[0])
    return [(r[0], p, smallest.get(g)) for r, p, g in zip(rows, prints, groups)], len(set(groups))


# one tree per shard, and shards split into many trees
@pytest.mark.parametrize("tree_size", [4096, 1])
def test_components_equal_brute_force(spark, expected, tree_size):
    found = simhash.cluster(odd_documents(spark), tree_size=tree_size).collect()
    assert as_set((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in found) == as_set(expected[0])


def test_one_row_of_each_component_stays(spark, expected):
    docs = odd_documents(spark)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == expected[1]
    labels = {(d, p): c for d, p, c in expected[0]}
    assert all(r.doc_id == labels[(r.doc_id, brute_fingerprint(r.text))] for r in rows)


def test_links_of_random_near_fingerprints(spark):
    import random

    draw = random.Random(3)
    centres = [draw.getrandbits(64) for _ in range(30)]
    prints = sorted({c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 6))) for c in centres for _ in range(8)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), tree_size=3)
    found = {r.node: r.component for r in components(edges).collect()}
    groups = brute_groups(prints, 4)
    by_group = {}
    for group, value in zip(groups, signed):
        by_group.setdefault(group, set()).add(value)
    for members in by_group.values():
        assert {found.get(m, m) for m in members} == {min(members)}


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(40)] + [(7, 7), (500, 500), (300, 301), (301, 300)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    wanted = {i: 0 for i in range(61)} | {100: 100} | {200 + i: 100 for i in range(40)} | {500: 500, 300: 300, 301: 300}
    assert found == wanted


def test_empty_table_and_single_row(spark):
    assert simhash.cluster(no_documents(spark)).count() == 0
    one = spark.createDataFrame([(9, "a b c", "en", "s", 5)], SCHEMA)
    assert [r.component_id for r in simhash.cluster(one).collect()] == [9]
    assert simhash.drop_near_duplicates(no_documents(spark)).count() == 0


def _tables_read(df):
    """How often the plan of a query reads stored tables."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_plans_stay_small_for_the_driver(spark):
    """A round of star joins reads its edges four times, and labels come from fingerprints grouped once."""
    edges = materialize(spark.createDataFrame([(1, 2), (2, 3), (2, 3), (9, 3), (7, 8)], "u long, v long"), "edges")
    star = _small_star(_large_star(edges))
    assert _tables_read(star) <= 4
    assert {(r.u, r.v) for r in star.collect()} == {(2, 1), (3, 1), (9, 2), (8, 7)}
    prints = materialize(spark.createDataFrame([(1, 0), (2, 1), (3, -1), (4, -1)], "doc_id long, fp long"), "prints")
    found = _clustered(prints, 4)
    assert _tables_read(found) <= 3
    assert sorted((r.doc_id, r.root, r.component_id) for r in found.collect()) == [(1, 0, 1), (2, 0, 1), (3, -1, 3), (4, -1, 3)]
