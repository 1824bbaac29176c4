"""Boosting with an L2 term against a plain numpy version that grows the same trees row by row."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import boosting
from demandloom.operators.boosting import BoostConfig

CONFIG = BoostConfig(rounds=6, depth=4, rate=0.3, l2=1.5, least_rows=2, bins=16)


def rows(n=400, seed=3):
    draw = np.random.default_rng(seed)
    a, b = draw.integers(0, 12, n).astype(float), draw.normal(size=n)
    c = draw.integers(0, 3, n)
    y = np.round(3 * a + 10 * (b > 0.3) * c + draw.normal(size=n))
    return [(i, float(a[i]), float(b[i]), int(c[i]), 5.0, 2 * float(a[i]), float(y[i])) for i in range(n)]


FEATURES = ["a", "b", "c", "constant", "twice_a"]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), "k int, a double, b double, c int, constant double, twice_a double, y double")


def plain_boosting(x, y, edges, cfg):
    """Predictions of the rows by trees that are grown with Python loops."""
    bins = np.array([[sum(e <= v for e in edge) for v, edge in zip(row, edges)] for row in x])
    base = y.mean()
    reach = max(y.max() - base, base - y.min())
    unit = 2.0 ** (math.ceil(math.log2(reach)) - cfg.gradient_bits)
    scores = np.full(len(y), base)

    def worth(g, h):
        return (g * unit) ** 2 / (h + cfg.l2)

    def grow(members, gradients, depth):
        g, h = int(gradients[members].sum()), len(members)
        best = None
        if depth < cfg.depth:
            for f in range(bins.shape[1]):
                for cut in range(len(edges[f])):
                    left = members[bins[members, f] <= cut]
                    gl, hl = int(gradients[left].sum()), len(left)
                    gain = worth(gl, hl) + worth(g - gl, h - hl) - worth(g, h)
                    if hl >= cfg.least_rows and h - hl >= cfg.least_rows and gain > cfg.least_gain and (best is None or gain > best[0]):
                        best = (gain, f, cut)
        if best is None:
            scores[members] += cfg.rate * (-(g * unit) / (h + cfg.l2))
            return
        goes_left = bins[members, best[1]] <= best[2]
        grow(members[goes_left], gradients, depth + 1)
        grow(members[~goes_left], gradients, depth + 1)

    for _ in range(cfg.rounds):
        gradients = np.rint((scores - y) / unit).astype(np.int64)
        grow(np.arange(len(y)), gradients, 0)
    return scores


def test_equals_plain_version(spark, table):
    model = boosting.fit(table, FEATURES, CONFIG, "y")
    found = {r.k: r.p for r in boosting.predict(model, table, "p").select("k", "p").collect()}
    data = rows()
    x, y = np.array([r[1:6] for r in data]), np.array([r[6] for r in data])
    wanted = plain_boosting(x, y, model.edges, CONFIG)
    assert max(abs(found[i] - wanted[i]) for i in range(len(data))) < 1e-6
    assert np.mean((wanted - y) ** 2) < 0.2 * y.var()


def test_edges_are_quantiles(spark, table):
    edges = dict(zip(FEATURES, boosting.quantile_edges(table, FEATURES, 16), strict=True))
    values = sorted(r[2] for r in rows())
    ranks = [math.ceil(len(values) * i / 16) - 1 for i in range(1, 16)]
    assert edges["b"] == [values[r] for r in ranks]
    assert edges["constant"] == [5.0] and edges["a"] == sorted(set(edges["a"]))


def test_trees_do_not_depend_on_the_partitioning(table):
    one, other = (boosting.fit(table.repartition(n), FEATURES, CONFIG, "y") for n in (1, 7))
    assert [(t.feature, t.bin, t.value) for t in one.trees] == [(t.feature, t.bin, t.value) for t in other.trees]


def test_l2_shrinks_the_leaves(spark):
    df = spark.createDataFrame([(float(i % 2), 10.0 * (i % 2)) for i in range(8)], "a double, y double")
    leaves = {}
    for l2 in (0.0, 4.0):
        model = boosting.fit(df, ["a"], BoostConfig(rounds=1, depth=1, rate=1.0, l2=l2, bins=4), "y")
        leaves[l2] = sorted({r.p for r in boosting.predict(model, df, "p").collect()})
    assert leaves == {0.0: [0.0, 10.0], 4.0: [2.5, 7.5]}


def test_constant_target_and_no_rows(spark):
    df = spark.createDataFrame([(float(i), 3.0) for i in range(5)], "a double, y double")
    model = boosting.fit(df, ["a"], CONFIG, "y")
    assert {r.p for r in boosting.predict(model, df, "p").collect()} == {3.0}
    with pytest.raises(ValueError, match="no row"):
        boosting.fit(df.where(F.lit(False)), ["a"], CONFIG, "y")


def test_one_aggregation_a_level(table):
    """A level's plan reads the rows once and shuffles sums only."""
    state = boosting.with_bins(table, FEATURES, boosting.quantile_edges(table, FEATURES, 16), "bins")
    plan = state.select("bins")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_saved_trees_predict_the_same(spark, table, tmp_path):
    model = boosting.fit(table, FEATURES, CONFIG, "y")
    boosting.save(spark, model, str(tmp_path / "trees"))
    again = boosting.load(spark, str(tmp_path / "trees"))
    both = boosting.predict(again, boosting.predict(model, table, "p"), "q")
    assert both.where("p <> q").count() == 0 and both.columns == [*table.columns, "p", "q"]
