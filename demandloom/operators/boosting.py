"""Gradient boosting of regression trees with an L2 term on the leaves.

Squared error, second order: with the sum G of the gradients and the number H of
the rows of a node, a leaf is worth ``-G / (H + l2)``, and a split gains
``GL² / (HL + l2) + GR² / (HR + l2) - G² / (H + l2)``. Features are cut into bins at
approximate quantiles, and one aggregation by (node, feature, bin) a level finds
the splits of all its nodes. Gradients are summed as whole numbers, so the trees
do not depend on how the rows are partitioned.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.config import TARGET
from demandloom.session import materialize


@dataclass(frozen=True)
class BoostConfig:
    # Number, depth and learning rate of the trees, weight of the L2 term, least rows of a leaf.
    rounds: int = 50
    depth: int = 8
    rate: float = 0.1
    l2: float = 1.0
    least_rows: int = 1
    least_gain: float = 1e-6
    bins: int = 64
    #: Bits of a gradient as a whole number; 2 ** (62 - bits) rows can be summed.
    gradient_bits: int = 30


@dataclass
class Tree:
    """Nodes by number: the root is 1, the children of n are 2n and 2n + 1. ``feature`` -1 marks a leaf."""

    feature: list[int]
    bin: list[int]
    value: list[float]


@dataclass
class BoostedTrees:
    features: list[str]
    edges: list[list[float]]
    base: float
    config: BoostConfig
    trees: list[Tree] = field(default_factory=list)


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """For each feature its distinct approximate quantiles, from one aggregation of mergeable sketches."""
    shares = ", ".join(repr(i / bins) for i in range(1, bins))
    found = df.agg(*[F.expr(f"percentile_approx(cast(`{c}` AS double), array({shares}), 10000)") for c in features]).first()
    return [sorted(set(values or [])) for values in found]


def with_bins(df: DataFrame, features: Sequence[str], edges: Sequence[Sequence[float]], name: str) -> DataFrame:
    """Add ``name``: for each feature how many of its edges are not above the value."""
    inside = [f"{name}_{i}" for i in range(len(features))]
    cut = Bucketizer(
        splitsArray=[[-math.inf, *e, math.inf] if e else [-math.inf, 0.0, math.inf] for e in edges],
        inputCols=[f"{c}_in" for c in inside],
        outputCols=inside,
        handleInvalid="error",
    )
    doubles = df.withColumns({f"{c}_in": F.col(f).cast("double") for c, f in zip(inside, features, strict=True)})
    numbers = [F.col(c).cast("int") if e else F.lit(0) for c, e in zip(inside, edges, strict=True)]
    return cut.transform(doubles).select(*df.columns, F.array(*numbers).alias(name))


def _numbers(values: Sequence) -> Column:
    """Whole numbers or doubles as one literal array."""
    shown = [f"{v!r}D" if isinstance(v, float) else repr(v) for v in values]
    return F.expr(f"array({', '.join(shown)})")


def _node(bins: Column, feature: Column, cut: Column, levels: int) -> Column:
    """Number of the node that a row reaches after so many levels."""
    if levels == 0:
        return F.lit(1)

    def step(node: Column, _: Column) -> Column:
        right = F.get(bins, F.get(feature, node)) > F.get(cut, node)
        return F.when(F.get(feature, node) < 0, node).otherwise(2 * node + right.cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(1), step)


@dataclass
class Split:
    """A node's sums, and its best cut with the sums on its left; no cut if nothing is gained."""

    node: int
    g: int
    h: int
    feature: int | None = None
    bin: int = 0
    gl: int = 0
    hl: int = 0


def _best_splits(state: DataFrame, tree: Tree, level: int, cfg: BoostConfig, unit: float, shape: tuple[int, int]) -> list[Split]:
    """The sums and the best cut of every open node of a level, from one aggregation of the rows.

    The driver gets a sum for each (node, feature, bin), which is bounded by the settings, whatever the number of rows.
    """
    node = _node(F.col("bins"), _numbers(tree.feature), _numbers(tree.bin), level)
    open_nodes = [n for n in range(2**level, 2 ** (level + 1)) if tree.feature[n] == -2]
    at = state.select(node.alias("node"), "gradient", "bins").where(F.col("node").isin(open_nodes))
    cells = at.select("node", "gradient", F.posexplode("bins").alias("feature", "bin"))
    sums = cells.groupBy("node", "feature", "bin").agg(F.sum("gradient").alias("g"), F.count(F.lit(1)).alias("h")).toArrow()
    nodes, features, bins, g, h = (sums.column(i).to_numpy() for i in range(5))
    cell = (np.searchsorted(open_nodes, nodes), features, bins)
    gradients, rows = np.zeros((len(open_nodes), *shape), np.int64), np.zeros((len(open_nodes), *shape), np.int64)
    gradients[cell], rows[cell] = g, h
    gl, hl = gradients.cumsum(axis=2), rows.cumsum(axis=2)
    whole_g, whole_h = gl[:, :1, -1:], hl[:, :1, -1:]

    def worth(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return np.square(g * unit) / (h + cfg.l2)

    with np.errstate(divide="ignore", invalid="ignore"):  # sides without rows are not allowed below
        gain = worth(gl, hl) + worth(whole_g - gl, whole_h - hl) - worth(whole_g, whole_h)
    allowed = (hl >= max(1, cfg.least_rows)) & (whole_h - hl >= max(1, cfg.least_rows)) & (gain > cfg.least_gain)
    # of equal gains the first feature and bin
    flat = np.where(allowed, gain, -np.inf).reshape(len(open_nodes), -1)
    best = flat.argmax(axis=1)
    found = []
    for i, n in enumerate(open_nodes):
        split = Split(n, int(whole_g[i, 0, 0]), int(whole_h[i, 0, 0]))
        if np.isfinite(flat[i, best[i]]):
            split.feature, split.bin = divmod(int(best[i]), shape[1])
            split.gl, split.hl = int(gl[i, split.feature, split.bin]), int(hl[i, split.feature, split.bin])
        found.append(split)
    return found


def _grow(state: DataFrame, cfg: BoostConfig, unit: float, shape: tuple[int, int]) -> Tree:
    """One tree, level by level."""
    size = 2 ** (cfg.depth + 1)
    tree = Tree([-2] * size, [0] * size, [0.0] * size)  # -2: not decided yet

    def leaf(node: int, g: int, h: int) -> None:
        tree.feature[node], tree.value[node] = -1, -(g * unit) / (h + cfg.l2)

    for level in range(cfg.depth):
        found = _best_splits(state, tree, level, cfg, unit, shape)
        for split in found:
            if split.feature is None:
                leaf(split.node, split.g, split.h)
                continue
            tree.feature[split.node], tree.bin[split.node] = split.feature, split.bin
            if level + 1 == cfg.depth:
                leaf(2 * split.node, split.gl, split.hl)
                leaf(2 * split.node + 1, split.g - split.gl, split.h - split.hl)
        for node in range(2 ** (level + 1), 2 ** (level + 2)):
            if tree.feature[node // 2] < 0 and tree.feature[node] == -2:
                tree.feature[node] = -1  # below a leaf, never reached
        if all(split.feature is None for split in found):
            break
    return tree


def fit(train: DataFrame, features: Sequence[str], cfg: BoostConfig = BoostConfig(), target: str = TARGET) -> BoostedTrees:
    """Boosted trees on the rows with a target; feature values have to be numbers (no null, NaN or infinity).

    The rows are stored with their bins and present score once a tree. Nothing
    that grows with the rows reaches the driver: it holds the sums of one level, at most
    ``2 ** (depth - 1)`` times the features times the bins.
    """
    rows = train.where(F.col(target).isNotNull())
    base, low, high = rows.agg(*[f(F.col(target).cast("double")) for f in (F.avg, F.min, F.max)]).first()
    if base is None:
        raise ValueError(f"no row with {target}")
    edges = quantile_edges(rows, features, cfg.bins)
    model = BoostedTrees(list(features), edges, base, cfg)
    shape = len(features), max(len(e) for e in edges) + 1
    # residuals shrink from the largest distance to the mean
    reach = max(high - base, base - low)
    unit = 2.0 ** (math.ceil(math.log2(reach)) - cfg.gradient_bits) if reach > 0 else 1.0
    binned = with_bins(rows.select(target, *features), features, edges, "bins")
    state = materialize(binned.select(F.col(target).cast("double").alias("y"), F.lit(base).alias("score"), "bins"), "boosting")
    for _ in range(cfg.rounds):
        gradient = F.rint((F.col("score") - F.col("y")) / unit).cast("long")
        tree = _grow(state.withColumn("gradient", gradient), cfg, unit, shape)
        model.trees.append(tree)
        if len(model.trees) < cfg.rounds:
            moved = F.col("score") + cfg.rate * _leaf(F.col("bins"), tree, cfg)
            state = materialize(state.select("y", moved.alias("score"), "bins"), "boosting")
    return model


def _leaf(bins: Column, tree: Tree, cfg: BoostConfig) -> Column:
    node = _node(bins, _numbers(tree.feature), _numbers(tree.bin), cfg.depth)
    return F.get(_numbers(tree.value), node)


def predict(model: BoostedTrees, df: DataFrame, name: str) -> DataFrame:
    """Add ``name``: the base and the learning rate times the leaves of all trees, in their order."""
    cfg = model.config
    listed = json.dumps([{"feature": t.feature, "bin": t.bin, "value": t.value} for t in model.trees])
    trees = F.from_json(F.lit(listed), "array<struct<feature: array<int>, bin: array<int>, value: array<double>>>")
    helper = f"_{name}_bins"

    def add(score: Column, tree: Column) -> Column:
        node = _node(F.col(helper), tree["feature"], tree["bin"], cfg.depth)
        return score + cfg.rate * F.get(tree["value"], node)

    binned = with_bins(df, model.features, model.edges, helper)
    return binned.withColumn(name, F.aggregate(trees, F.lit(float(model.base)), add)).drop(helper)


def save(spark: SparkSession, model: BoostedTrees, path: str) -> None:
    """The trees as a table, one row a tree, and one row for what they share."""
    cfg = model.config
    shared = [(model.features, model.edges, float(model.base), json.dumps(asdict(cfg)))]
    spark.createDataFrame(shared, "features array<string>, edges array<array<double>>, base double, config string").coalesce(
        1
    ).write.parquet(f"{path}/shared")
    rows = [(i, t.feature, t.bin, t.value) for i, t in enumerate(model.trees)]
    spark.createDataFrame(rows, "number int, feature array<int>, bin array<int>, value array<double>").write.parquet(f"{path}/trees")


def load(spark: SparkSession, path: str) -> BoostedTrees:
    shared = spark.read.parquet(f"{path}/shared").first()
    trees = spark.read.parquet(f"{path}/trees").orderBy("number").collect()
    model = BoostedTrees(list(shared["features"]), [list(e) for e in shared["edges"]], shared["base"], BoostConfig(**json.loads(shared["config"])))
    model.trees = [Tree(list(t["feature"]), list(t["bin"]), list(t["value"])) for t in trees]
    return model
