"""Regression models on the feature table, fitted by Spark ML."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.config import CATEGORY, DEFAULT_CONFIG, KEYS, NON_FEATURES, TARGET, FeatureConfig
from demandloom.functions.scalar import numeric_columns
from demandloom.functions.tables import zero_unusable
from demandloom.operators import boosting
from demandloom.operators.metrics import best_model, model_metrics, stack_predictions
from demandloom.operators.naive import NAIVE_MODELS, predict_all
from demandloom.operators.split import positional_split, test_part, train_part
from demandloom.session import materialize

HELPERS = ("split", "position")


def feature_names(df: DataFrame) -> list[str]:
    """Numeric columns that are neither key, date, target nor split helper."""
    return [c for c in numeric_columns(df) if c not in NON_FEATURES and c not in HELPERS]


def regressors(cfg: FeatureConfig = DEFAULT_CONFIG) -> dict:
    common = {"featuresCol": "features", "labelCol": TARGET, "predictionCol": "prediction"}
    # Model sizes, depths and learning rate.
    return {
        "random_forest": RandomForestRegressor(
            numTrees=50, maxDepth=10, seed=cfg.seed, featureSubsetStrategy="all", maxBins=256, **common
        ),
        "linear_regression": LinearRegression(**common),
        "gradient_boosting": GBTRegressor(maxIter=50, maxDepth=8, stepSize=0.1, seed=cfg.seed, **common),
    }


#: Boosting with an L2 term, which Spark ML's regressor does not have.
BOOSTED = "gradient_boosting_l2"


def fit(train: DataFrame, name: str, cfg: FeatureConfig = DEFAULT_CONFIG) -> PipelineModel | boosting.BoostedTrees:
    """Fit one model. Rows are dealt by category and sorted first, so that a forest's samples follow from the rows alone."""
    if name == BOOSTED:
        return boosting.fit(train, feature_names(train))
    train = train.repartition(CATEGORY).sortWithinPartitions(*KEYS)
    assembler = VectorAssembler(inputCols=feature_names(train), outputCol="features")
    return Pipeline(stages=[assembler, regressors(cfg)[name]]).fit(train)


def predict(model: PipelineModel | boosting.BoostedTrees, df: DataFrame, name: str) -> DataFrame:
    if isinstance(model, boosting.BoostedTrees):
        return boosting.predict(model, df, name)
    return model.transform(df).drop("features").withColumnRenamed("prediction", name)


@dataclass
class Training:
    """Fitted models, their metrics on the held-out rows, and the stacked predictions."""

    models: dict[str, PipelineModel | boosting.BoostedTrees]
    metrics: DataFrame
    predictions: DataFrame
    failures: dict[str, str] = field(default_factory=dict)

    def best(self, trained_only: bool = False) -> DataFrame:
        return best_model(self.metrics, trained_only)


def train_from_table(
    features: DataFrame,
    names: tuple[str, ...] = ("random_forest", "linear_regression", "gradient_boosting"),
    cfg: FeatureConfig = DEFAULT_CONFIG,
    order_by: tuple[str, ...] = KEYS,
) -> Training:
    """Fit the naive and the named models on the first rows, score them on the rest.

    The table is written to shared storage before it is numbered and again
    after, since the split and every fit read it several times. A model that fails
    keeps its place in the metrics with NULL values, status ``failed`` and the
    reason in ``error``.
    """
    table = materialize(zero_unusable(features), "features")
    split = materialize(positional_split(table, cfg, order_by), "split")
    train, test = train_part(split), test_part(split)
    predicted = predict_all(test, train, NAIVE_MODELS, order_by)
    scored = list(NAIVE_MODELS)
    models: dict[str, PipelineModel | boosting.BoostedTrees] = {}
    failures: dict[str, str] = {}
    for name in names:
        try:
            model = fit(train, name, cfg)
        except Exception as problem:  # one bad model must not stop the others
            failures[name] = str(problem)
            continue
        models[name] = model
        predicted = predict(model, predicted, name)
        scored.append(name)
    stacked = stack_predictions(predicted, scored)
    metrics = model_metrics(stacked).withColumns({"status": F.lit("ok"), "error": F.lit(None).cast("string")})
    if failures:
        rows = [(name, None, None, None, "failed", reason) for name, reason in failures.items()]
        metrics = metrics.unionByName(features.sparkSession.createDataFrame(rows, metrics.schema))
    return Training(models, metrics, stacked, failures)
