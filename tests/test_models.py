import os

import pytest
from pyspark.sql import functions as F

from demandloom.config import DEFAULT_CONFIG, KEYS
from demandloom.operators import models
from demandloom.operators.final import constant_columns, drop_constant_columns
from demandloom.plans import features, training
from demandloom.session import materialize
from demandloom.sources import files, views

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    return materialize(features.build_features(views.source_views(spark, SF_DIR), drop_constants=False), "features")


def test_feature_table_is_complete_and_clean(spark, table):
    assert len(table.columns) == 174
    assert len(models.feature_names(table)) == 170
    bad = [F.count_if(F.col(c).isNull()) for c in table.columns]
    bad += [
        F.count_if(F.isnan(c) | (F.abs(c) == float("inf"))) for c, t in table.dtypes if t == "double"
    ]
    assert sum(table.agg(*bad).first()) == 0
    sums = table.agg(
        F.max(F.abs(sum(F.col(f"review_pct_{k}_mean") for k in range(1, 6)) - F.col("review_count_sum") / F.col("demand"))),
        F.max(sum(F.col(f"is_quarter_{k}") for k in range(1, 5))),
    ).first()
    assert sums[0] < 1e-9 and sums[1] == 1


def test_demand_adds_up_to_the_items(spark):
    sources = views.source_views(spark, SF_DIR)
    clean = features.clean_all(sources)
    items = features.build_item_grain(clean).count()
    assert features.monthly_table(sources).agg(F.sum("demand")).first()[0] == items


def test_constant_columns_are_dropped(spark):
    df = spark.createDataFrame([("a", 1, 2.0, 0.0), ("b", 1, 3.0, 0.0)], "k string, one int, x double, zero double")
    assert {r["column_name"] for r in constant_columns(df).collect()} == {"one", "zero"}
    assert drop_constant_columns(df).columns == ["k", "x"]


def test_training_saves_models_and_reports_failures(spark, table, tmp_path, monkeypatch):
    real = models.regressors

    def with_broken(cfg=DEFAULT_CONFIG):
        return {**real(cfg), "broken": real(cfg)["linear_regression"].copy({}).setMaxIter(0).setLabelCol("absent")}

    monkeypatch.setattr(models, "regressors", with_broken)
    root = str(tmp_path / "models")
    trained = training.train_and_save(table, root, names=("linear_regression", "broken"))
    rows = {r["model"]: r for r in trained.metrics.collect()}
    assert set(rows) == {"naive_last_value", "naive_historical_mean", "naive_by_category", "linear_regression", "broken"}
    assert rows["broken"]["status"] == "failed" and rows["broken"]["mae"] is None and "absent" in rows["broken"]["error"]
    assert all(r["mae"] >= 0 for n, r in rows.items() if n != "broken")
    assert trained.best(trained_only=True).first()["model"] == "linear_regression"
    saved = sorted(os.listdir(root))
    assert saved[-1].startswith("model_linear_regression_") and "model_latest" in saved and len(saved) == 2
    loaded = files.latest_model(spark, root)
    again = models.predict(loaded, table, "p").agg(F.count("p")).first()[0]
    assert again == table.count()


def test_forest_does_not_depend_on_the_partitioning(table):
    def predictions(partitions):
        model = models.fit(table.repartition(partitions), "random_forest")
        rows = models.predict(model, table, "p").select(*KEYS, "p").collect()
        return sorted(map(tuple, rows))

    assert predictions(2) == predictions(8)


def test_trees_find_an_interaction_that_a_linear_model_cannot(spark):
    rows = [
        (f"2020-{1 + i % 12:02d}", f"c{i // 12:02d}", a, b, 10.0 * ((a > 4) != (b > 4)) + 0.1 * a)
        for i, (a, b) in enumerate((a, b) for _ in range(4) for a in range(10) for b in range(10))
    ]
    table = materialize(
        spark.createDataFrame(rows, "order_month string, product_category_name string, a int, b int, demand_next_month double"), "fixed"
    )
    held = (F.col("a") * 7 + F.col("b") * 3) % 10 == 2
    errors = {}
    for name in ("linear_regression", "random_forest", "gradient_boosting"):
        found = models.predict(models.fit(table.where(~held), name), table.where(held), "p")
        errors[name] = found.agg(F.avg(F.pow(F.col("demand_next_month") - F.col("p"), 2))).first()[0]
    assert errors["random_forest"] < 0.5 * errors["linear_regression"], errors
    assert errors["gradient_boosting"] < 0.5 * errors["linear_regression"], errors


def test_latest_model_survives_until_the_next_is_complete(spark, table, tmp_path):
    root = str(tmp_path / "models")
    first = training.train_and_save(table, root, names=("linear_regression",))
    want = models.predict(first.models["linear_regression"], table, "p").agg(F.sum("p")).first()[0]
    files.save_models(spark, first.models, "not_trained", root)
    assert models.predict(files.latest_model(spark, root), table, "p").agg(F.sum("p")).first()[0] == want


def test_predictions_cover_exactly_the_test_rows(table):
    trained = models.train_from_table(table, ("linear_regression",))
    per_model = {r["model"]: r["count"] for r in trained.predictions.groupBy("model").count().collect()}
    n = table.count()
    assert set(per_model.values()) == {n - int(n * 0.8)}


def test_retraining_appends_and_trains(spark, table, tmp_path):
    new = training.append_months(table.limit(0), features_of_next_month(table))
    trained = training.retrain(
        spark, table, new, str(tmp_path / "tables"), str(tmp_path / "models"), names=("linear_regression",)
    )
    stored = files.read_snapshot(spark, str(tmp_path / "tables"))
    assert stored.count() == table.count() + new.count()
    order = stored.select("product_category_name", "date").collect()
    assert order == sorted(order)
    assert trained.metrics.count() == 4


def features_of_next_month(table):
    from demandloom.operators.update import next_month_rows

    return next_month_rows(table)


def test_recompute_labels_the_former_last_month(spark):
    monthly = features.monthly_table(views.source_views(spark, SF_DIR))
    monthly = materialize(monthly, "monthly")
    from demandloom.operators.update import next_month_rows

    before = features.final_clean(features.features_from_monthly(monthly))
    after = training.updated_features(monthly, next_month_rows(monthly))
    categories = monthly.select("product_category_name").distinct().count()
    assert after.count() == before.count() + categories


def test_boosting_with_an_l2_term_trains_and_loads_as_the_others(spark, table, tmp_path, monkeypatch):
    from demandloom.operators import boosting

    real = boosting.fit
    small = boosting.BoostConfig(rounds=3, depth=3)
    monkeypatch.setattr(boosting, "fit", lambda train, names, cfg=small, target="demand_next_month": real(train, names, small, target))
    root = str(tmp_path / "models")
    trained = training.train_and_save(table, root, names=(models.BOOSTED,))
    assert trained.best(trained_only=True).first()["model"] == models.BOOSTED
    loaded = files.latest_model(spark, root)
    want = models.predict(trained.models[models.BOOSTED], table, "p").agg(F.sum("p")).first()[0]
    assert models.predict(loaded, table, "p").agg(F.sum("p")).first()[0] == want
