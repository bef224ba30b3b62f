"""The registry of models, and ensembles as node tables."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from roadpulse.operators import forest_nodes, model_store, models

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(8)
    data = []
    for i in range(600):
        a, b, c = draw.randrange(10), draw.random(), float(draw.randrange(2))
        data.append((i, a, b, c, 5.0 * a + 3 * b * c + draw.random(), float(a > 4) if draw.random() < 0.9 else 0.0))
    return spark.createDataFrame(data, "key long, a int, b double, c double, y double, label double")


def fitted(rows, stage):
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), stage]).fit(rows)


def test_a_model_is_fitted_once_and_found_by_others(spark, rows, tmp_path):
    registry, fits = str(tmp_path / "registry"), []

    def fit():
        fits.append(1)
        return fitted(rows, GBTRegressor(labelCol="y", maxIter=3, maxDepth=2))

    assert model_store.newest(spark, registry, "m", "x") is None and model_store.table(spark, registry).collect() == []
    first, entry = model_store.fit_once(spark, registry, "m", "x", fit, {"depth": 2})
    # Another session knows the registry's folder only.
    again, found = model_store.fit_once(spark.newSession(), registry, "m", "x", fit)
    assert len(fits) == 1 and found == entry and entry["version"] == 1 and entry["params"] == {"depth": "2"}
    a, b = (m.transform(rows).agg(F.sum("prediction")).first()[0] for m in (first, again))
    assert a == b
    # Other data and a new publication are other versions; the newest one for the data counts.
    assert model_store.fit_once(spark, registry, "m", "other", fit)[1]["version"] == 2
    newer = model_store.publish(spark, registry, "m", first, "x")
    assert newer["version"] == 3 and model_store.newest(spark, registry, "m", "x")["run"] == newer["run"]
    assert sorted(r.version for r in model_store.table(spark, registry).collect()) == [1, 2, 3]


def test_a_taken_name_is_never_overwritten(spark, tmp_path):
    registry = str(tmp_path / "registry")
    assert model_store._put(spark, registry, "m-00000001.json", '{"model": "m", "version": 1}\n')
    assert not model_store._put(spark, registry, "m-00000001.json", '{"model": "m", "version": 9}\n')
    assert [r.version for r in model_store.table(spark, registry).collect()] == [1]


def test_fingerprints_follow_the_files(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    one = model_store.fingerprint(spark, str(tmp_path), "m")
    assert one == model_store.fingerprint(spark, str(tmp_path), "m") != model_store.fingerprint(spark, str(tmp_path), "n")
    spark.range(1).write.mode("append").parquet(str(tmp_path / "t.parquet"))
    assert one != model_store.fingerprint(spark, str(tmp_path), "m")


@pytest.mark.parametrize("kind", ["boosted", "classifier", "parts"])
def test_node_tables_predict_and_explain(spark, rows, tmp_path, kind):
    if kind == "boosted":
        model = fitted(rows, GBTRegressor(labelCol="y", maxIter=8, maxDepth=3, stepSize=0.1))
    elif kind == "classifier":
        weighted = rows.withColumn("w", F.when(F.col("label") > 0, 2.0).otherwise(1.0))
        model = fitted(weighted, RandomForestClassifier(labelCol="label", weightCol="w", numTrees=7, maxDepth=4, seed=1))
    else:
        model = models.fit_lag_forest(rows, FEATURES, "y", trees=11, depth=4, parts=3)
    path = str(tmp_path / "model")
    models.save_model(model, path)
    predict = models.predict_risk if kind == "classifier" else models.predict_volume
    want = {r.key: r.p for r in predict(models.load_model(path), rows, "p").collect()}
    nodes = forest_nodes.node_table(spark, path)
    got = {r.key: r.replayed for r in forest_nodes.predict(rows, nodes, FEATURES, "key").collect()}
    assert got == pytest.approx(want)
    parts = forest_nodes.contributions(rows, nodes, FEATURES, "key")
    sums = {r.key: r.total for r in parts.groupBy("key").agg(F.sum("contribution").alias("total")).collect()}
    assert sums == pytest.approx(want)
    assert {r.feature for r in parts.select("feature").distinct().collect()} <= {None, *FEATURES}
    assert forest_nodes.predict(rows.limit(0), nodes, FEATURES, "key").collect() == []


def test_a_tree_of_one_leaf(spark, tmp_path):
    flat = spark.createDataFrame([(i, i % 3, 0.5, 0.0, 7.0) for i in range(20)], "key long, a int, b double, c double, y double")
    models.save_model(fitted(flat, GBTRegressor(labelCol="y", maxIter=2)), str(tmp_path / "model"))
    nodes = forest_nodes.node_table(spark, str(tmp_path / "model"))
    assert {r.replayed for r in forest_nodes.predict(flat, nodes, FEATURES, "key").collect()} == {7.0}
    assert [r.feature for r in forest_nodes.contributions(flat.limit(1), nodes, FEATURES, "key").collect()] == [None]


def test_cells_carry_their_row_counts(rows):
    cells = forest_nodes.with_keys(rows, ["a", "c"])
    assert cells.agg(F.sum("n")).first()[0] == 600 and cells.select("cell").distinct().count() == cells.count() == 20
