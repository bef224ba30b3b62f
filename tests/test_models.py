"""Model fits on a small synthetic road, and the streams built on them."""

import datetime as dt
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.operators import cleaning, clustering, features, metrics, models, scenarios, series
from roadpulse.sources import storage
from roadpulse.streaming import ingest, monitoring, scoring


@pytest.fixture(scope="module")
def road(spark):
    rng, rows, at = random.Random(5), [], dt.datetime(2016, 1, 1)
    for i in range(24 * 150):
        t = at + dt.timedelta(hours=i)
        weather = rng.choices(S.WEATHER_VALUES, [30, 30, 4, 3, 4, 7, 12, 2, 5, 1, 2])[0]
        rush = 3000 if t.weekday() < 5 and t.hour in (7, 8, 16, 17) else 0
        volume = 800 + rush + 150 * min(t.hour, 24 - t.hour) + rng.randint(0, 300)
        rows.append((0, "None", 270.0 + t.hour, 0.0, 0.0, 40, weather, weather.lower(), str(t), volume))
    raw = spark.createDataFrame(rows, S.RAW_SCHEMA)
    featured = features.add_risk_label(features.engineer(cleaning.clean(raw)))
    split = series.chronological_split(featured.withColumn("is_holiday", F.col("is_holiday").cast("int")))
    return raw, storage.stage(split, "test_road")


def test_weighted_cells_give_the_row_solution(spark, road):
    train = road[1].filter("is_train")
    by_cells = models.fit_linear(train)
    vectors = VectorAssembler(inputCols=S.FEATURES, outputCol="features").transform(train)
    by_rows = LinearRegression(labelCol="traffic_volume", solver="normal").fit(vectors)
    pairs = by_rows.transform(models.predict_volume(by_cells, train).join(vectors.select("corridor", "ts", "features"), ["corridor", "ts"]))
    assert pairs.filter(F.abs(F.col("prediction") - F.col("pred")) > 1e-3).isEmpty()


def test_cells_keep_every_row(road):
    train = road[1].filter("is_train")
    n = train.count()
    assert models.regression_cells(train).agg(F.sum("weight")).first()[0] == n
    cells = models.classification_cells(train)
    assert cells.agg(F.sum("n")).first()[0] == n
    # Balanced weights sum to the row count.
    assert cells.agg(F.sum("weight")).first()[0] == pytest.approx(n)


def test_rows_without_a_prediction_are_left_out(spark):
    df = spark.createDataFrame([(0.0, None), (10.0, 12.0), (20.0, 18.0), (None, 1.0)], "y double, pred double")
    got = metrics.regression_metrics(df).first()
    assert (got.MAE, got.n, got.n_left_out) == (2.0, 2, 2) and got.R2 == pytest.approx(1 - 8 / 50)


def test_importance_uses_every_row(spark, road):
    train, test = road[1].filter("is_train"), road[1].filter("NOT is_train")
    model = models.fit_linear(train)
    got = {r.feature: r.importance for r in models.permutation_importance(model, test, S.FEATURES).collect()}
    assert set(got) == set(S.FEATURES) and max(got, key=got.get) in ("hour_sin", "hour_cos", "hour")


def test_ranking_of_models(spark, road, tmp_path):
    train, test = road[1].filter("is_train"), road[1].filter("NOT is_train")

    def volume_error(model):
        return metrics.regression_metrics(models.predict_volume(model, test), "traffic_volume").first()

    linear, boosted = models.fit_linear(train), models.fit_boosting(train, rounds=25)
    assert volume_error(boosted)["MAE"] < volume_error(linear)["MAE"]
    assert volume_error(boosted)["R2"] > 0.9

    forest = models.fit_forest_classifier(train, trees=15)
    logistic = models.fit_logistic(train)
    for model in (forest, logistic):
        row = metrics.classification_metrics(models.predict_risk(model, test), "high_risk").first()
        assert row["roc_auc"] > 0.9 and row["recall"] > 0.7

    models.save_model(boosted, str(tmp_path / "model"))
    assert volume_error(models.load_model(str(tmp_path / "model"))) == volume_error(boosted)

    shares = models.linear_contributions(linear, test).collect()
    assert {r["feature"] for r in shares} == set(S.FEATURES) and all(r["contribution"] >= 0 for r in shares)

    # Requests: every valid one is answered, every other one is set aside.
    asked = spark.createDataFrame(
        [(h, d, w, False) for h in (3, 8, 24) for d in S.DAY_TYPES for w in ("Clear", "Snow", "Hail")], S.SCENARIO_SCHEMA
    )
    source, out = str(tmp_path / "asked"), str(tmp_path / "out")
    asked.write.parquet(source)
    query = scoring.score_stream(scoring.request_stream(spark, source), boosted, forest, out, str(tmp_path / "state"))
    query.awaitTermination()
    scored = spark.read.parquet(f"{out}/scored")
    assert scored.count() == 8 and spark.read.parquet(f"{out}/rejected").count() == 10
    assert scored.filter("high_risk_prediction != (high_risk_probability >= 0.5)").isEmpty()
    batch = models.score_volume(boosted, scenarios.scenario_features(scenarios.valid_scenarios(asked)))
    key = ["hour", "day_type", "weather", "predicted_traffic_volume"]
    assert batch.select(key).exceptAll(scored.select(key)).isEmpty()


def test_lag_forest(spark, road):
    lagged = storage.stage(
        series.chronological_split(series.lag_features(road[1].select("corridor", "ts", "traffic_volume", *S.FEATURES))),
        "test_lags",
    )
    model = models.fit_lag_forest(lagged.filter("is_train"), trees=5, depth=6)
    test = lagged.filter("NOT is_train")
    assert metrics.regression_metrics(models.predict_volume(model, test), "traffic_volume").first()["R2"] > 0.7
    ranking = models.permutation_importance(model, test, models.LAG_COLUMNS + S.FEATURES).collect()
    assert len(ranking) == len(models.LAG_COLUMNS + S.FEATURES)
    assert ranking[0]["importance"] > 0


def test_clusters(road):
    points = clustering.cluster_features(road[1])
    vectors = clustering.assemble(clustering.weighted_points(points))
    assert vectors.agg(F.sum("weight")).first()[0] == points.count()
    model, table = clustering.choose_k(vectors, [2, 3], seeds=[42, 43])
    rows = table.collect()
    assert [r["k"] for r in rows] == [2, 3] and rows[0]["cost"] > rows[1]["cost"]
    assert all(-1 <= r["silhouette"] <= 1 for r in rows)
    summary = clustering.weighted_summary(model.transform(vectors)).collect()
    assert sum(r["n_hours"] for r in summary) == points.count()


def test_clean_stream_over_several_batches(spark, road, tmp_path):
    raw, _ = road
    params, source, out = (str(tmp_path / n) for n in ("params", "raw", "out"))
    first = cleaning.keep_first(cleaning.parse_times(cleaning.standardise_text(raw)))
    ingest.saved_params(cleaning.repair_readings(first), first, params)
    raw.unionByName(raw).repartition(1).sortWithinPartitions("date_time").write.option("maxRecordsPerFile", 2000).parquet(source)
    medians = spark.read.parquet(f"{params}/medians")
    for _ in range(2):  # the second run finds nothing new
        stream = ingest.clean_stream(ingest.raw_stream(spark, source, files_per_batch=1), medians, late="400 days")
        ingest.write_stream(stream, out, str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == raw.count() == got.select("ts").distinct().count()
    saved = spark.read.parquet(f"{params}/features")
    assert features.engineer(got.drop("year"), saved).filter("congestion_category IS NULL").isEmpty()


def test_daily_drift_stream(spark, road, tmp_path):
    _, rows = road
    watched = ["is_severe_weather", "hour"]
    training = monitoring.training_counts(rows, watched)
    source, out = str(tmp_path / "rows"), str(tmp_path / "out")
    narrow = rows.select("ts", *watched)
    narrow.write.parquet(source)
    stream = spark.readStream.schema(narrow.schema).parquet(source)
    monitoring.monitor_stream(stream, training, watched, out, str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(out)
    days = rows.select(F.to_date("ts")).distinct().count()
    assert got.select("day").distinct().count() >= days - 2
    assert got.filter("feature = 'hour' AND ks_statistic > 0.01").isEmpty()  # every day has every hour
