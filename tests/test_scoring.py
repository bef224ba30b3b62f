"""Scoring of requests, by streams and in batches: many ask the same, models answer what can be asked once."""

import itertools

import pytest
from check import compare, connect
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.operators import models, scenarios
from roadpulse.plans import ORACLES, QUERIES, inputs, model_queries, replay_queries
from roadpulse.streaming import scoring

SF_DIR = "/root/testdata/sf0.001"
CAN_BE_ASKED = 24 * 2 * 11 * 2


class Watched:
    """A model that counts the rows it has to answer."""

    def __init__(self, model):
        self.model, self.rows = model, 0

    def transform(self, df):
        self.rows += df.count()
        return self.model.transform(df)


@pytest.fixture(scope="module")
def fits(spark):
    train = inputs.train_rows(spark, SF_DIR)
    return models.fit_boosting(train, rounds=3), models.fit_forest_classifier(train, trees=3, depth=4)


def _same(left, right):
    left = left.select(*right.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_stream_scores_a_repeated_request_once(spark, fits, tmp_path):
    every = list(itertools.product(range(24), S.DAY_TYPES, S.WEATHER_VALUES, [False, True]))
    filled = [(8, "weekend", None, True), (8, "weekday", "Snow", None), (0, "weekday", None, None)]
    refused = [(24, "weekday", "Clear", False), (-1, "weekday", "Clear", False), (None, "weekday", "Clear", False),
               (8, "holiday", "Clear", False), (8, None, "Clear", False), (8, "weekday", "Hail", True)]
    asked = spark.createDataFrame((every + filled + refused) * 3, S.SCENARIO_SCHEMA)
    source, out = str(tmp_path / "asked"), str(tmp_path / "out")
    asked.write.parquet(source)
    volume, risk = map(Watched, fits)
    scoring.score_stream(scoring.request_stream(spark, source), volume, risk, out, str(tmp_path / "state")).awaitTermination()
    assert (volume.rows, risk.rows) == (CAN_BE_ASKED, CAN_BE_ASKED)

    by_row = models.score_risk(fits[1], models.score_volume(fits[0], scenarios.scenario_features(scenarios.valid_scenarios(asked))))
    answers = ["hour", "day_type", "weather", "is_holiday", "predicted_traffic_volume", "high_risk_probability", "high_risk_prediction"]
    scored = spark.read.parquet(f"{out}/scored")
    assert scored.count() == 3 * (len(every) + len(filled)) and _same(scored, by_row.select(answers))
    assert dict(scored.drop("batch").dtypes) == dict(by_row.select(answers).dtypes)
    assert _same(spark.read.parquet(f"{out}/rejected"), scenarios.rejected_scenarios(asked))


def test_batches_score_a_repeated_request_once(spark, fits, monkeypatch):
    volume, risk = map(Watched, fits)
    monkeypatch.setattr(model_queries, "_boosting", lambda *_: volume)
    monkeypatch.setattr(model_queries, "_forest", lambda *_: risk)
    counts = QUERIES["batch_score_counts"](spark, SF_DIR)
    assert compare(counts, connect(SF_DIR), ORACLES["batch_score_counts"]) == ""
    assert (volume.rows, risk.rows) == (CAN_BE_ASKED, CAN_BE_ASKED)
    # One pass over the requests, their time parsed once.
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(") == 1

    asked = scenarios.scenario_features(scenarios.valid_scenarios(inputs.scenario_requests(spark, SF_DIR)))
    for name, by_row in (("batch_score_volume", models.score_volume(fits[0], asked)), ("batch_score_risk", models.score_risk(fits[1], asked))):
        scored = QUERIES[name](spark, SF_DIR)
        by_row = by_row.select([F.col(c).cast(t) for c, t in scored.dtypes])
        assert scored.count() > CAN_BE_ASKED and _same(scored, by_row)


def test_replay_of_the_stream_walks_trees_for_what_can_be_asked(spark, fits, tmp_path, monkeypatch):
    published = {}
    for name, model in zip(("boosting", "forest"), fits):
        models.save_model(model, str(tmp_path / name))
        published[name] = Watched(model), {"path": str(tmp_path / name)}
    monkeypatch.setattr(model_queries, "_entry", lambda spark, sf_dir, name: published[name])
    replayed = QUERIES["stream_score_replay"](spark, SF_DIR)
    assert compare(replayed, connect(SF_DIR), ORACLES["stream_score_replay"]) == ""
    assert [model.rows for model, _ in published.values()] == [CAN_BE_ASKED, CAN_BE_ASKED]

    # One wrong or missing answer among all is found, in its own situation.
    stream = replay_queries.scored_stream
    odd = (F.col("hour") == 3) & (F.col("day_type") == "weekend") & (F.col("weather") == "Clouds") & (F.col("is_holiday") == 0)
    for column, answer in (("high_risk_probability", F.col("high_risk_probability") + 0.001), ("predicted_traffic_volume", F.lit(None))):
        wrong = stream(spark, SF_DIR).withColumn(column, F.when(odd, answer).otherwise(F.col(column)))
        monkeypatch.setattr(replay_queries, "scored_stream", lambda *_: wrong)
        found = QUERIES["stream_score_replay"](spark, SF_DIR).filter("NOT equal").collect()
        assert [(r.day_type, r.weather, r.is_holiday) for r in found] == [("weekend", "Clouds", 0)]
