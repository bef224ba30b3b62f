"""Published models replayed from their node tables or held against what their optimum must satisfy."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.operators import forest_nodes, models, scenarios
from roadpulse.plans import inputs
from roadpulse.plans.model_queries import _entry, _lag_test, _nodes, _valid_requests
from roadpulse.plans.oracle import r, sql
from roadpulse.plans.registry import query
from roadpulse.plans.stream_queries import scored_stream
from roadpulse.sources.storage import stage

_FEATURES = list(S.FEATURES)
_SITUATION = ["day_type", "weather", "is_holiday"]
# Sums of 200 trees in another order differ by rounding only.
_CLOSE = 1e-6


def _spread(spark, df):
    """Few cells meet many trees: as many tasks as cores."""
    return df.repartition(2 * spark.sparkContext.defaultParallelism)


def _cells(spark, rows, by):
    return _spread(spark, forest_nodes.with_keys(rows, [*by, *[f for f in _FEATURES if f not in by]]))


def _compare(spark, sf_dir, name, rows, by, predict):
    """Answers by group, and whether the node table gives each of them as the model does."""
    cells = _cells(spark, rows, by)
    replayed = forest_nodes.predict(cells, _nodes(spark, sf_dir, name), _FEATURES, "cell")
    both = predict(_entry(spark, sf_dir, name)[0], cells, "_model").join(replayed, "cell", "left")
    equal = F.coalesce(F.abs(F.col("_model") - F.col("replayed")) <= _CLOSE * F.greatest(F.lit(1.0), F.abs("_model")), F.lit(False))
    return both.groupBy(*by).agg(F.sum("n").alias("answers"), F.min(equal).alias("equal"))


_REQUESTS = "SELECT day_type, weather, CAST(is_holiday AS BIGINT) AS is_holiday, count(*) AS answers, TRUE AS equal FROM checked_scenarios WHERE reason IS NULL GROUP BY ALL"


@query("batch_volume_replay", sql("checked_scenarios", _REQUESTS))
def batch_volume_replay(spark, sf_dir):
    """Volumes of all requests by the boosted model and by its node table."""
    return _compare(spark, sf_dir, "boosting", _valid_requests(spark, sf_dir), _SITUATION, models.predict_volume)


@query("batch_risk_replay", sql("checked_scenarios", _REQUESTS))
def batch_risk_replay(spark, sf_dir):
    """Risks of all requests by the forest and by its node table."""
    return _compare(spark, sf_dir, "forest", _valid_requests(spark, sf_dir), _SITUATION, models.predict_risk)


@query("curves_replay", sql("scenarios", "SELECT day_type, weather, CAST(is_holiday AS BIGINT) AS is_holiday, 24 AS answers, TRUE AS equal FROM scenarios"))
def curves_replay(spark, sf_dir):
    """Daily curves of all situations by the boosted model and by its node table."""
    grid = scenarios.scenario_grid(inputs.observed_scenarios(spark, sf_dir))
    return _compare(spark, sf_dir, "boosting", grid, _SITUATION, models.predict_volume)


@query("test_rows_replay", sql("test_rows", "SELECT corridor, count(*) AS answers, TRUE AS equal FROM test_rows GROUP BY corridor"))
def test_rows_replay(spark, sf_dir):
    """Risks of the test rows by the forest and by its node table."""
    return _compare(spark, sf_dir, "forest", inputs.test_rows(spark, sf_dir), ["corridor"], models.predict_risk)


@query("stream_score_replay", sql("checked_scenarios", _REQUESTS))
def stream_score_replay(spark, sf_dir):
    """What the stream answered against the node tables of both models, to the digits it writes."""
    answers = scored_stream(spark, sf_dir).groupBy("hour", *_SITUATION, "predicted_traffic_volume", "high_risk_probability").agg(F.count(F.lit(1)).alias("n"))
    rows = stage(scenarios.scenario_features(answers).withColumn("cell", F.monotonically_increasing_id()), "stream-cells")
    cells = _spread(spark, rows)
    volume = forest_nodes.predict(cells, _nodes(spark, sf_dir, "boosting"), _FEATURES, "cell", "volume")
    risk = forest_nodes.predict(cells, _nodes(spark, sf_dir, "forest"), _FEATURES, "cell", "risk")
    both = rows.join(volume, "cell", "left").join(risk, "cell", "left")
    equal = (F.abs(F.col("volume") - F.col("predicted_traffic_volume")) <= 0.05 + _CLOSE) & (F.abs(F.col("risk") - F.col("high_risk_probability")) <= 0.00005 + _CLOSE)
    return both.groupBy(*_SITUATION).agg(F.sum("n").alias("answers"), F.min(F.coalesce(equal, F.lit(False))).alias("equal"))


@query("lag_forest_replay", sql("lag_split", f"""
    SELECT corridor, count(*) AS answers, {r('avg(traffic_volume)')} AS mean_volume, TRUE AS equal FROM lag_split WHERE NOT is_train GROUP BY corridor"""))
def lag_forest_replay(spark, sf_dir):
    """Forecasts of all test rows by the forest over lags and by its node table."""
    features = models.LAG_COLUMNS + _FEATURES
    rows = stage(_lag_test(spark, sf_dir).select("corridor", "traffic_volume", *features).withColumn("cell", F.monotonically_increasing_id()), "lag-cells")
    rows = _spread(spark, rows)
    replayed = forest_nodes.predict(rows, _nodes(spark, sf_dir, "lag_forest"), features, "cell")
    both = models.predict_volume(_entry(spark, sf_dir, "lag_forest")[0], rows, "_model").join(replayed, "cell", "left")
    equal = F.coalesce(F.abs(F.col("_model") - F.col("replayed")) <= _CLOSE * F.abs("_model"), F.lit(False))
    return both.groupBy("corridor").agg(F.count(F.lit(1)).alias("answers"), F.avg("traffic_volume").alias("mean_volume"), F.min(equal).alias("equal"))


@query("logistic_stationary", sql("split_flagged", f"""
    , weights AS (SELECT high_risk, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS w FROM split_flagged WHERE is_train GROUP BY high_risk)
    SELECT feature, round(sum(w * high_risk * value), 2) AS positive_sum, TRUE AS stationary FROM (
      UNPIVOT (SELECT high_risk, CAST(1 AS DOUBLE) AS intercept, {', '.join(f'CAST("{f}" AS DOUBLE) AS "{f}"' for f in S.FEATURES)} FROM split_flagged WHERE is_train)
      ON intercept, {', '.join(f'"{f}"' for f in S.FEATURES)} INTO NAME feature VALUE value) JOIN weights USING (high_risk) GROUP BY feature"""), digits=2)
def logistic_stationary(spark, sf_dir):
    """The weighted logistic loss has no slope left at the published coefficients."""
    found = models.logistic_gradient(_entry(spark, sf_dir, "logistic")[0], inputs.train_rows(spark, sf_dir))
    return found.select("feature", F.col("positive_sum").cast("double").alias("positive_sum"), (F.col("relative") <= 1e-4).alias("stationary"))


def _contributions(spark, sf_dir):
    """Test rows as cells, and each cell's contributions to the boosted model's answer."""
    cells = _cells(spark, inputs.test_rows(spark, sf_dir), ["corridor"])
    return cells, stage(forest_nodes.contributions(cells, _nodes(spark, sf_dir, "boosting"), _FEATURES, "cell"), "contributions")


@query("contribution_sums", sql("test_rows", "SELECT corridor, count(*) AS answers, TRUE AS adds_up FROM test_rows GROUP BY corridor"))
def contribution_sums(spark, sf_dir):
    """The roots' values and all contributions of a test row add up to its prediction."""
    cells, parts = _contributions(spark, sf_dir)
    both = models.predict_volume(_entry(spark, sf_dir, "boosting")[0], cells, "_model").join(
        parts.groupBy("cell").agg(F.sum("contribution").alias("total")), "cell", "left"
    )
    equal = F.coalesce(F.abs(F.col("_model") - F.col("total")) <= _CLOSE * F.greatest(F.lit(1.0), F.abs("_model")), F.lit(False))
    return both.groupBy("corridor").agg(F.sum("n").alias("answers"), F.min(equal).alias("adds_up"))


@query("tree_contributions")
def tree_contributions(spark, sf_dir):
    """Mean absolute contribution of each feature to the boosted model's answers on the test rows."""
    cells, parts = _contributions(spark, sf_dir)
    rows = cells.agg(F.sum("n").alias("rows"))
    sums = parts.filter("feature IS NOT NULL").join(cells.select("cell", "n"), "cell").groupBy("feature").agg(F.sum(F.abs("contribution") * F.col("n")).alias("total"))
    return (
        sums.crossJoin(F.broadcast(rows))  # one row
        .select("feature", (F.col("total") / F.col("rows")).alias("contribution"))
        .orderBy(F.desc("contribution"), "feature")
    )
