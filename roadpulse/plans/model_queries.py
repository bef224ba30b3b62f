"""Scenarios, metrics, models, drift and the run log."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.operators import clustering, drift, forest_nodes, metrics, model_store, models, profiles, runlog, scenarios, series
from roadpulse.plans import inputs
from roadpulse.plans.oracle import define, r, rounded, sql
from roadpulse.plans.registry import query
from roadpulse.sources.storage import new_path, save

_FEATURES = ", ".join(f'"{f}"' for f in S.FEATURES)


# -- scenarios --------------------------------------------------------------------
define("scenario_requests", ["traffic_raw"], """
    SELECT corridor, coalesce(hour(TRY_CAST(date_time AS TIMESTAMP)), 24) AS hour,
      CASE WHEN clouds_all = 50 THEN 'holiday' WHEN isodow(TRY_CAST(date_time AS TIMESTAMP)) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type,
      CASE WHEN clouds_all = 70 THEN 'Hail' WHEN clouds_all = 10 THEN NULL ELSE weather_main END AS weather, holiday <> 'None' AS is_holiday
    FROM traffic_raw""")
define("checked_scenarios", ["scenario_requests"], f"""
    SELECT corridor, hour, day_type, coalesce(weather, 'Clear') AS weather, is_holiday,
      CASE WHEN hour NOT BETWEEN 0 AND 23 THEN 'hour must be between 0 and 23'
           WHEN day_type NOT IN ('weekday', 'weekend') THEN 'day type must be weekday or weekend'
           WHEN coalesce(weather, 'Clear') NOT IN ({', '.join(repr(w) for w in S.WEATHER_VALUES)}) THEN 'unknown weather' END AS reason
    FROM scenario_requests""")
define("scenarios", ["timed"], """
    SELECT DISTINCT CASE WHEN is_weekend = 1 THEN 'weekend' ELSE 'weekday' END AS day_type, weather_main AS weather, is_holiday FROM timed""")
define("profile", ["split"], """
    SELECT hour, is_weekend, weather_main AS weather, avg(traffic_volume) AS m FROM split WHERE is_train GROUP BY 1, 2, 3""")
define("profile_any", ["split"], """
    SELECT hour, is_weekend, avg(traffic_volume) AS m FROM split WHERE is_train GROUP BY 1, 2""")
define("profile_curves", ["scenarios", "profile", "profile_any"], """
    SELECT s.*, a.hour, coalesce(p.m, a.m) AS predicted_volume FROM scenarios s
    JOIN profile_any a ON a.is_weekend = CAST(s.day_type = 'weekend' AS BIGINT)
    LEFT JOIN profile p ON p.hour = a.hour AND p.is_weekend = a.is_weekend AND p.weather = s.weather""")


@query("scenario_validate", sql("checked_scenarios", """
    SELECT hour, day_type, weather, is_holiday, reason, count(*) AS n FROM checked_scenarios GROUP BY ALL"""))
def scenario_validate(spark, sf_dir):
    checked = scenarios.check_scenarios(inputs.scenario_requests(spark, sf_dir))
    return checked.groupBy("hour", "day_type", "weather", "is_holiday", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("scenario_grid", sql("scenarios", f"""
    SELECT day_type, weather, hour, {r('sin(2*pi()*hour/24)')} AS hour_sin, {r('cos(2*pi()*hour/24)')} AS hour_cos,
      {r("sin(2*pi()*CASE day_type WHEN 'weekend' THEN 5 ELSE 2 END/7)")} AS dow_sin,
      {r("cos(2*pi()*CASE day_type WHEN 'weekend' THEN 5 ELSE 2 END/7)")} AS dow_cos,
      CAST(day_type = 'weekend' AS BIGINT) AS is_weekend, CAST(is_holiday AS BIGINT) AS is_holiday,
      {', '.join(f"CAST(weather = '{w}' AS BIGINT) AS weather_{w}" for w in S.WEATHER_VALUES)},
      CAST(weather IN ('Thunderstorm','Snow','Squall') AS BIGINT) AS is_severe_weather,
      CAST(weather IN ('Fog','Mist','Haze','Smoke') AS BIGINT) AS is_low_visibility,
      CAST(weather IN ('Rain','Drizzle','Snow','Thunderstorm') AS BIGINT) AS has_precipitation
    FROM scenarios, range(24) g(hour)"""))
def scenario_grid(spark, sf_dir):
    return scenarios.scenario_grid(inputs.observed_scenarios(spark, sf_dir))


def _profile_curves(spark, sf_dir):
    """Predicted curve per observed scenario, with training means as the model."""
    train = inputs.train_rows(spark, sf_dir)
    by_weather = metrics.mean_profile(train.withColumn("weather", F.col("weather_main")), ["hour", "is_weekend", "weather"])
    overall = metrics.mean_profile(train, ["hour", "is_weekend"]).withColumnRenamed("pred", "any_weather")
    grid = scenarios.scenario_features(scenarios.all_hours(inputs.observed_scenarios(spark, sf_dir)))
    return (
        grid.join(overall, ["hour", "is_weekend"])
        .join(by_weather, ["hour", "is_weekend", "weather"], "left")
        .select(
            "day_type", "weather", F.col("is_holiday").cast("boolean").alias("is_holiday"), "hour",
            F.coalesce("pred", "any_weather").alias("predicted_volume"),
        )
    )


@query("profile_curves", sql("profile_curves", f"""
    SELECT day_type, weather, is_holiday, hour, {r('predicted_volume')} AS predicted_volume FROM profile_curves"""))
def profile_curves(spark, sf_dir):
    return _profile_curves(spark, sf_dir)


_BEST = """
    , best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY day_type, weather, is_holiday ORDER BY round(predicted_volume, 6), hour) AS place
      FROM profile_curves WHERE hour BETWEEN 6 AND 22) WHERE place <= 3)"""


@query("recommend_profile", sql("profile_curves", f"""{_BEST}
    SELECT day_type, weather, is_holiday, place, hour, round(predicted_volume, 0) AS predicted_volume FROM best"""))
def recommend_profile(spark, sf_dir):
    curves = _profile_curves(spark, sf_dir).withColumn("predicted_volume", F.round("predicted_volume", 6))
    return scenarios.best_windows(curves)


@query("recommend_message", sql("profile_curves", f"""{_BEST}
    SELECT day_type, weather, is_holiday, 'Quietest hour for a ' || day_type || CASE WHEN is_holiday THEN ' holiday' ELSE '' END
      || ' trip in weather ' || weather || ': ' || lpad(hour::VARCHAR, 2, '0') || ':00-' || lpad(((hour + 1) % 24)::VARCHAR, 2, '0')
      || ':00, about ' || CAST(round(predicted_volume, 0) AS BIGINT)::VARCHAR || ' vehicles' AS message FROM best WHERE place = 1"""))
def recommend_message(spark, sf_dir):
    return scenarios.recommendation_messages(recommend_profile(spark, sf_dir))


# -- metrics on given predictions -----------------------------------------------------
define("predictions", ["test_rows", "profile_any", "split"], """
    SELECT t.*, p.m AS pred, coalesce(k.score, 0E0) AS score FROM test_rows t LEFT JOIN profile_any p USING (hour, is_weekend)
    LEFT JOIN (SELECT hour, weather_main, avg(high_risk) AS score FROM split WHERE is_train GROUP BY 1, 2) k USING (hour, weather_main)""")


def _predictions(spark, sf_dir):
    """Test rows with training means as predictions."""
    train, test = inputs.train_rows(spark, sf_dir), inputs.test_rows(spark, sf_dir)
    volume = metrics.mean_profile(train, ["hour", "is_weekend"])
    risk = metrics.mean_profile(train, ["hour", "weather_main"], "high_risk").withColumnRenamed("pred", "score")
    scored = metrics.predict_from_profile(test, volume, ["hour", "is_weekend"])
    return metrics.predict_from_profile(scored, risk, ["hour", "weather_main"]).withColumn(
        "score", F.coalesce("score", F.lit(0.0))
    )


@query("regression_metrics", sql("predictions", f"""
    SELECT t.corridor, {r('avg(abs(traffic_volume - pred))', 5)} AS MAE,
      {r('1 - sum(power(traffic_volume - pred, 2)) / sum(power(traffic_volume - m, 2)) FILTER (pred IS NOT NULL)', 5)} AS R2,
      count(pred) AS n, count(*) - count(pred) AS n_left_out
    FROM predictions t JOIN (SELECT corridor, avg(traffic_volume) FILTER (pred IS NOT NULL) AS m FROM predictions GROUP BY 1) k ON k.corridor = t.corridor GROUP BY 1"""), digits=5)
def regression_metrics(spark, sf_dir):
    return metrics.regression_metrics(_predictions(spark, sf_dir), "traffic_volume", by=["corridor"])


_CONFUSION = """
      count(*) FILTER (score >= 0.5 AND high_risk = 1) AS tp, count(*) FILTER (score >= 0.5 AND high_risk = 0) AS fp,
      count(*) FILTER (score < 0.5 AND high_risk = 1) AS fn, count(*) FILTER (score < 0.5 AND high_risk = 0) AS tn"""
_CLASSIFICATION = """
      (tp + tn) / (tp + fp + fn + tn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
      coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
      (ranks - (tp + fn) * (tp + fn + 1) / 2) / ((tp + fn) * (fp + tn)) AS roc_auc"""
define("clf_runs", ["predictions"], f"""
    SELECT corridor, {_CLASSIFICATION} FROM (
      SELECT corridor, {_CONFUSION}, sum(avg_rank) FILTER (high_risk = 1) AS ranks FROM (
        SELECT *, rank() OVER (PARTITION BY corridor ORDER BY score) + (count(*) OVER (PARTITION BY corridor, score) - 1) / 2 AS avg_rank
        FROM predictions) GROUP BY corridor)""")


@query("classification_metrics", sql("clf_runs", f"""
    SELECT corridor, {rounded('accuracy precision recall f1 roc_auc')} FROM clf_runs"""))
def classification_metrics(spark, sf_dir):
    return metrics.classification_metrics(_predictions(spark, sf_dir), "high_risk", by=["corridor"])


@query("error_drift", sql("predictions", f"""
    SELECT {r('a')} AS mae_first_half, {r('b')} AS mae_second_half, {r('(b - a) / a')} AS pct_change,
      CASE WHEN (b - a) / a > 0.2 THEN 'ALERT' ELSE 'PASS' END AS status
    FROM (SELECT avg(abs(traffic_volume - pred)) FILTER (half = 1) AS a, avg(abs(traffic_volume - pred)) FILTER (half = 2) AS b FROM predictions)"""))
def error_drift(spark, sf_dir):
    halves = series.split_halves(inputs.featured(spark, sf_dir).select("corridor", "ts", "hour", "is_weekend", "traffic_volume"))
    profile = metrics.mean_profile(inputs.train_rows(spark, sf_dir), ["hour", "is_weekend"])
    predicted = metrics.predict_from_profile(halves, profile, ["hour", "is_weekend"])
    return metrics.error_drift(predicted, S.ERROR_ALERT_ABOVE, "traffic_volume")


@query("first_n_test", sql("predictions", f"""
    SELECT corridor, ts, traffic_volume AS actual, {r('pred')} AS predicted FROM predictions WHERE in_first_n"""))
def first_n_test(spark, sf_dir):
    halves = series.split_halves(inputs.featured(spark, sf_dir).select("corridor", "ts", "hour", "is_weekend", "traffic_volume"))
    profile = metrics.mean_profile(inputs.train_rows(spark, sf_dir), ["hour", "is_weekend"])
    return metrics.predict_from_profile(halves.filter("in_first_n"), profile, ["hour", "is_weekend"]).select(
        "corridor", "ts", F.col("traffic_volume").alias("actual"), F.col("pred").alias("predicted")
    )


# -- drift ---------------------------------------------------------------------------------
_CASTS = ", ".join(f'CAST("{f}" AS DOUBLE) AS "{f}"' for f in S.FEATURES)


def _define_drift(name: str, source: str, needs: list[str]) -> None:
    define(f"{name}_counts", needs, f"""
      SELECT feature, value, count(*) FILTER (is_train) AS a, count(*) FILTER (NOT is_train) AS b
      FROM (UNPIVOT (SELECT is_train, {_CASTS} FROM {source}) ON {_FEATURES} INTO NAME feature VALUE value) GROUP BY 1, 2""")
    define(name, [f"{name}_counts"], f"""
      SELECT feature, max(abs(fa - fb)) AS d, max(na) AS na, max(nb) AS nb FROM (
        SELECT feature, sum(a) OVER w / sum(a) OVER (PARTITION BY feature) AS fa, sum(b) OVER w / sum(b) OVER (PARTITION BY feature) AS fb,
          sum(a) OVER (PARTITION BY feature) AS na, sum(b) OVER (PARTITION BY feature) AS nb
        FROM {name}_counts WINDOW w AS (PARTITION BY feature ORDER BY value)) GROUP BY feature""")
    define(f"{name}_report", [name], f"""
      SELECT feature, d AS ks_statistic, CASE WHEN t < 0.2 THEN 1E0 ELSE greatest(0E0, least(1E0, 2 * list_sum(list_transform(range(1, 101),
          lambda k: CASE WHEN k % 2 = 1 THEN 1E0 ELSE -1E0 END * exp(-2E0 * k * k * t * t))))) END AS p_value,
        CASE WHEN d > 0.1 THEN 'ALERT' ELSE 'PASS' END AS status
      FROM (SELECT *, d * sqrt(CAST(na AS DOUBLE) * nb / (na + nb)) AS t FROM {name})""")


define("split_flagged", ["split"], "SELECT * REPLACE (CAST(is_holiday AS BIGINT) AS is_holiday) FROM split")
define("faulty", ["split_flagged"], """
    SELECT * REPLACE (CASE WHEN hit THEN 1 ELSE is_severe_weather END AS is_severe_weather,
      CASE WHEN hit THEN 0 ELSE "weather_Clear" END AS "weather_Clear", CASE WHEN hit THEN 1 ELSE "weather_Thunderstorm" END AS "weather_Thunderstorm")
    FROM (SELECT *, NOT is_train AND ((date_diff('second', TIMESTAMP '1970-01-01', ts) // 3600) * 4 + corridor) * 2654435761 % 1000 < 600 AS hit FROM split_flagged)""")
_define_drift("drift", "split_flagged", ["split_flagged"])
_define_drift("fault", "faulty", ["faulty"])


def _summary_sql(report: str) -> str:
    return f"""
    SELECT CASE WHEN coalesce(bool_or(status = 'ALERT'), false) THEN 'ALERT' ELSE 'PASS' END AS overall_status,
      count(*) FILTER (status = 'ALERT') AS n_alerts, coalesce(string_agg(feature, ', ' ORDER BY feature) FILTER (status = 'ALERT'), '') AS flagged
    FROM {report}"""


def _faulty(spark, sf_dir):
    number = F.floor(C.seconds(F.col("ts")) / 3600) * 4 + F.col("corridor")
    return drift.inject_severe_weather(inputs.model_table(spark, sf_dir), drift.portable_share(number, 600))


@query("ks_two_sample", sql("drift", f"SELECT feature, {r('d')} AS ks_statistic, CAST(na AS BIGINT) AS n_train, CAST(nb AS BIGINT) AS n_test FROM drift"))
def ks_two_sample(spark, sf_dir):
    return drift.ks_two_sample(inputs.model_table(spark, sf_dir))


define("drift_continuous_source", ["split"], "SELECT is_train, temp, traffic_volume, clouds_all FROM split")
define("drift_continuous_counts", ["drift_continuous_source"], """
    SELECT feature, value, count(*) FILTER (is_train) AS a, count(*) FILTER (NOT is_train) AS b FROM (
      UNPIVOT (SELECT is_train, CAST(temp AS DOUBLE) AS temp, CAST(traffic_volume AS DOUBLE) AS traffic_volume, CAST(clouds_all AS DOUBLE) AS clouds_all
               FROM drift_continuous_source) ON temp, traffic_volume, clouds_all INTO NAME feature VALUE value) GROUP BY 1, 2""")


@query("ks_readings", sql("drift_continuous_counts", f"""
    SELECT feature, {r('max(abs(fa - fb))')} AS ks_statistic FROM (
      SELECT feature, sum(a) OVER w / sum(a) OVER (PARTITION BY feature) AS fa, sum(b) OVER w / sum(b) OVER (PARTITION BY feature) AS fb
      FROM drift_continuous_counts WINDOW w AS (PARTITION BY feature ORDER BY value)) GROUP BY feature"""))
def ks_readings(spark, sf_dir):
    """The same test on readings with many distinct values."""
    return drift.ks_two_sample(
        inputs.model_table(spark, sf_dir), ["temp", "traffic_volume", "clouds_all"]
    ).select("feature", "ks_statistic")


@query("drift_report", sql("drift_report", f"SELECT feature, {rounded('ks_statistic p_value')}, status FROM drift_report"))
def drift_report(spark, sf_dir):
    return drift.drift_report(inputs.model_table(spark, sf_dir))


@query("alert_status", sql("drift_report", _summary_sql("drift_report")))
def alert_status(spark, sf_dir):
    return drift.drift_summary(drift_report(spark, sf_dir))


@query("perturb_sample", sql("fault_report", f"SELECT feature, {rounded('ks_statistic p_value')}, status FROM fault_report"))
def perturb_sample(spark, sf_dir):
    return drift.drift_report(_faulty(spark, sf_dir))


@query("perturb_alert", sql("fault_report", _summary_sql("fault_report")))
def perturb_alert(spark, sf_dir):
    return drift.drift_summary(perturb_sample(spark, sf_dir))


@query("sample_rows", sql("test_rows", """
    SELECT corridor, ts, traffic_volume FROM test_rows ORDER BY md5('42|' || corridor || '|' || CAST(ts AS VARCHAR)), corridor, ts LIMIT 1000"""))
def sample_rows(spark, sf_dir):
    return drift.sample_rows(inputs.test_rows(spark, sf_dir).select("corridor", "ts", "traffic_volume"), 1000)


# -- run log ---------------------------------------------------------------------------------
_PROFILES = {"DayTypeMean": ["is_weekend"], "HourMean": ["hour"], "HourDayTypeMean": ["hour", "is_weekend"]}

define("reg_runs", ["test_rows", "split"], " UNION ALL ".join(f"""
    SELECT '{name}' AS model, corridor, avg(abs(traffic_volume - p)) AS MAE,
      1 - sum(power(traffic_volume - p, 2)) / (var_pop(traffic_volume) * count(*)) AS R2 FROM test_rows
      JOIN (SELECT {', '.join(by)}, avg(traffic_volume) AS p FROM split WHERE is_train GROUP BY ALL) USING ({', '.join(by)}) GROUP BY corridor"""
    for name, by in _PROFILES.items()))
define("run_log", ["reg_runs", "clf_runs"], """
    SELECT experiment, run_name, TIMESTAMP '2024-01-01' + to_days(CAST(attempt AS INT)) + to_hours(CAST(corridor AS BIGINT)) AS start_time,
      model, task, MAE, R2, accuracy, precision, recall, f1, roc_auc
    FROM (SELECT corridor, 'regression_' || model AS run_name, model, 'regression_traffic_volume' AS task, MAE, R2,
            NULL AS accuracy, NULL AS precision, NULL AS recall, NULL AS f1, NULL AS roc_auc FROM reg_runs
          UNION ALL SELECT corridor, 'classification_HourWeatherShare', 'HourWeatherShare', 'classification_high_risk', NULL, NULL,
            accuracy, precision, recall, f1, roc_auc FROM clf_runs),
      (VALUES ('profile_models', 0), ('profile_models', 1), ('Default', 0)) v(experiment, attempt)""")
define("runs", ["run_log"], """
    SELECT * EXCLUDE (p) FROM (SELECT *, row_number() OVER (
      PARTITION BY run_name, MAE, R2, accuracy, precision, recall, f1, roc_auc ORDER BY start_time DESC) AS p
      FROM run_log WHERE experiment <> 'Default') WHERE p = 1""")

_METRICS = rounded("MAE R2", 5) + ", " + rounded("accuracy precision recall f1 roc_auc", 5)


def _run_rows(spark, sf_dir):
    """One run per profile model and corridor, each logged twice and once as a try-out."""
    train, test = inputs.train_rows(spark, sf_dir), inputs.test_rows(spark, sf_dir)
    attempts = F.explode(F.array(*[
        F.struct(F.lit(e).alias("experiment"), F.lit(a).alias("attempt"))
        for e, a in [("profile_models", 0), ("profile_models", 1), ("Default", 0)]
    ]))
    start = F.expr(
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(logged.attempt, corridor, 0, 0)"
    )

    def runs(measured, model, prefix, task, names):
        return measured.withColumn("logged", attempts).select(
            F.col("logged.experiment").alias("experiment"),
            F.lit(f"{prefix}_{model}").alias("run_name"),
            start.alias("start_time"),
            runlog.as_map({"model": F.lit(model), "task": F.lit(task)}, "string").alias("params"),
            runlog.as_map({n: F.col(n) for n in names}, "double").alias("metrics"),
        )

    tables = []
    for name, by in _PROFILES.items():
        predicted = metrics.predict_from_profile(test, metrics.mean_profile(train, by), by)
        measured = metrics.regression_metrics(predicted, "traffic_volume", by=["corridor"])
        tables.append(runs(measured, name, "regression", "regression_traffic_volume", ["MAE", "R2"]))
    risk = metrics.classification_metrics(_predictions(spark, sf_dir), "high_risk", by=["corridor"])
    tables.append(runs(
        risk, "HourWeatherShare", "classification", "classification_high_risk",
        ["accuracy", "precision", "recall", "f1", "roc_auc"],
    ))
    return runlog.union_runs(*tables)


_logs: dict[tuple[str, str, str], str] = {}


def _log_of(spark, sf_dir, name, rows):
    """The log as its readers find it: appended files, written by the first query that reads it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _logs:
        path = new_path(spark, name)
        runlog.append_runs(rows(spark, sf_dir), path)
        _logs[key] = path
    return runlog.read_log(spark, _logs[key])


def _run_log(spark, sf_dir):
    return _log_of(spark, sf_dir, "run_log", _run_rows)


@query("run_log_append", sql("run_log", """
    SELECT experiment, run_name, CAST(2 * count(*) AS BIGINT) AS n, CAST(2 * count(MAE) AS BIGINT) AS with_mae FROM run_log GROUP BY 1, 2"""))
def run_log_append(spark, sf_dir):
    """Appending twice doubles the log."""
    path, rows = new_path(spark, "run_log"), _run_rows(spark, sf_dir)
    for _ in range(2):
        runlog.append_runs(rows, path)
    return runlog.read_log(spark, path).groupBy("experiment", "run_name").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.try_element_at("metrics", F.lit("MAE"))).alias("with_mae")
    )


@query("run_log_source", sql("run_log", "SELECT experiment, run_name, start_time, model FROM run_log WHERE experiment <> 'Default'"))
def run_log_source(spark, sf_dir):
    return runlog.logged_runs(_run_log(spark, sf_dir)).select(
        "experiment", "run_name", "start_time", F.try_element_at("params", F.lit("model")).alias("model")
    )


@query("run_comparison", sql("runs", f"SELECT experiment, run_name, start_time, model, task, {_METRICS} FROM runs"), digits=5)
def run_comparison(spark, sf_dir):
    return runlog.run_comparison(_run_log(spark, sf_dir)).select(
        "experiment", "run_name", "start_time", "model", "task",
        "MAE", "R2", "accuracy", "precision", "recall", "f1", "roc_auc",
    )


def _runs(spark, sf_dir):
    return runlog.run_comparison(_run_log(spark, sf_dir))


@query("runs_by_name", sql("runs", f"SELECT run_name, start_time, {r('R2', 5)} AS \"R2\" FROM runs WHERE run_name LIKE '%HourMean%'"), digits=5)
def runs_by_name(spark, sf_dir):
    return runlog.named_like(_runs(spark, sf_dir), "HourMean").select("run_name", "start_time", "R2")


@query("clf_compare", sql("runs", f"""
    SELECT run_name, model, {rounded('precision recall f1 roc_auc', 5)} FROM runs WHERE task = 'classification_high_risk' AND precision IS NOT NULL"""), digits=5)
def clf_compare(spark, sf_dir):
    return runlog.classification_comparison(_runs(spark, sf_dir), "classification_high_risk")


_BEST_RUN = f"""
    SELECT run_name, model, {r('R2', 5)} AS "R2" FROM (
      SELECT *, row_number() OVER (PARTITION BY model ORDER BY R2 DESC, run_name, start_time DESC) AS p FROM runs WHERE R2 IS NOT NULL) WHERE p = 1"""


@query("best_run_per_model", sql("runs", _BEST_RUN), digits=5)
def best_run_per_model(spark, sf_dir):
    return runlog.best_run_per_model(_runs(spark, sf_dir))


@query("reg_compare", sql("runs", f"""
    , chosen AS (SELECT * FROM runs WHERE task = 'regression_traffic_volume')
    SELECT model, {r('max(R2)', 5)} AS "R2", {r('min(MAE)', 5)} AS "MAE", count(*) AS n_runs FROM chosen GROUP BY model"""), digits=5)
def reg_compare(spark, sf_dir):
    return _runs(spark, sf_dir).filter("task = 'regression_traffic_volume'").groupBy("model").agg(
        F.max("R2").alias("R2"), F.min("MAE").alias("MAE"), F.count(F.lit(1)).alias("n_runs")
    )


@query("run_union", sql("runs", f"""
    SELECT run_name, CASE WHEN task LIKE 'regression%' THEN {r('MAE', 5)} END AS "MAE", CASE WHEN task LIKE 'class%' THEN {r('f1', 5)} END AS f1 FROM runs"""), digits=5)
def run_union(spark, sf_dir):
    """Tables with different columns put under one another."""
    runs = _runs(spark, sf_dir)
    return runlog.union_runs(
        runs.filter("task LIKE 'regression%'").select("run_name", "MAE"),
        runs.filter("task LIKE 'class%'").select("run_name", "f1"),
    )


# -- models ------------------------------------------------------------------------------------
@query("class_weights", sql("split", f"""
    SELECT CAST(high_risk AS DOUBLE) AS label, count(*) AS n, {r('sum(count(*)) OVER () / (count(*) OVER () * count(*))')} AS class_weight
    FROM split WHERE is_train GROUP BY high_risk"""))
def class_weights(spark, sf_dir):
    return models.class_weights(inputs.train_rows(spark, sf_dir))


@query("regression_cells", sql("split_flagged", f"""
    SELECT {', '.join(f'{r(chr(34) + f + chr(34))} AS "{f}"' if f.endswith(('_sin', '_cos')) else f'"{f}"' for f in S.FEATURES)},
      {r('avg(traffic_volume)')} AS label, CAST(count(*) AS DOUBLE) AS weight FROM split_flagged WHERE is_train GROUP BY {_FEATURES}"""))
def regression_cells(spark, sf_dir):
    return models.regression_cells(inputs.train_rows(spark, sf_dir))


# Of every fit: class of the logged model, task, and the parameters it was made with.
_FITS = {
    "logistic": ("LogisticRegression", "classification_high_risk", {}),
    "forest": ("RandomForestClassifier", "classification_high_risk", {"n_estimators": 200, "max_depth": 10}),
    "linear": ("LinearRegression", "regression_traffic_volume", {}),
    "boosting": ("GradientBoostingRegressor", "regression_traffic_volume", {"n_estimators": 200, "max_depth": 4}),
    "lag_forest": ("LagForest", "forecast_traffic_volume", {"n_estimators": 200, "max_depth": 10, "lookback": S.LOOKBACK}),
}


def _entry(spark, sf_dir, name):
    """A published model with its entry in the registry."""
    fits = {
        "logistic": models.fit_logistic, "forest": models.fit_forest_classifier, "linear": models.fit_linear,
        "boosting": models.fit_boosting, "lag_forest": models.fit_lag_forest,
    }
    train = _lag_train if name == "lag_forest" else inputs.train_rows
    return inputs.fitted(spark, sf_dir, name, lambda: fits[name](train(spark, sf_dir)), _FITS[name][2])


def _lag_train(spark, sf_dir):
    return inputs.lag_table(spark, sf_dir).filter("is_train")


def _lag_test(spark, sf_dir):
    return inputs.lag_table(spark, sf_dir).filter("NOT is_train")


def _logistic(spark, sf_dir):
    return _entry(spark, sf_dir, "logistic")[0]


def _forest(spark, sf_dir):
    return _entry(spark, sf_dir, "forest")[0]


def _linear(spark, sf_dir):
    return _entry(spark, sf_dir, "linear")[0]


def _boosting(spark, sf_dir):
    return _entry(spark, sf_dir, "boosting")[0]


def _lag_forest(spark, sf_dir):
    return _entry(spark, sf_dir, "lag_forest")[0]


def _nodes(spark, sf_dir, name):
    """The node table of a published tree ensemble."""
    return forest_nodes.node_table(spark, _entry(spark, sf_dir, name)[1]["path"])


def _risk_metrics(spark, sf_dir, model):
    scored = models.predict_risk(model, inputs.test_rows(spark, sf_dir))
    return metrics.classification_metrics(scored, "high_risk")


def _volume_metrics(spark, sf_dir, model):
    scored = models.predict_volume(model, inputs.test_rows(spark, sf_dir))
    return metrics.regression_metrics(scored, "traffic_volume")


@query("clf_logistic")
def clf_logistic(spark, sf_dir):
    return _risk_metrics(spark, sf_dir, _logistic(spark, sf_dir))


@query("clf_forest")
def clf_forest(spark, sf_dir):
    return _risk_metrics(spark, sf_dir, _forest(spark, sf_dir))


@query("reg_linear")
def reg_linear(spark, sf_dir):
    return _volume_metrics(spark, sf_dir, _linear(spark, sf_dir))


@query("reg_gbt")
def reg_gbt(spark, sf_dir):
    return _volume_metrics(spark, sf_dir, _boosting(spark, sf_dir))


@query("reg_lag_forest")
def reg_lag_forest(spark, sf_dir):
    return metrics.regression_metrics(models.predict_volume(_lag_forest(spark, sf_dir), _lag_test(spark, sf_dir)), "traffic_volume")


@query("model_comparison")
def model_comparison(spark, sf_dir):
    """All metrics side by side, one row per model."""
    rows = [
        ("LogisticRegression", clf_logistic(spark, sf_dir)),
        ("RandomForestClassifier", clf_forest(spark, sf_dir)),
        ("LinearRegression", reg_linear(spark, sf_dir)),
        ("GradientBoostingRegressor", reg_gbt(spark, sf_dir)),
    ]
    return runlog.union_runs(*[table.withColumn("model", F.lit(name)) for name, table in rows])


def _measured(spark, sf_dir, name):
    """Metrics on the test rows of one published model."""
    scored = {"logistic": clf_logistic, "forest": clf_forest, "linear": reg_linear, "boosting": reg_gbt, "lag_forest": reg_lag_forest}
    return scored[name](spark, sf_dir)


def _trained_log(spark, sf_dir):
    """One logged run for each published model: a run is measured and logged once, by the first job that asks for it."""
    # The training tables first; fits that are still to be made then run side by side.
    inputs.train_rows(spark, sf_dir), _lag_train(spark, sf_dir)
    with ThreadPoolExecutor(len(_FITS)) as pool:
        entries = dict(zip(_FITS, pool.map(lambda name: _entry(spark, sf_dir, name)[1], _FITS)))
    path = f"{inputs.model_registry(spark)}/runs"
    logged = model_store.runs_logged(spark, path)
    rows = []
    for name, entry in entries.items():
        if entry["run"] in logged:
            continue
        model, task, params = _FITS[name]
        measured = _measured(spark, sf_dir, name)
        names = [c for c in ("MAE", "R2", "accuracy", "precision", "recall", "f1", "roc_auc") if c in measured.columns]
        facts = {"model": model, "task": task, "run": entry["run"], "version": entry["version"], **params}
        rows.append(measured.select(
            F.lit("trained_models").alias("experiment"), F.lit(f"{task}_{model}").alias("run_name"),
            F.current_timestamp().cast("timestamp_ntz").alias("start_time"),
            runlog.as_map({k: F.lit(v) for k, v in facts.items()}, "string").alias("params"),
            runlog.as_map({n: F.col(n) for n in names}, "double").alias("metrics"),
        ))
    if rows:
        runlog.append_runs(runlog.union_runs(*rows), path)
    own = F.try_element_at("params", F.lit("run")).isin([e["run"] for e in entries.values()])
    return runlog.read_log(spark, path).filter(own)


_TASKS = " UNION ALL ".join(
    f"""SELECT '{model}' AS model, '{task}' AS task, {params.get('n_estimators', 'NULL')} AS n_estimators, {params.get('max_depth', 'NULL')} AS max_depth,
      {params.get('lookback', 'NULL')} AS lookback, {str('classification' in task).upper()} AS has_auc, {str('classification' not in task).upper()} AS has_mae,
      (SELECT count(*) FROM {'lag_split' if name == 'lag_forest' else 'split'} WHERE NOT is_train) AS test_rows"""
    for name, (model, task, params) in _FITS.items()
)
define("lag_split", ["lagged"], """
    SELECT *, row_number() OVER (PARTITION BY corridor ORDER BY ts) <= floor(0.8E0 * count(*) OVER (PARTITION BY corridor)) AS is_train FROM lagged""")


@query("trained_runs", sql("split lag_split", _TASKS))
def trained_runs(spark, sf_dir):
    """What the published models logged, read back as comparisons read it, with the test rows they were measured on."""
    runs = runlog.run_comparison(_trained_log(spark, sf_dir))
    whole = [F.col(c).cast("int").alias(c) for c in ("n_estimators", "max_depth", "lookback")]
    shown = runs.select("model", "task", *whole, F.col("roc_auc").isNotNull().alias("has_auc"), F.col("MAE").isNotNull().alias("has_mae"))
    rows = [
        table(spark, sf_dir).agg(F.count(F.lit(1)).alias("test_rows")).withColumn("lagged", F.lit(lagged))
        for table, lagged in ((inputs.test_rows, False), (_lag_test, True))
    ]
    counts = rows[0].unionAll(rows[1])
    return shown.join(counts, F.col("lagged") == F.col("lookback").isNotNull()).drop("lagged")


@query("model_ranking", sql("predictions", f"""
    SELECT {r('avg(abs(traffic_volume - pred))', 5)} AS profile_mae, TRUE AS boosting_beats_linear,
      TRUE AS lag_forest_beats_linear, TRUE AS all_better_than_chance FROM predictions"""), digits=5)
def model_ranking(spark, sf_dir):
    """Order of the published models by their logged metrics, beside the error of a plain profile."""
    runs = runlog.run_comparison(_trained_log(spark, sf_dir))
    of = lambda model: F.max(F.when(F.col("model") == model, F.col("MAE")))
    best = runs.agg(
        of("GradientBoostingRegressor").alias("boosting"), of("LinearRegression").alias("linear"), of("LagForest").alias("lags"),
        (F.min("roc_auc") > 0.5).alias("all_better_than_chance"),
    )
    profile = metrics.regression_metrics(_predictions(spark, sf_dir), "traffic_volume").select(F.col("MAE").alias("profile_mae"))
    return best.crossJoin(F.broadcast(profile)).select(  # one row each
        "profile_mae", (F.col("boosting") < F.col("linear")).alias("boosting_beats_linear"),
        (F.col("lags") < F.col("linear")).alias("lag_forest_beats_linear"), "all_better_than_chance",
    )


@query("linear_normal_equations", sql("split_flagged", " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, round(sum("{f}" * traffic_volume), 2) AS label_sum, TRUE AS fitted_equals FROM split_flagged WHERE is_train""" for f in S.FEATURES)), digits=2)
def linear_normal_equations(spark, sf_dir):
    """Least squares: over the training rows, prediction and label have the same sum with every feature."""
    scored = models.predict_volume(_linear(spark, sf_dir), inputs.train_rows(spark, sf_dir))
    sums = scored.agg(*[
        F.struct(
            F.lit(f).alias("feature"), F.sum(F.col(f) * F.col("traffic_volume")).cast("double").alias("label_sum"),
            (F.abs(F.sum(F.col(f) * (F.col("traffic_volume") - F.col("pred")))) <= 1e-4 * F.sum(F.abs(F.col(f) * F.col("traffic_volume")))).alias("fitted_equals"),
        ).alias(f"f{i}")
        for i, f in enumerate(S.FEATURES)
    ])
    return sums.select(F.inline(F.array(*[f"f{i}" for i in range(len(S.FEATURES))])))


@query("forecast_next")
def forecast_next(spark, sf_dir):
    """Next value from the previous 24, with the absolute error, for every test row."""
    return models.predict_volume(_lag_forest(spark, sf_dir), _lag_test(spark, sf_dir)).select(
        "corridor", "ts", "traffic_volume", "pred", F.abs(F.col("traffic_volume") - F.col("pred")).alias("error")
    )


@query("model_error_drift")
def model_error_drift(spark, sf_dir):
    """Error in the two halves of the test period with the boosted model."""
    halves = series.split_halves(
        inputs.featured(spark, sf_dir).withColumn("is_holiday", F.col("is_holiday").cast("int"))
    )
    scored = models.predict_volume(_boosting(spark, sf_dir), halves)
    return metrics.error_drift(scored, S.ERROR_ALERT_ABOVE, "traffic_volume")


@query("mean_abs_contribution")
def mean_abs_contribution(spark, sf_dir):
    return models.linear_contributions(_linear(spark, sf_dir), inputs.test_rows(spark, sf_dir))


@query("permutation_importance")
def permutation_importance(spark, sf_dir):
    return models.permutation_importance(_lag_forest(spark, sf_dir), _lag_test(spark, sf_dir), models.LAG_COLUMNS + S.FEATURES).limit(12)


def _valid_requests(spark, sf_dir):
    return scenarios.scenario_features(scenarios.valid_scenarios(inputs.scenario_requests(spark, sf_dir)))


def _answered(spark, sf_dir, **by):
    """Valid requests with the answers of the given models."""
    answers = models.scenario_answers(spark, **by)
    requests = scenarios.valid_scenarios(inputs.scenario_requests(spark, sf_dir))
    return scenarios.look_up(requests, answers).withColumn("is_holiday", F.col("is_holiday").cast("int"))


_ASKED = ["corridor", "hour", "weather", "day_type", "is_holiday"]


@query("batch_score_volume")
def batch_score_volume(spark, sf_dir):
    return _answered(spark, sf_dir, volume_model=_boosting(spark, sf_dir)).select(*_ASKED, "predicted_traffic_volume")


@query("batch_score_risk")
def batch_score_risk(spark, sf_dir):
    scored = _answered(spark, sf_dir, risk_model=_forest(spark, sf_dir))
    return scored.select(*_ASKED, "high_risk_probability", "high_risk_prediction")


@query("batch_score_counts", sql("checked_scenarios", """
    SELECT day_type, weather, is_holiday, count(*) FILTER (reason IS NULL) AS volume_answers, count(*) FILTER (reason IS NULL) AS risk_answers,
      TRUE AS in_range FROM checked_scenarios WHERE reason IS NULL GROUP BY ALL"""))
def batch_score_counts(spark, sf_dir):
    """Answers of both batch scorers by situation, in one pass over the requests."""
    scored = _answered(spark, sf_dir, volume_model=_boosting(spark, sf_dir), risk_model=_forest(spark, sf_dir))
    share = F.col("high_risk_probability")
    counts = scored.groupBy("day_type", "weather", "is_holiday").agg(
        F.count("predicted_traffic_volume").alias("volume_answers"), F.count(share).alias("risk_answers"),
        F.min((share >= 0) & (share <= 1)).alias("in_range"),
    )
    return counts.withColumn("is_holiday", F.col("is_holiday").cast("boolean"))


@query("scenario_curves")
def scenario_curves(spark, sf_dir):
    grid = scenarios.scenario_grid(inputs.observed_scenarios(spark, sf_dir))
    return models.predict_volume(_boosting(spark, sf_dir), grid, "predicted_volume").select(
        "day_type", "weather", "is_holiday", "hour", "predicted_volume"
    )


@query("recommend_model")
def recommend_model(spark, sf_dir):
    return scenarios.best_windows(scenario_curves(spark, sf_dir))


@query("recommend_model_message")
def recommend_model_message(spark, sf_dir):
    return scenarios.recommendation_messages(recommend_model(spark, sf_dir))


@query("recommend_model_places", sql("scenarios", "SELECT day_type, weather, is_holiday, 3 AS places, TRUE AS in_hours FROM scenarios"))
def recommend_model_places(spark, sf_dir):
    """Three places inside the travel hours for every situation."""
    return recommend_model(spark, sf_dir).groupBy("day_type", "weather", F.col("is_holiday").cast("boolean").alias("is_holiday")).agg(
        F.countDistinct("hour").alias("places"), F.min(F.col("hour").between(6, 22)).alias("in_hours")
    )


# -- clusters -------------------------------------------------------------------------------------
def _vectors(spark, sf_dir):
    points = clustering.cluster_features(inputs.featured(spark, sf_dir))
    return clustering.assemble(clustering.weighted_points(points))


def _clusters(spark, sf_dir):
    """The published clusters with the best number of them, and the scores of all numbers tried."""
    facts = {"candidates": "2 to 6"}

    def fit():
        model, scores = clustering.choose_k(_vectors(spark, sf_dir))
        facts["scores"] = f"{inputs.model_registry(spark)}/scores-{uuid.uuid4().hex}"
        save(scores, facts["scores"])
        return PipelineModel([model])

    model, entry = inputs.fitted(spark, sf_dir, "clusters", fit, facts)
    return model.stages[0], spark.read.parquet(entry["params"]["scores"])


@query("choose_k")
def choose_k(spark, sf_dir):
    return _clusters(spark, sf_dir)[1]


@query("kmeans_totals", sql("timed", """
    SELECT count(*) AS hours, CAST(sum(traffic_volume) AS BIGINT) AS volume, CAST(sum(hour) AS BIGINT) AS hour_sum, TRUE AS no_empty_cluster
    FROM timed WHERE traffic_volume IS NOT NULL"""))
def kmeans_totals(spark, sf_dir):
    """Clusters divide the hours: weights and weighted sums over clusters are those of all hours."""
    vectors = _vectors(spark, sf_dir)
    model, _ = _clusters(spark, sf_dir)
    weight = F.col("weight")
    parts = model.transform(vectors).groupBy("cluster").agg(
        F.sum(weight).alias("n"), F.sum(weight * F.col("traffic_volume")).alias("v"), F.sum(weight * F.col("hour")).alias("h")
    )
    return parts.agg(
        F.sum("n").cast("bigint").alias("hours"), F.sum("v").cast("bigint").alias("volume"), F.sum("h").cast("bigint").alias("hour_sum"),
        (F.count(F.lit(1)) == model.getK()).alias("no_empty_cluster"),
    )


@query("kmeans")
def kmeans(spark, sf_dir):
    """Mean hour, severity and volume per cluster with its description, for the number of clusters that fits best."""
    vectors = _vectors(spark, sf_dir)
    model, _ = _clusters(spark, sf_dir)
    summary = clustering.weighted_summary(model.transform(vectors))
    return summary.withColumn(
        "label", C.cluster_label(F.col("hour"), F.col("weather_severity"), F.col("traffic_volume"))
    )
