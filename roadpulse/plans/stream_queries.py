"""Streaming queries, each run to the end of the available input."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.functions import columns as C
from roadpulse.plans import inputs
from roadpulse.plans.model_queries import _boosting, _forest
from roadpulse.plans.oracle import define, r, rounded, sql
from roadpulse.plans.registry import query
from roadpulse.sources.storage import new_path
from roadpulse.streaming import arrivals, ingest, monitoring, scoring

_WATCHED = ["is_weekend", "is_severe_weather", "is_low_visibility", "has_precipitation", "weather_Clear", "hour"]


@query("stream_clean", sql("first_rows", """
    SELECT corridor, ts, traffic_volume, is_holiday, true AS plausible FROM first_rows"""))
def stream_clean(spark, sf_dir):
    """One plausible row per hour; which of several copies stays depends on arrival."""
    source, params, out = (new_path(spark, f"stream_{n}") for n in ("raw", "params", "cleaned"))
    inputs.raw(spark, sf_dir).write.parquet(source)
    ingest.saved_params(inputs.cleaned(spark, sf_dir), inputs.first_rows(spark, sf_dir), params)
    medians = spark.read.parquet(f"{params}/medians")
    cleaned = ingest.clean_stream(ingest.raw_stream(spark, source), medians)
    ingest.write_stream(cleaned, out, new_path(spark, "stream_state")).awaitTermination()
    return spark.read.parquet(out).select(
        "corridor", "ts", "traffic_volume", "is_holiday",
        ((F.col("temp") > 0) & (F.col("rain_1h") <= 9000)).alias("plausible"),
    )


def scored_stream(spark, sf_dir):
    """Answers to all valid requests, as the stream wrote them."""
    source, out = new_path(spark, "stream_requests"), new_path(spark, "stream_scored")
    inputs.scenario_requests(spark, sf_dir).drop("corridor").write.parquet(source)
    scoring.score_stream(
        scoring.request_stream(spark, source), _boosting(spark, sf_dir), _forest(spark, sf_dir), out,
        new_path(spark, "stream_state"),
    ).awaitTermination()
    return spark.read.parquet(f"{out}/scored").drop("batch")


@query("stream_score")
def stream_score(spark, sf_dir):
    return scored_stream(spark, sf_dir)


_COUNTED = ", ".join(f'CAST("{f}" AS DOUBLE) AS "{f}"' for f in _WATCHED)
_WATCHED_SQL = ", ".join(f'"{f}"' for f in _WATCHED)
define("watched", ["split"], f"""
    SELECT is_train, day, feature, value FROM (
      UNPIVOT (SELECT is_train, CAST(ts AS DATE) AS day, {_COUNTED} FROM split) ON {_WATCHED_SQL} INTO NAME feature VALUE value)""")
define("watched_days", ["watched"], """
    SELECT k.day, k.feature, v.value,
      (SELECT count(*) FROM split WHERE is_train) AS train_rows, k.n AS day_rows
    FROM (SELECT day, feature, count(*) AS n FROM watched GROUP BY 1, 2) k
    JOIN (SELECT DISTINCT feature, value FROM watched) v USING (feature)""")


@query("stream_drift", sql("watched_days split", f"""
    , a AS (SELECT feature, value, count(*) AS n FROM watched WHERE is_train GROUP BY 1, 2),
    b AS (SELECT day, feature, value, count(*) AS n FROM watched GROUP BY 1, 2, 3),
    c AS (SELECT d.day, d.feature, abs(sum(coalesce(a.n, 0)) OVER w / d.train_rows - sum(coalesce(b.n, 0)) OVER w / d.day_rows) AS gap
      FROM watched_days d LEFT JOIN a USING (feature, value) LEFT JOIN b USING (day, feature, value)
      WINDOW w AS (PARTITION BY d.day, d.feature ORDER BY d.value))
    SELECT CAST(day AS VARCHAR) AS day, feature, {r('max(gap)')} AS ks_statistic, CASE WHEN max(gap) > 0.1 THEN 'ALERT' ELSE 'PASS' END AS status
    FROM c GROUP BY 1, 2"""))
def stream_drift(spark, sf_dir):
    """Every day against the training rows; days still open when the input ends are closed by a batch pass."""
    source, out = new_path(spark, "stream_featured"), new_path(spark, "stream_drift")
    rows = inputs.model_table(spark, sf_dir).select("corridor", "ts", *_WATCHED)
    rows.write.parquet(source)
    training = monitoring.training_counts(inputs.model_table(spark, sf_dir), _WATCHED)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    monitoring.monitor_stream(stream, training, _WATCHED, out, new_path(spark, "stream_state")).awaitTermination()
    monitoring.close_days(rows, training, _WATCHED, out)
    return monitoring.daily_results(spark, out).select("day", "feature", "ks_statistic", "status")


#: Batches that arrive one after the other, each with days of all years, so that later ones come late.
_ARRIVALS = 3
_arrived: dict[tuple[str, str], tuple[str, str]] = {}


def _arrivals(spark, sf_dir):
    """(arrivals, merged table): the stream is stopped and merged after the first batch and again at the end."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _arrived:
        source, params, path, out, state = (new_path(spark, f"arrivals_{n}") for n in ("raw", "params", "rows", "merged", "state"))
        ingest.saved_params(inputs.cleaned(spark, sf_dir), inputs.first_rows(spark, sf_dir), params)
        medians = spark.read.parquet(f"{params}/medians")
        turn = F.coalesce(F.pmod(F.dayofmonth(C.parse_time(F.col("date_time"))), F.lit(_ARRIVALS)), F.lit(0))
        for number in range(_ARRIVALS):
            inputs.raw(spark, sf_dir).filter(turn == number).coalesce(1).write.mode("append").parquet(source)
            if number != 1:
                arrivals.arrive(ingest.raw_stream(spark, source, files_per_batch=1), path, state).awaitTermination()
                arrivals.merge(spark, path, out, medians)
        _arrived[key] = (path, out)
    return _arrived[key]


@query("stream_merge", sql("cleaned", f"""
    SELECT corridor, ts, {rounded('temp rain_1h')}, traffic_volume, weather_main, is_holiday FROM cleaned"""))
def stream_merge(spark, sf_dir):
    """Rows that came in three batches, most of them late, merged: the batch job's cleaned table."""
    return spark.read.parquet(_arrivals(spark, sf_dir)[1]).select("corridor", "ts", "temp", "rain_1h", "traffic_volume", "weather_main", "is_holiday")


@query("late_arrivals", sql("parsed", f"""
    , turns AS (SELECT ts, day(ts) % {_ARRIVALS} AS batch FROM parsed),
    seen AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM turns GROUP BY batch)
    SELECT batch, count(*) AS n_rows, count(*) FILTER (ts < latest - INTERVAL 1 DAY) AS n_late FROM turns JOIN seen USING (batch) GROUP BY batch"""))
def late_arrivals(spark, sf_dir):
    """Rows and late rows of every batch."""
    return arrivals.late_counts(spark, _arrivals(spark, sf_dir)[0])
