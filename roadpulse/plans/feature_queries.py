"""Features, series work and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.operators import features, metrics, series
from roadpulse.plans import inputs
from roadpulse.plans.oracle import r, rounded, sql
from roadpulse.plans.registry import query
from roadpulse.sources.storage import stage

_AT = "corridor, ts"
_ONE_HOT = [f"weather_{w}" for w in S.WEATHER_VALUES]
_QUOTED = ", ".join(f'"{c}"' for c in _ONE_HOT)


def _at(df, *columns):
    return df.select("corridor", "ts", *columns)


@query("column_subset", sql("cleaned", f"SELECT ts, corridor, weather_main, traffic_volume FROM cleaned"))
def column_subset(spark, sf_dir):
    return inputs.cleaned(spark, sf_dir).select("ts", "corridor", "weather_main", "traffic_volume")


@query("time_features", sql("timed", f"SELECT {_AT}, hour, day_of_week, is_weekend FROM timed"))
def time_features(spark, sf_dir):
    return _at(features.add_time_features(inputs.cleaned(spark, sf_dir)), "hour", "day_of_week", "is_weekend")


@query("cyclical_features", sql("timed", f"SELECT {_AT}, {rounded('hour_sin hour_cos dow_sin dow_cos')} FROM timed"))
def cyclical_features(spark, sf_dir):
    return _at(
        features.add_time_features(inputs.cleaned(spark, sf_dir)), "hour_sin", "hour_cos", "dow_sin", "dow_cos"
    )


@query("weather_one_hot", sql("timed", f"SELECT {_AT}, {_QUOTED} FROM timed"))
def weather_one_hot(spark, sf_dir):
    return _at(features.add_weather_features(inputs.cleaned(spark, sf_dir)), *_ONE_HOT)


@query("weather_flags", sql("timed", f"SELECT {_AT}, is_severe_weather, is_low_visibility, has_precipitation FROM timed"))
def weather_flags(spark, sf_dir):
    return _at(
        features.add_weather_flags(inputs.cleaned(spark, sf_dir)),
        "is_severe_weather", "is_low_visibility", "has_precipitation",
    )


@query("weather_severity", sql("cleaned", f"""
    SELECT {_AT}, CAST(CASE WHEN weather_main = 'Clear' THEN 0 WHEN weather_main = 'Clouds' THEN 1
      WHEN weather_main IN ('Drizzle', 'Mist', 'Haze') THEN 2 WHEN weather_main IN ('Rain', 'Fog', 'Smoke') THEN 3
      WHEN weather_main IN ('Snow', 'Thunderstorm', 'Squall') THEN 4 END AS BIGINT) AS weather_severity FROM cleaned"""))
def weather_severity(spark, sf_dir):
    return _at(inputs.cleaned(spark, sf_dir), C.severity(F.col("weather_main")).alias("weather_severity"))


@query("time_of_day", sql("timed", f"""
    SELECT {_AT}, CASE WHEN hour < 6 THEN 'Night' WHEN hour < 12 THEN 'Morning' WHEN hour < 18 THEN 'Afternoon' ELSE 'Evening' END AS time_of_day,
      CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type FROM timed"""))
def time_of_day(spark, sf_dir):
    weekend = C.is_weekend(F.col("ts")).cast("int")
    return _at(
        inputs.cleaned(spark, sf_dir),
        C.time_of_day(F.hour("ts")).alias("time_of_day"),
        C.day_type(weekend).alias("day_type"),
    )


@query("kelvin_to_celsius", sql("cleaned", f"SELECT {_AT}, round(temp - 273.15E0, 2) + 0E0 AS celsius FROM cleaned"))
def kelvin_to_celsius(spark, sf_dir):
    return _at(inputs.cleaned(spark, sf_dir), F.round(C.celsius(F.col("temp")), 2).alias("celsius"))


@query("volume_text", sql("traffic_hourly", """
    SELECT year(ts) AS yr, format('{:,}', CAST(sum(traffic_volume) AS BIGINT)) AS total_text,
      printf('%.1f', round(avg(traffic_volume), 1)) AS mean_text, printf('%+.2f', round(avg(temp) - 273.15E0, 2)) AS celsius_text
    FROM traffic_hourly GROUP BY 1"""))
def volume_text(spark, sf_dir):
    """Numbers as report text: thousands separators, fixed decimals, signs."""
    return inputs.hourly(spark, sf_dir).groupBy(F.year("ts").alias("yr")).agg(
        F.format_number(F.sum("traffic_volume"), 0).alias("total_text"),
        F.format_string("%.1f", F.round(F.avg("traffic_volume"), 1)).alias("mean_text"),
        F.format_string("%+.2f", F.round(C.celsius(F.avg("temp")), 2)).alias("celsius_text"),
    )


@query("minmax_scale", sql("featured", f"SELECT {_AT}, {rounded('temp_scaled clouds_all_scaled')} FROM featured"))
def minmax_scale(spark, sf_dir):
    return _at(features.add_scaled(inputs.cleaned(spark, sf_dir)), "temp_scaled", "clouds_all_scaled")


@query("volume_quartiles", sql("params", f"SELECT {rounded('q1 q2 q3')} FROM params"))
def volume_quartiles(spark, sf_dir):
    return features.volume_quartiles(inputs.cleaned(spark, sf_dir))


@query("fitted_params", sql("params", f"""
    SELECT {rounded('temp_min temp_max')}, CAST(clouds_min AS BIGINT) AS clouds_all_min,
      CAST(clouds_max AS BIGINT) AS clouds_all_max, {rounded('q1 q2 q3')} FROM params"""))
def fitted_params(spark, sf_dir):
    return features.fit_feature_params(inputs.cleaned(spark, sf_dir))


@query("congestion_category", sql("featured", f"SELECT {_AT}, traffic_volume, congestion_category FROM featured"))
def congestion_category(spark, sf_dir):
    return _at(
        features.add_congestion_category(inputs.cleaned(spark, sf_dir)), "traffic_volume", "congestion_category"
    )


@query("risk_label", sql("labelled", f"SELECT {_AT}, congestion_category, high_risk FROM labelled"))
def risk_label(spark, sf_dir):
    df = features.add_weather_flags(features.add_congestion_category(inputs.cleaned(spark, sf_dir)))
    return _at(features.add_risk_label(df), "congestion_category", "high_risk")


@query("engineer_features", sql("labelled", f"""
    SELECT {_AT}, holiday, {rounded('temp rain_1h snow_1h')}, CAST(clouds_all AS BIGINT) AS clouds_all, weather_main, weather_description,
      traffic_volume, is_holiday, hour, day_of_week, is_weekend, {rounded('hour_sin hour_cos dow_sin dow_cos')},
      {_QUOTED}, is_severe_weather, is_low_visibility, has_precipitation, {rounded('temp_scaled clouds_all_scaled')},
      congestion_category, high_risk FROM labelled"""))
def engineer_features(spark, sf_dir):
    """Step after step, independently of the stored featured table."""
    return features.add_risk_label(features.engineer(inputs.cleaned(spark, sf_dir)))


# -- series -----------------------------------------------------------------------
@query("chronological_split", sql("split", f"SELECT {_AT}, is_train FROM split"))
def chronological_split(spark, sf_dir):
    return series.chronological_split(inputs.cleaned(spark, sf_dir).select("corridor", "ts"))


@query("series_position", sql("split", f"SELECT {_AT}, position, series_rows FROM split"))
def series_position(spark, sf_dir):
    return series.with_position(inputs.cleaned(spark, sf_dir).select("corridor", "ts"))


@query("test_halves", sql("test_rows", f"SELECT {_AT}, CAST(half AS BIGINT) AS half FROM test_rows"))
def test_halves(spark, sf_dir):
    return series.split_halves(inputs.cleaned(spark, sf_dir).select("corridor", "ts")).drop("in_first_n")


_LAG_NAMES = ", ".join(f"lag_{k}" for k in range(1, S.LOOKBACK + 1))


@query("lag_features", sql("lagged", f"SELECT {_AT}, traffic_volume, {_LAG_NAMES} FROM lagged"))
def lag_features(spark, sf_dir):
    return series.lag_features(inputs.cleaned(spark, sf_dir).select("corridor", "ts", "traffic_volume"))


_SEQ = "list(traffic_volume) OVER (PARTITION BY corridor ORDER BY ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)"


@query("sequence_windows", sql("cleaned", f"""
    SELECT {_AT}, array_to_string(x, ',') AS x, CAST(traffic_volume AS DOUBLE) AS y
    FROM (SELECT {_AT}, traffic_volume, {_SEQ} AS x FROM cleaned) WHERE len(x) = 24"""))
def sequence_windows(spark, sf_dir):
    found = series.sequence_windows(inputs.cleaned(spark, sf_dir))
    as_text = F.array_join(F.transform("x", lambda v: v.cast("bigint").cast("string")), ",")
    return found.withColumn("x", as_text)


@query("train_only_norm", sql("lagged", f"""
    , placed AS (SELECT {_AT}, traffic_volume, lag_1, row_number() OVER (PARTITION BY corridor ORDER BY ts)
        <= floor(0.8E0 * count(*) OVER (PARTITION BY corridor)) AS is_train FROM lagged),
    k AS (SELECT avg(traffic_volume) AS m, stddev_pop(traffic_volume) AS s FROM placed WHERE is_train)
    SELECT {_AT}, is_train, {r('(traffic_volume - m) / s')} AS y_norm, {r('(lag_1 - m) / s')} AS last_norm,
      {r('((traffic_volume - m) / s) * s + m', 4)} AS y_back FROM placed, k"""))
def train_only_norm(spark, sf_dir):
    """Scale by the training part's mean and deviation, and back again."""
    sequences = series.sequence_windows(inputs.cleaned(spark, sf_dir))
    # Only the scaled columns are written; both the scale and the result read them.
    needed = sequences.select("corridor", "ts", "y", F.try_element_at("x", F.lit(-1)).alias("last"))
    cuts = series.written_cuts(inputs.cleaned(spark, sf_dir), {"train_end": series.share(S.TRAIN_SHARE, S.LOOKBACK)})
    placed = stage(needed, "sequences").join(cuts, "corridor", "left").withColumn(
        "is_train", F.coalesce(F.col("ts") <= F.col("train_end"), F.lit(False))
    )
    scale = series.train_scale(placed, "y")
    norm = C.ratio(F.col("y") - F.col("train_mean"), F.col("train_std"))
    last = C.ratio(F.col("last") - F.col("train_mean"), F.col("train_std"))
    return placed.crossJoin(F.broadcast(scale)).select(  # one row
        "corridor", "ts", "is_train", norm.alias("y_norm"), last.alias("last_norm"),
        F.round(norm * F.col("train_std") + F.col("train_mean"), 4).alias("y_back"),
    )


@query("naive_forecast", sql("lagged", f"""
    , t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY corridor ORDER BY ts)
        <= floor(0.8E0 * count(*) OVER (PARTITION BY corridor)) AS is_train FROM lagged) WHERE NOT is_train)
    SELECT {r('avg(abs(traffic_volume - lag_1))')} AS MAE,
      {r('1 - sum(power(traffic_volume - lag_1, 2)) / sum(power(traffic_volume - m, 2))')} AS R2, count(*) AS n, CAST(0 AS BIGINT) AS n_left_out
    FROM t, (SELECT avg(traffic_volume) AS m FROM t)"""))
def naive_forecast(spark, sf_dir):
    """The last value as the next one: the yardstick for the sequence models."""
    split = series.chronological_split(
        inputs.cleaned(spark, sf_dir).select("corridor", "ts", "traffic_volume"), skip=S.LOOKBACK
    )
    test = series.lag_features(split).filter("NOT is_train")
    return metrics.regression_metrics(test, "traffic_volume", "lag_1")


@query("drop_nulls", sql("cleaned", f"""
    SELECT {_AT}, holiday, traffic_volume FROM cleaned WHERE holiday IS NOT NULL"""))
def drop_nulls(spark, sf_dir):
    return _at(inputs.cleaned(spark, sf_dir), "holiday", "traffic_volume").na.drop(subset=["holiday"])


@query("distinct_on_subset", sql("parsed", """
    SELECT weather_main, holiday, min(corridor) AS corridor, min(ts) AS ts FROM (
      SELECT *, row_number() OVER (PARTITION BY weather_main, holiday ORDER BY corridor, ts) AS p FROM parsed) WHERE p = 1 GROUP BY 1, 2"""))
def distinct_on_subset(spark, sf_dir):
    from roadpulse.operators.cleaning import distinct_rows

    rows = inputs.parsed(spark, sf_dir).select("weather_main", "holiday", "corridor", "ts")
    return distinct_rows(rows, ["weather_main", "holiday"])


@query("hours_without_holiday", sql("parsed", """
    SELECT DISTINCT hour(ts) AS hour, weather_main FROM parsed
    EXCEPT SELECT hour(ts), weather_main FROM parsed WHERE holiday IS NOT NULL"""))
def hours_without_holiday(spark, sf_dir):
    """Set difference: situations never seen on a holiday."""
    df = inputs.parsed(spark, sf_dir).select(F.hour("ts").alias("hour"), "weather_main", "holiday")
    seen = df.select("hour", "weather_main").distinct()
    return seen.exceptAll(df.filter("holiday IS NOT NULL").select("hour", "weather_main").distinct())
