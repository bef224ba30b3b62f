"""Model features: projections plus a few fitted scalars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.operators.ranks import column_quantiles

SCALED = ("temp", "clouds_all")
QUARTILES = {"q1": 0.25, "q2": 0.5, "q3": 0.75}


def add_time_features(df: DataFrame, ts: str = S.TS) -> DataFrame:
    df = df.withColumns({
        "hour": F.hour(ts),
        "day_of_week": C.day_of_week(F.col(ts)),
        "is_weekend": C.is_weekend(F.col(ts)).cast("int"),
    })
    return add_cyclical(df)


def add_cyclical(df: DataFrame) -> DataFrame:
    hour_sin, hour_cos = C.on_circle(F.col("hour"), 24)
    dow_sin, dow_cos = C.on_circle(F.col("day_of_week"), 7)
    return df.withColumns({"hour_sin": hour_sin, "hour_cos": hour_cos, "dow_sin": dow_sin, "dow_cos": dow_cos})


def add_weather_flags(df: DataFrame) -> DataFrame:
    weather = F.col("weather_main")
    return df.withColumns({
        "is_severe_weather": C.is_severe(weather).cast("int"),
        "is_low_visibility": C.is_low_visibility(weather).cast("int"),
        "has_precipitation": C.measured_precipitation(F.col("rain_1h"), F.col("snow_1h")).cast("int"),
    })


def add_weather_features(df: DataFrame) -> DataFrame:
    """Fixed one-hot columns (no pivot, so no shuffle) and the derived flags."""
    return add_weather_flags(df.withColumns(C.one_hot(F.col("weather_main"))))


def value_bounds(df: DataFrame, columns: Sequence[str] = SCALED) -> DataFrame:
    return df.agg(*[f(c).alias(f"{c}_{f.__name__}") for c in columns for f in (F.min, F.max)])


def minmax(column: str) -> Column:
    low, high = F.col(f"{column}_min"), F.col(f"{column}_max")
    return C.ratio(F.col(column) - low, high - low)


def add_scaled(df: DataFrame, bounds: DataFrame | None = None, columns: Sequence[str] = SCALED) -> DataFrame:
    """Min-max scaling to [0, 1]; NULL for a constant column."""
    bounds = value_bounds(df, columns) if bounds is None else bounds
    return (
        df.crossJoin(F.broadcast(bounds))  # one row
        .withColumns({f"{c}_scaled": minmax(c) for c in columns})
        .drop(*[f"{c}_{end}" for c in columns for end in ("min", "max")])
    )


def volume_quartiles(df: DataFrame, volume: str = S.VOLUME) -> DataFrame:
    return column_quantiles(df, volume, QUARTILES)


def add_congestion_category(
    df: DataFrame, quartiles: DataFrame | None = None, volume: str = S.VOLUME
) -> DataFrame:
    quartiles = volume_quartiles(df, volume) if quartiles is None else quartiles
    return (
        df.crossJoin(F.broadcast(quartiles))  # one row
        .withColumn(
            "congestion_category",
            C.congestion_category(F.col(volume), F.col("q1"), F.col("q2"), F.col("q3")),
        )
        .drop(*QUARTILES)
    )


def add_risk_label(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "high_risk",
        C.high_risk(
            F.col("congestion_category"), F.col("is_severe_weather"), F.col("is_low_visibility")
        ).cast("int"),
    )


def fit_feature_params(cleaned: DataFrame) -> DataFrame:
    """The scalars :func:`engineer` needs, as one row that can be saved and reused."""
    return value_bounds(cleaned).crossJoin(F.broadcast(volume_quartiles(cleaned)))


def engineer(cleaned: DataFrame, params: DataFrame | None = None) -> DataFrame:
    """All features; pass saved ``params`` to score a stream or a later batch."""
    bounds = quartiles = None
    if params is not None:
        bounds = params.select(*[f"{c}_{end}" for c in SCALED for end in ("min", "max")])
        quartiles = params.select(*QUARTILES)
    df = add_weather_features(add_time_features(cleaned))
    return add_congestion_category(add_scaled(df, bounds), quartiles)
