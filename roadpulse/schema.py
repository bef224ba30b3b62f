"""Column names, vocabularies and thresholds shared by every operator.

Operators take these as argument defaults, so a caller can override any of
them without touching this module.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. They have to match the published analysis for equal results.
# ---------------------------------------------------------------------------
RAW_COLUMNS = [
    "holiday", "temp", "rain_1h", "snow_1h", "clouds_all",
    "weather_main", "weather_description", "date_time", "traffic_volume",
]

WEATHER_VALUES = [
    "Clear", "Clouds", "Drizzle", "Fog", "Haze", "Mist",
    "Rain", "Smoke", "Snow", "Squall", "Thunderstorm",
]
SEVERE_WEATHER = ["Thunderstorm", "Snow", "Squall"]
LOW_VISIBILITY_WEATHER = ["Fog", "Mist", "Haze", "Smoke"]
WET_WEATHER = ["Rain", "Drizzle", "Snow", "Thunderstorm"]
WEATHER_SEVERITY = {
    "Clear": 0,
    "Clouds": 1,
    "Drizzle": 2, "Mist": 2, "Haze": 2,
    "Rain": 3, "Fog": 3, "Smoke": 3,
    "Snow": 4, "Thunderstorm": 4, "Squall": 4,
}

CONGESTION_LEVELS = ["Low", "Medium", "High", "Severe"]
DAY_TYPES = ["weekday", "weekend"]
HOLIDAY_NAMES = ["New Years Day", "Labor Day"]

CONGESTED_ABOVE = 5500
HOT_ABOVE_KELVIN = 292
IMPOSSIBLE_TEMP_KELVIN = 0
IMPLAUSIBLE_RAIN_MM = 9000
KELVIN_OFFSET = 273.15
TRAVEL_WINDOW = (6, 22)
TRAIN_SHARE = 0.8
LOOKBACK = 24
MIN_SUPPORT = 0.02
KS_ALERT_ABOVE = 0.10
ERROR_ALERT_ABOVE = 0.20

TIME_FEATURES = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_weekend"]
WEATHER_FEATURES = [f"weather_{w}" for w in WEATHER_VALUES] + [
    "is_severe_weather", "is_low_visibility", "has_precipitation",
]
FEATURES = TIME_FEATURES + WEATHER_FEATURES + ["is_holiday"]

# ---------------------------------------------------------------------------
# Table layout
# ---------------------------------------------------------------------------
# A series is identified by its corridor; data from one sensor carries a
# constant corridor.
KEY = ["corridor"]
TS = "ts"
VOLUME = "traffic_volume"

RAW_TYPES = {
    "holiday": T.StringType(),
    "temp": T.DoubleType(),
    "rain_1h": T.DoubleType(),
    "snow_1h": T.DoubleType(),
    "clouds_all": T.IntegerType(),
    "weather_main": T.StringType(),
    "weather_description": T.StringType(),
    "date_time": T.StringType(),
    "traffic_volume": T.LongType(),
}

RAW_SCHEMA = T.StructType(
    [T.StructField("corridor", T.IntegerType())]
    + [T.StructField(name, RAW_TYPES[name]) for name in RAW_COLUMNS]
)

SCENARIO_SCHEMA = T.StructType([
    T.StructField("hour", T.IntegerType()),
    T.StructField("day_type", T.StringType()),
    T.StructField("weather", T.StringType()),
    T.StructField("is_holiday", T.BooleanType()),
])


class SchemaError(ValueError):
    """The input lacks columns every later step relies on."""


def require_columns(columns, expected=tuple(RAW_COLUMNS)) -> None:
    """Raise :class:`SchemaError` before any job runs when a column is missing."""
    missing = [name for name in expected if name not in set(columns)]
    if missing:
        raise SchemaError(f"missing columns: {', '.join(missing)}")
