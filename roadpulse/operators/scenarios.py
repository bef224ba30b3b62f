"""Scenario requests: validation, feature rows, recommendations, batch scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.operators.features import add_cyclical

# A scenario names a day type, not a date: Wednesday and Saturday stand for it.
_DAY_FOR = {"weekday": 2, "weekend": 5}
# What a request asks; an answer depends on nothing else.
ASKED = ("hour", "day_type", "weather", "is_holiday")


def check_scenarios(df: DataFrame) -> DataFrame:
    """Fill optional fields and add ``reason``: NULL for a valid request."""
    hour, day_type, weather = F.col("hour"), F.col("day_type"), F.col("weather")
    return df.withColumns({
        "weather": F.coalesce(weather, F.lit("Clear")),
        "is_holiday": F.coalesce(F.col("is_holiday"), F.lit(False)),
    }).withColumn(
        "reason",
        F.when(hour.isNull() | ~hour.between(0, 23), "hour must be between 0 and 23")
        .when(day_type.isNull() | ~day_type.isin(S.DAY_TYPES), "day type must be weekday or weekend")
        .when(~weather.isin(S.WEATHER_VALUES), "unknown weather"),
    )


def valid_scenarios(df: DataFrame) -> DataFrame:
    return check_scenarios(df).filter("reason IS NULL").drop("reason")


def rejected_scenarios(df: DataFrame) -> DataFrame:
    return check_scenarios(df).filter("reason IS NOT NULL")


def scenario_features(df: DataFrame) -> DataFrame:
    """Model features of validated scenarios; a projection, so it also runs on a stream."""
    weekend = F.col("day_type") == "weekend"
    weather = F.col("weather")
    dated = df.withColumn(
        "day_of_week", F.when(weekend, _DAY_FOR["weekend"]).otherwise(_DAY_FOR["weekday"])
    )
    return (
        add_cyclical(dated)
        .withColumns({"is_weekend": weekend.cast("int"), "is_holiday": F.col("is_holiday").cast("int")})
        .withColumns(C.one_hot(weather))
        .withColumns({
            "is_severe_weather": C.is_severe(weather).cast("int"),
            "is_low_visibility": C.is_low_visibility(weather).cast("int"),
            "has_precipitation": C.expected_precipitation(weather).cast("int"),
        })
        .drop("day_of_week")
    )


def every_scenario(spark: SparkSession) -> DataFrame:
    """Every request that :func:`check_scenarios` lets pass, once: 24 hours x 2 day types x 11 kinds of weather x holiday or not."""
    rows = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    for name, values in (("day_type", S.DAY_TYPES), ("weather", S.WEATHER_VALUES), ("is_holiday", [False, True])):
        rows = rows.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return rows


def look_up(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Validated requests, each with the answers to what it asks; ``answers`` has a row for each of :func:`every_scenario`."""
    return requests.join(F.broadcast(answers), list(ASKED), "left")  # 1,056 rows


def all_hours(scenarios: DataFrame) -> DataFrame:
    """Each scenario at each hour of the day, by a generator instead of a join."""
    return scenarios.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))


def scenario_grid(scenarios: DataFrame) -> DataFrame:
    return scenario_features(all_hours(scenarios))


def best_windows(
    predicted: DataFrame,
    scenario: Sequence[str] = ("day_type", "weather", "is_holiday"),
    n: int = 3,
    allow_overnight: bool = False,
    prediction: str = "predicted_volume",
) -> DataFrame:
    """The n hours with the lowest predicted volume per scenario; earlier hour on ties."""
    candidates = predicted if allow_overnight else predicted.filter(C.in_travel_window(F.col("hour")))
    order = Window.partitionBy(*scenario).orderBy(prediction, "hour")  # 24 rows per scenario
    return (
        candidates.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= n)
        .select(*scenario, "place", "hour", F.round(prediction, 0).alias(prediction))
    )


def _advice(situation: Column, hour: Column, volume: Column) -> Column:
    return F.concat(
        F.lit("Quietest hour for a "), situation, F.lit(": "), C.clock(hour), F.lit("-"), C.clock((hour + 1) % 24),
        F.lit(", about "), F.round(volume, 0).cast("bigint").cast("string"), F.lit(" vehicles"),
    )


def recommendation_messages(windows: DataFrame) -> DataFrame:
    """One sentence per scenario, from its best window."""
    holiday = F.when(F.col("is_holiday").cast("boolean"), " holiday").otherwise("")
    situation = F.concat(F.col("day_type"), holiday, F.lit(" trip in weather "), F.col("weather"))
    return windows.filter("place = 1").select(
        "day_type", "weather", "is_holiday", _advice(situation, F.col("hour"), F.col("predicted_volume")).alias("message")
    )


def history_messages(quietest: DataFrame) -> DataFrame:
    """One sentence per day type from its historically quietest hour."""
    situation = F.concat(F.col("day_type"), F.lit(" trip"))
    return quietest.filter("place = 1").select(
        "day_type", _advice(situation, F.col("hour"), F.col("mean_volume")).alias("message")
    )
