"""Mean-volume profiles, day-type comparison and history-based travel advice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C


def mean_volume(df: DataFrame, by: Sequence[str], volume: str = S.VOLUME) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(volume).alias("mean_volume"), F.count(volume).alias("n"))


def hourly_profile(df: DataFrame) -> DataFrame:
    return mean_volume(df, ["hour"])


def hour_by_day_type(df: DataFrame, volume: str = S.VOLUME) -> DataFrame:
    """Hours as rows, weekday and weekend means as columns."""
    return (
        df.groupBy("hour")
        .pivot("is_weekend", [0, 1])
        .agg(F.avg(volume))
        .withColumnsRenamed({"0": "weekday", "1": "weekend"})
    )


def peak_hour(df: DataFrame) -> DataFrame:
    """Hour with the highest and the lowest mean; the earlier hour on ties."""
    mean, hour = F.col("mean_volume"), F.col("hour")
    return hourly_profile(df).agg(
        F.min_by(hour, F.struct(-mean, hour)).alias("peak_hour"),
        F.max(mean).alias("peak_mean"),
        F.min_by(hour, F.struct(mean, hour)).alias("quietest_hour"),
        F.min(mean).alias("quietest_mean"),
    )


def weather_profile(df: DataFrame) -> DataFrame:
    return mean_volume(df, ["weather_main"]).orderBy(F.desc("mean_volume"), "weather_main")


def weather_spread(df: DataFrame) -> DataFrame:
    mean, name = F.col("mean_volume"), F.col("weather_main")
    return mean_volume(df, ["weather_main"]).agg(
        F.min_by(name, F.struct(-mean, name)).alias("highest"),
        F.min_by(name, F.struct(mean, name)).alias("lowest"),
        (F.max(mean) - F.min(mean)).alias("spread"),
    )


def weekday_vs_weekend(df: DataFrame, volume: str = S.VOLUME) -> DataFrame:
    weekday = F.avg(F.when(F.col("is_weekend") == 0, F.col(volume)))
    weekend = F.avg(F.when(F.col("is_weekend") == 1, F.col(volume)))
    means = df.agg(weekday.alias("weekday_mean"), weekend.alias("weekend_mean"))
    return means.withColumns({
        "difference": F.col("weekday_mean") - F.col("weekend_mean"),
        "percent_of_weekend": C.percent_change(F.col("weekday_mean"), F.col("weekend_mean")),
    })


def top_hours(df: DataFrame, n: int = 5) -> DataFrame:
    """The n busiest hours of the day."""
    if n <= 0:
        raise ValueError("n must be a positive integer")
    return hourly_profile(df).orderBy(F.desc("mean_volume"), "hour").limit(n)


def travel_hours(df: DataFrame, allow_overnight: bool = False) -> DataFrame:
    return df if allow_overnight else df.filter(C.in_travel_window(F.col("hour")))


def quietest_hours(df: DataFrame, n: int = 3, allow_overnight: bool = False) -> DataFrame:
    """The n historically quietest hours for each day type."""
    means = mean_volume(travel_hours(df, allow_overnight), ["is_weekend", "hour"])
    # At most 24 rows per day type.
    order = Window.partitionBy("is_weekend").orderBy("mean_volume", "hour")
    return (
        means.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= n)
        .select(
            C.day_type(F.col("is_weekend"), S.DAY_TYPES).alias("day_type"),
            "place",
            "hour",
            ((F.col("hour") + 1) % 24).alias("until_hour"),
            "mean_volume",
        )
    )


def category_counts(df: DataFrame, column: str = "congestion_category") -> DataFrame:
    """Rows per level in the order Low to Severe, with the level's share."""
    levels = F.create_map(*[x for i, v in enumerate(S.CONGESTION_LEVELS) for x in (F.lit(v), F.lit(i))])
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    # One row per level.
    return counts.select(
        F.try_element_at(levels, F.col(column)).alias("position"),
        column,
        "n",
        C.ratio(F.col("n"), F.sum("n").over(Window.partitionBy())).alias("share"),
    ).orderBy("position")


def label_balance(df: DataFrame, label: str = "high_risk") -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("proportion", C.ratio(F.col("n"), F.sum("n").over(Window.partitionBy())))
