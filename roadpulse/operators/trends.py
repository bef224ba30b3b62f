"""Yearly totals and changes, holiday dates and temperatures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C


def in_years(first: int, last: int, ts: str = S.TS) -> Column:
    """A half-open time range: unlike a test on ``year(ts)``, it reaches the file reader."""
    def start(year: int) -> Column:
        return F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")

    return (F.col(ts) >= start(first)) & (F.col(ts) < start(last + 1))


def yearly_totals(hourly: DataFrame, first: int, last: int, ts: str = S.TS) -> DataFrame:
    return (
        hourly.filter(in_years(first, last, ts))
        .groupBy(F.year(ts).cast("bigint").alias("yr"))
        .agg(
            F.count(F.lit(1)).alias("recorded_hours"),
            F.sum("traffic_volume").alias("total_volume"),
            F.round(F.avg("traffic_volume"), 1).alias("avg_volume_per_hour"),
        )
    )


def yearly_trends(hourly: DataFrame, first: int, last: int) -> DataFrame:
    """Totals with change and percent change against the previous recorded year."""
    # One row per year of the given range: the unpartitioned window is tiny.
    by_year = Window.orderBy("yr")
    total, mean = F.col("total_volume"), F.col("avg_volume_per_hour")
    last_total, last_mean = F.lag(total).over(by_year), F.lag(mean).over(by_year)
    return (
        yearly_totals(hourly, first, last)
        .withColumns({
            "total_volume_change": total - last_total,
            "total_volume_pct_change": F.round(C.percent_change(total, last_total), 1),
            "avg_volume_change": F.round(mean - last_mean, 1),
            "avg_volume_pct_change": F.round(C.percent_change(mean, last_mean), 1),
        })
        .orderBy("yr")
    )


def coverage_extremes(yearly: DataFrame) -> DataFrame:
    """Years with fewest and most hours and with the highest mean; earliest on ties."""
    hours, mean, yr = F.col("recorded_hours"), F.col("avg_volume_per_hour"), F.col("yr")
    return yearly.agg(
        F.min_by(yr, F.struct(hours, yr)).alias("fewest_hours_year"),
        F.min(hours).alias("fewest_hours"),
        F.min_by(yr, F.struct(-hours, yr)).alias("most_hours_year"),
        F.max(hours).alias("most_hours"),
        F.min_by(yr, F.struct(-mean, yr)).alias("peak_mean_year"),
        F.max(mean).alias("peak_mean"),
    )


def named_holidays(df: DataFrame, names: Sequence[str], first: int, last: int, ts: str = S.TS) -> DataFrame:
    return df.filter(F.col("holiday").isin(list(names)) & in_years(first, last, ts))


def holiday_dates(
    df: DataFrame, first: int, last: int, names: Sequence[str] = tuple(S.HOLIDAY_NAMES), ts: str = S.TS
) -> DataFrame:
    """Date of each named holiday per year: at most ``names x years`` rows."""
    return (
        named_holidays(df, names, first, last, ts)
        .groupBy(F.year(ts).cast("bigint").alias("yr"), "holiday")
        .agg(F.min(F.to_date(ts)).alias("holiday_date"))
    )


def _temperatures() -> list[Column]:
    kelvin = F.avg("temp")
    return [
        F.round(kelvin, 2).alias("avg_temp_kelvin"),
        F.round(C.celsius(kelvin), 2).alias("avg_temp_celsius"),
        F.count(F.lit(1)).alias("hours_recorded"),
    ]


def holiday_day_temp(
    hourly: DataFrame,
    observations: DataFrame,
    first: int,
    last: int,
    names: Sequence[str] = tuple(S.HOLIDAY_NAMES),
    ts: str = S.TS,
) -> DataFrame:
    """Mean temperature per calendar day on which a named holiday was observed.

    A semi join on the day.  The holiday days are made distinct first: at most
    one per name and date, which keeps the broadcast small and proven.
    """
    days = named_holidays(observations, names, first, last, ts).select(F.to_date(ts).alias("holiday_date")).distinct()
    return (
        hourly.filter(in_years(first, last, ts))
        .withColumn("holiday_date", F.to_date(ts))
        .join(F.broadcast(days), "holiday_date", "left_semi")
        .groupBy("holiday_date")
        .agg(*_temperatures())
    )


def holiday_temperature(
    hourly: DataFrame,
    observations: DataFrame,
    first: int,
    last: int,
    names: Sequence[str] = tuple(S.HOLIDAY_NAMES),
    ts: str = S.TS,
) -> DataFrame:
    """Mean temperature of each named holiday and year, as one join for all of them."""
    dates = holiday_dates(observations, first, last, names, ts)
    return (
        hourly.filter(in_years(first, last, ts))
        .withColumn("holiday_date", F.to_date(ts))
        .drop("holiday")
        .join(F.broadcast(dates), "holiday_date")  # at most names x years rows
        .groupBy("holiday", "yr", "holiday_date")
        .agg(*_temperatures())
    )


def holiday_temp_change(temperatures: DataFrame) -> DataFrame:
    """First-to-last change per holiday seen in at least two years."""
    t = F.col("avg_temp_celsius")
    return (
        temperatures.groupBy("holiday")
        .agg(
            F.min("yr").alias("first_year"),
            F.min_by(t, "yr").alias("first_celsius"),
            F.max("yr").alias("last_year"),
            F.max_by(t, "yr").alias("last_celsius"),
            F.count(F.lit(1)).alias("_years"),
        )
        .filter("_years >= 2")
        .withColumn("change_celsius", F.round(F.col("last_celsius") - F.col("first_celsius"), 2))
        .drop("_years")
    )


def missing_years(
    dates: DataFrame, first: int, last: int, names: Sequence[str] = tuple(S.HOLIDAY_NAMES)
) -> DataFrame:
    """Expected ``(holiday, yr)`` pairs that were never observed."""
    expected = dates.sparkSession.range(first, last + 1).select(
        F.explode(F.array(*[F.lit(n) for n in names])).alias("holiday"), F.col("id").alias("yr")
    )
    return expected.join(dates.select("holiday", "yr"), ["holiday", "yr"], "left_anti")
