"""A raw observation table derived from the line-item table.

The sensor CSV is not distributed, so queries run on a deterministic view with
the same columns, defects (zero temperatures, absurd rain, malformed times,
repeated hours) and vocabularies.  Every value is a narrow projection of the
scan, so the view adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_readers: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its footer is read once per application."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _readers:
        _readers[key] = spark.read.parquet(path)
    return _readers[key].select("*")


def _weather(bucket: Column) -> Column:
    shares = [
        (33, "Clear"), (64, "Clouds"), (76, "Rain"), (83, "Mist"), (88, "Snow"),
        (92, "Drizzle"), (95, "Haze"), (97, "Thunderstorm"), (98, "Fog"), (99, "Smoke"),
    ]
    value = F
    for upper, label in shares:
        value = value.when(bucket < upper, label)
    return value.otherwise("Squall")


def _holiday(day: Column) -> Column:
    month, dom, monday = F.month(day), F.dayofmonth(day), F.weekday(day) == 0
    return (
        F.when((month == 1) & (dom == 1), "New Years Day")
        .when((month == 9) & (dom <= 7) & monday, "Labor Day")
        .when((month == 7) & (dom == 4), "Independence Day")
        .when((month == 12) & (dom == 25), "Christmas Day")
        .otherwise("None")
    )


def traffic_raw(
    spark: SparkSession,
    sf_dir: str,
    first_year: int | None = None,
    last_year: int | None = None,
) -> DataFrame:
    """Raw observations; a year range is applied to the scanned date column.

    The observation day *is* the ship date, so a range on years reaches the
    parquet reader as a range on ``l_shipdate`` and skips row groups.
    """
    lines = table(spark, sf_dir, "lineitem")
    if first_year is not None:
        lines = lines.filter(F.col("l_shipdate") >= F.lit(f"{first_year}-01-01").cast("timestamp_ntz"))
    if last_year is not None:
        lines = lines.filter(F.col("l_shipdate") < F.lit(f"{last_year + 1}-01-01").cast("timestamp_ntz"))

    lines = lines.select("l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    order, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    base = lines.select(
        F.col("l_shipdate").cast("date").alias("d"),
        (order % 24).cast("int").alias("h"),
        (F.col("l_suppkey") % 4).cast("int").alias("corridor"),
        order.alias("ok"),
        part.alias("pk"),
        line.alias("ln"),
        _weather((part * 31 + line) % 100).alias("weather_main"),
    )
    d, h, ok, pk = F.col("d"), F.col("h"), F.col("ok"), F.col("pk")
    weather = F.col("weather_main")
    weekend = F.weekday(d) >= 5
    from_three = F.abs(h - 15)
    return base.select(
        "corridor",
        _holiday(d).alias("holiday"),
        F.when(ok % 997 == 3, 0.0)
        .otherwise(265.0 + 4 * (6 - F.abs(F.month(d) - 7)) + (pk % 10) * 0.5)
        .alias("temp"),
        F.when(ok % 4999 == 7, 9831.25)
        .when(weather.isin("Rain", "Drizzle", "Thunderstorm"), (pk % 40) * 0.25)
        .otherwise(0.0)
        .alias("rain_1h"),
        F.when(weather == "Snow", (pk % 8) * 0.0625).otherwise(0.0).alias("snow_1h"),
        ((pk * 7) % 101).cast("int").alias("clouds_all"),
        "weather_main",
        F.when((weather == "Clear") & (F.col("ln") % 2 == 0), "Sky is Clear")
        .when(weather == "Clear", " sky is clear")
        .when(weather == "Squall", "SQUALLS")
        .otherwise(F.lower(weather))
        .alias("weather_description"),
        F.when(ok % 1999 == 11, "not-a-date")
        .otherwise(F.concat(d.cast("string"), F.lit(" "), F.lpad(h.cast("string"), 2, "0"), F.lit(":00:00")))
        .alias("date_time"),
        (
            300
            + F.when(weekend, 250).otherwise(400) * F.when(from_three < 12, 12 - from_three).otherwise(0)
            + ((F.year(d) * 372 + F.month(d) * 31 + F.dayofmonth(d)) * 37 + h * 101 + F.col("corridor") * 53) % 1500
        ).cast("bigint").alias("traffic_volume"),
    )
