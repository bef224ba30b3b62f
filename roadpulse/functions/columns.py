"""Scalar expressions: every one is a built-in Column, none is a Python UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse import schema as S

_BLANKS = " \t\n\r\f\v"


def strip(text: Column) -> Column:
    """Drop all leading and trailing white space, not just blanks."""
    return F.trim(text, F.lit(_BLANKS))


def clean_description(text: Column) -> Column:
    return F.lower(strip(text))


def clean_holiday(name: Column) -> Column:
    """Holiday name, or NULL for an ordinary day."""
    return F.nullif(strip(name), F.lit("None"))


def parse_time(text: Column) -> Column:
    """Zone-free timestamp; NULL for malformed text instead of an error."""
    return text.try_cast("timestamp_ntz")


def seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-free timestamp, whatever the session zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def event_time(ts: Column) -> Column:
    """An instant for watermarks, which need one; reads the zone-free time as UTC."""
    return F.timestamp_seconds(seconds(ts))


def celsius(kelvin: Column) -> Column:
    return kelvin - S.KELVIN_OFFSET


# -- time ------------------------------------------------------------------
def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return day_of_week(ts).isin(5, 6)


def on_circle(position: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position on a repeating scale."""
    angle = F.lit(2) * F.pi() * position / period
    return F.sin(angle), F.cos(angle)


def time_of_day(hour: Column) -> Column:
    return (
        F.when(hour < 6, "Night").when(hour < 12, "Morning").when(hour < 18, "Afternoon").otherwise("Evening")
    )


def day_type(weekend_flag: Column, labels: Sequence[str] = ("Weekday", "Weekend")) -> Column:
    return F.when(weekend_flag == 1, labels[1]).otherwise(labels[0])


def in_travel_window(hour: Column, window: tuple[int, int] = S.TRAVEL_WINDOW) -> Column:
    return hour.between(*window)


def clock(hour: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


# -- weather ---------------------------------------------------------------
def is_severe(weather: Column) -> Column:
    return F.coalesce(weather.isin(S.SEVERE_WEATHER), F.lit(False))


def is_low_visibility(weather: Column) -> Column:
    return F.coalesce(weather.isin(S.LOW_VISIBILITY_WEATHER), F.lit(False))


def measured_precipitation(rain: Column, snow: Column) -> Column:
    """Training-time flag: something was measured in the gauge."""
    return F.coalesce(rain > 0, F.lit(False)) | F.coalesce(snow > 0, F.lit(False))


def expected_precipitation(weather: Column) -> Column:
    """Scoring-time flag: a scenario has a weather name but no gauge.

    Deliberately different from :func:`measured_precipitation`; the two are
    not interchangeable.
    """
    return weather.isin(S.WET_WEATHER)


def severity(weather: Column, scale: Mapping[str, int] = S.WEATHER_SEVERITY) -> Column:
    """Ordinal 0-4; NULL for a name outside the scale."""
    lookup = F.create_map(*[F.lit(x) for pair in scale.items() for x in pair])
    return F.try_element_at(lookup, weather)


def one_hot(weather: Column, values: Sequence[str] = S.WEATHER_VALUES) -> dict[str, Column]:
    return {f"weather_{v}": F.coalesce(weather == v, F.lit(False)).cast("int") for v in values}


# -- traffic ---------------------------------------------------------------
def congestion_category(volume: Column, q1: Column, q2: Column, q3: Column) -> Column:
    """Right-closed quartile bands."""
    low, medium, high, top = S.CONGESTION_LEVELS
    return F.when(volume <= q1, low).when(volume <= q2, medium).when(volume <= q3, high).otherwise(top)


def high_risk(category: Column, severe_flag: Column, low_visibility_flag: Column) -> Column:
    busy = category.isin("High", "Severe")
    return busy & ((severe_flag == 1) | (low_visibility_flag == 1))


# -- report wording ---------------------------------------------------------
def correlation_strength(r: Column) -> Column:
    # Names and limits of the bands.
    size = F.abs(r)
    return (
        F.when(r.isNull(), None)
        .when(size < 0.1, "negligible")
        .when(size < 0.3, "weak")
        .when(size < 0.5, "moderate")
        .when(size < 0.7, "strong")
        .otherwise("very strong")
    )


def cluster_label(hour: Column, weather_severity: Column, volume: Column) -> Column:
    """Name a cluster from its mean hour, severity and volume."""
    # Names and limits of the bands.
    when = (
        F.when((hour < 6) | (hour > 21), "overnight/off-peak")
        .when(hour < 16, "daytime/commute-adjacent")
        .otherwise("evening peak")
    )
    weather = (
        F.when(weather_severity < 1, "clear/mild")
        .when(weather_severity < 2, "cloudy")
        .when(weather_severity < 3, "wet/reduced-visibility")
        .otherwise("severe weather")
    )
    traffic = F.when(volume < 2000, "low").when(volume < 4500, "moderate").otherwise("high")
    mean = F.concat(F.round(volume, 0).cast("bigint").cast("string"), F.lit(" vehicles an hour"))
    return F.concat_ws("; ", when, weather, F.concat(traffic, F.lit(" volume, "), mean))


def alert(flag: Column) -> Column:
    return F.when(flag, "ALERT").otherwise("PASS")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL, not an error, for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent_change(now: Column, before: Column) -> Column:
    return ratio(100.0 * (now - before), before)
