"""Cleaning: wording, times, repeated rows, impossible readings, audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.operators.ranks import column_quantiles

# Order that decides which of several rows for one hour counts as the first.
# File order does not exist on a cluster, so the rows' own content decides.
FIRST_BY = [
    "holiday", "temp", "rain_1h", "snow_1h", "clouds_all",
    "weather_main", "weather_description", "traffic_volume",
]


def standardise_text(df: DataFrame) -> DataFrame:
    """Unify description case and spacing; holiday NULL on ordinary days."""
    return (
        df.withColumn("weather_description", C.clean_description(F.col("weather_description")))
        .withColumn("holiday", C.clean_holiday(F.col("holiday")))
        .withColumn("is_holiday", F.col("holiday").isNotNull())
    )


def parse_times(df: DataFrame, column: str = "date_time", into: str = S.TS) -> DataFrame:
    """Replace the text time by a timestamp, dropping malformed rows.

    The parsed value passes through a one-element ``explode``: filters on it
    then read the parsed column instead of being rewritten to parse the text
    again, once per filter.
    """
    parsed = F.explode(F.array(C.parse_time(F.col(column))))
    return df.select("*", parsed.alias(into)).filter(F.col(into).isNotNull()).drop(column)


def hourly_from_raw(raw: DataFrame) -> DataFrame:
    """The hourly view straight from raw rows; unused columns are pruned from it."""
    return hourly_min(parse_times(raw.withColumn("holiday", C.clean_holiday(F.col("holiday")))))


def hourly_min(df: DataFrame, key: Sequence[str] = tuple(S.KEY), ts: str = S.TS) -> DataFrame:
    """One row per hour holding each column's own minimum.

    The result may combine values of different rows; use
    :func:`keep_first` where rows must stay whole.
    """
    # Times vary more than corridors: leading with them makes sorts cheaper.
    return df.groupBy(ts, *key).agg(
        F.min("traffic_volume").alias("traffic_volume"),
        F.min("temp").alias("temp"),
        F.min("holiday").alias("holiday"),
        F.min("weather_main").alias("weather_main"),
    )


def keep_first(
    df: DataFrame,
    key: Sequence[str] = (S.TS, *S.KEY),
    first_by: Sequence[str] = tuple(FIRST_BY),
) -> DataFrame:
    """One whole row per key: the first in the stated order.

    Exact copies collapse on the way.  ``row_number() = 1`` plans a group limit
    ahead of the shuffle, so every map task forwards at most one row per key
    and an hour repeated in a third of the table does not end up in one task.
    The key column with the most values comes first; sorts compare it first.
    """
    rest = [c for c in df.columns if c not in key]
    ordered = [c for c in first_by if c in rest] + [c for c in rest if c not in first_by]
    window = Window.partitionBy(*key).orderBy(*ordered)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def distinct_rows(df: DataFrame, on: Sequence[str] | None = None) -> DataFrame:
    """Whole-row distinct, or one row per subset of columns by :func:`keep_first`."""
    return df.dropDuplicates() if on is None else keep_first(df, on, [c for c in df.columns if c not in on])


def invalid_temp(column: str = "temp", lowest: float = S.IMPOSSIBLE_TEMP_KELVIN) -> Column:
    return F.coalesce(F.col(column) <= lowest, F.lit(False))


def invalid_rain(column: str = "rain_1h", highest: float = S.IMPLAUSIBLE_RAIN_MM) -> Column:
    return F.coalesce(F.col(column) > highest, F.lit(False))


def monthly_medians(df: DataFrame, column: str, invalid: Column, ts: str = S.TS) -> DataFrame:
    """Median of the valid readings per calendar month, pooled over years."""
    valid = df.filter(~invalid).select(F.month(ts).alias("month"), column)
    return column_quantiles(valid, column, {f"{column}_median": 0.5}, by=["month"], few_groups=True)


def impute_monthly_median(
    df: DataFrame, column: str, invalid: Column, medians: DataFrame | None = None, ts: str = S.TS
) -> DataFrame:
    """Replace invalid readings by their month's median.

    A month without valid readings has no median and keeps its values.
    """
    if medians is None:
        medians = monthly_medians(df, column, invalid, ts)
    median = f"{column}_median"
    # One row per calendar month: never more than twelve.
    return (
        df.withColumn("month", F.month(ts))
        .join(F.broadcast(medians), "month", "left")
        .withColumn(column, F.when(invalid, F.coalesce(F.col(median), F.col(column))).otherwise(F.col(column)))
        .drop("month", median)
    )


def repair_readings(df: DataFrame, ts: str = S.TS) -> DataFrame:
    df = impute_monthly_median(df, "temp", invalid_temp(), ts=ts)
    return impute_monthly_median(df, "rain_1h", invalid_rain(), ts=ts)


def clean(raw: DataFrame) -> DataFrame:
    """All steps: wording, times, one row per hour, impossible readings."""
    return repair_readings(keep_first(parse_times(standardise_text(raw))))


def clean_audit(raw: DataFrame) -> DataFrame:
    """What each cleaning step touched: ``(step, rows_before, rows_after, rows_affected)``."""
    marked = standardise_text(raw.withColumn("_was", F.col("weather_description")))
    text = marked.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(~F.col("_was").eqNullSafe(F.col("weather_description"))).alias("text_changed"),
        F.count_if("is_holiday").alias("holiday_rows"),
        F.count_if(C.parse_time(F.col("date_time")).isNull()).alias("bad_times"),
    )
    parsed = parse_times(marked.drop("_was"))
    # The distinct rows serve both the copy count and the choice of first rows.
    copies = parsed.groupBy(*parsed.columns).agg(F.count(F.lit(1)).alias("copies"))
    repeats = copies.agg(F.sum("copies").alias("parsed_rows"), F.count(F.lit(1)).alias("distinct_rows"))
    first = keep_first(copies.drop("copies"))
    month = F.month(S.TS)
    by_month = first.groupBy(month.alias("month")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(invalid_temp()).alias("bad_temp"),
        F.count_if(~invalid_temp() & F.col("temp").isNotNull()).alias("good_temp"),
        F.count_if(invalid_rain()).alias("bad_rain"),
        F.count_if(~invalid_rain() & F.col("rain_1h").isNotNull()).alias("good_rain"),
    )
    readings = by_month.agg(
        F.sum("rows").alias("hours"),
        F.sum(F.when(F.col("good_temp") > 0, F.col("bad_temp")).otherwise(0)).alias("temp_imputed"),
        F.sum(F.when(F.col("good_rain") > 0, F.col("bad_rain")).otherwise(0)).alias("rain_imputed"),
    )
    # Three one-row results side by side.
    row = text.crossJoin(F.broadcast(repeats)).crossJoin(F.broadcast(readings))
    steps = [
        ("standardise_text", "raw_rows", "raw_rows", F.col("text_changed")),
        ("flag_holidays", "raw_rows", "raw_rows", F.col("holiday_rows")),
        ("parse_times", "raw_rows", "parsed_rows", F.col("bad_times")),
        ("drop_exact_copies", "parsed_rows", "distinct_rows", F.col("parsed_rows") - F.col("distinct_rows")),
        ("keep_first_per_hour", "distinct_rows", "hours", F.col("distinct_rows") - F.col("hours")),
        ("impute_temp", "hours", "hours", F.col("temp_imputed")),
        ("impute_rain", "hours", "hours", F.col("rain_imputed")),
    ]
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("step"),
            F.col(before).cast("bigint").alias("rows_before"),
            F.col(after).cast("bigint").alias("rows_after"),
            affected.cast("bigint").alias("rows_affected"),
        )
        for i, (name, before, after, affected) in enumerate(steps, 1)
    ]
    return row.select(F.inline(F.array(*entries)))
