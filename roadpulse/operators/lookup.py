"""Nearest observation to a requested time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C

TOLERANCE_SECONDS = 3600


def parse_requests(df: DataFrame, column: str = "requested", into: str = "target") -> tuple[DataFrame, DataFrame]:
    """Split requests into parsed ones and rejected ones with a reason."""
    parsed = df.withColumn(into, C.parse_time(F.col(column)))
    good = parsed.filter(F.col(into).isNotNull())
    bad = parsed.filter(F.col(into).isNull()).drop(into).withColumn("reason", F.lit("not a valid date/time"))
    return good, bad


def _gap(a: Column, b: Column) -> Column:
    return F.abs(C.seconds(a) - C.seconds(b))


def nearest_record(
    series: DataFrame,
    requests: DataFrame,
    payload: Sequence[str],
    key: Sequence[str] = tuple(S.KEY),
    ts: str = S.TS,
    target: str = "target",
    tolerance: int = TOLERANCE_SECONDS,
) -> DataFrame:
    """One row per distinct requested time with the closest observation.

    The earlier observation wins a tie.  ``far`` marks answers more than the
    tolerance away; ``n_requests`` says how often the time was asked for, so a
    time asked for by a third of the requests still is one row.

    Requests and observations meet in ``(key, day)`` groups, as bare times.
    Answers across a gap of days come from each day's first and last
    observation, carried over the short list of days; no corridor is ever
    sorted as a whole.  The payload joins last, to the chosen times only.
    ``series`` holds one row per ``(key, ts)``.
    """
    key = list(key)
    asked = requests.groupBy(F.col(target).alias("_t"), *key).agg(F.count(F.lit(1)).alias("n_requests"))
    observed = series.select(F.col(ts).alias("_t"), *key, F.lit(None).cast("bigint").alias("n_requests"))
    is_request = F.col("n_requests").isNotNull()
    both = observed.unionByName(asked).withColumns({
        "_day": F.to_date("_t"), "_seen": F.when(~is_request, F.col("_t")),
    })

    days = both.groupBy("_day", *key).agg(F.min("_seen").alias("_first"), F.max("_seen").alias("_last"))
    by_day = Window.partitionBy(*key)
    past = by_day.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    future = by_day.orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select(
        *key, "_day", F.max("_last").over(past).alias("_past"), F.min("_first").over(future).alias("_future")
    )

    # At one time the observation sorts ahead of the request in both directions.
    in_day = Window.partitionBy("_day", *key)
    upto = in_day.orderBy("_t", is_request).rowsBetween(Window.unboundedPreceding, 0)
    after = in_day.orderBy(F.desc("_t"), is_request).rowsBetween(Window.unboundedPreceding, 0)
    answered = (
        both.join(carried, ["_day", *key])
        .withColumn("_before", F.coalesce(F.max("_seen").over(upto), F.col("_past")))
        .withColumn("_after", F.coalesce(F.min("_seen").over(after), F.col("_future")))
        .filter(is_request)
    )
    gap_before, gap_after = _gap(F.col("_before"), F.col("_t")), _gap(F.col("_after"), F.col("_t"))
    use_before = F.col("_after").isNull() | (gap_before <= gap_after)
    chosen = answered.select(
        *key,
        F.col("_t").alias(target),
        "n_requests",
        F.when(use_before, F.col("_before")).otherwise(F.col("_after")).alias("nearest_ts"),
    ).withColumn("seconds_off", _gap(F.col("nearest_ts"), F.col(target)))
    found = series.select(*key, F.col(ts).alias("nearest_ts"), *payload)
    return chosen.join(found, [*key, "nearest_ts"], "left").select(
        *key, target, "n_requests", "nearest_ts", *payload, "seconds_off", (F.col("seconds_off") > tolerance).alias("far")
    )
