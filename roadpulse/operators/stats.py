"""Descriptive statistics, correlation, trend line, histogram."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.functions.significance import pearson_p_value
from roadpulse.operators.ranks import quantiles, value_counts


def plausible_temp(df: DataFrame, column: str = "temp") -> DataFrame:
    """Without the sensor-error rows at zero kelvin."""
    return df.filter(F.col(column) > S.IMPOSSIBLE_TEMP_KELVIN)


def descriptive_stats(df: DataFrame, value: str = S.VOLUME) -> DataFrame:
    """Mean, median, sample deviation and variance, range and count as one row.

    Everything derives from the counts per distinct value, so the rows are
    read once.
    """
    counts = value_counts(df, value)
    v, n = F.col(value), F.col("n")
    sums = counts.agg(
        F.sum("n").alias("_n"),
        (F.sum(v * n) / F.sum("n")).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        (F.max(value) - F.min(value)).alias("range"),
    )
    scatter = counts.crossJoin(F.broadcast(sums)).agg(  # one row
        F.max("_n").alias("n"),
        F.max("mean").alias("mean"),
        C.ratio(F.sum((v - F.col("mean")) * (v - F.col("mean")) * n), F.max("_n") - 1).alias("variance"),
        *[F.max(c).alias(c) for c in ("min", "max", "range")],
    )
    median = quantiles(counts, value, {"median": 0.5})
    return scatter.withColumn("std", F.sqrt("variance")).crossJoin(F.broadcast(median))  # one row


def spread_notes(stats: DataFrame) -> DataFrame:
    """Coefficient of variation, mean-median gap and what they say about skew."""
    mean, median = F.col("mean"), F.col("median")
    return stats.select(
        C.ratio(F.col("std"), mean).alias("coef_variation"),
        (mean - median).alias("mean_median_gap"),
        F.when(mean > median * 1.05, "right-skewed").otherwise("fairly symmetric").alias("skew_note"),
    )


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column."""
    long = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])
        )
    ).filter("value IS NOT NULL")
    moments = long.groupBy("column_name").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = quantiles(
        value_counts(long, "value", ["column_name"]),
        "value",
        {"q1": 0.25, "median": 0.5, "q3": 0.75},
        ["column_name"],
        few_groups=True,
    )
    return moments.join(quartiles, "column_name")


def correlation(df: DataFrame, x: str = "temp", y: str = S.VOLUME) -> DataFrame:
    """Pearson r over plausible temperatures, with the rows left out counted."""
    good = F.col(x) > S.IMPOSSIBLE_TEMP_KELVIN
    gx, gy = F.when(good, F.col(x)), F.when(good, F.col(y).cast("double"))
    r = F.corr(gx, gy)
    return df.agg(
        r.alias("r"),
        F.count_if(good).alias("n"),
        F.count_if(~F.coalesce(good, F.lit(False))).alias("n_excluded"),
        F.pow(r, 2).alias("r_squared"),
    )


def correlation_notes(corr: DataFrame) -> DataFrame:
    return corr.withColumns({
        "strength": C.correlation_strength(F.col("r")),
        "direction": F.when(F.col("r") > 0, "positive").otherwise("negative"),
    })


def correlation_test(corr: DataFrame) -> DataFrame:
    """Add the two-sided p-value to rows of r and n."""
    return corr.withColumn("p_value", pearson_p_value(F.col("r"), F.col("n")))


def correlation_tests(df: DataFrame, features: Sequence[str], y: str = S.VOLUME, by: Sequence[str] = ()) -> DataFrame:
    """Per group and feature: Pearson r with ``y``, rows where both are known, and the p-value, in one pass over the rows."""
    def of(feature: str) -> Column:
        both = F.col(feature).isNotNull() & F.col(y).isNotNull()
        x = F.when(both, F.col(feature).cast("double"))
        return F.struct(F.lit(feature).alias("feature"), F.corr(x, F.col(y).cast("double")).alias("r"), F.count_if(both).alias("n"))

    sums = df.groupBy(*by).agg(*[of(f).alias(f"_{i}") for i, f in enumerate(features)])
    return correlation_test(sums.select(*by, F.inline(F.array(*[f"_{i}" for i in range(len(features))]))))


def linear_trend(df: DataFrame, x: str = "temp", y: str = S.VOLUME) -> DataFrame:
    return df.agg(
        F.regr_slope(F.col(y).cast("double"), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y).cast("double"), F.col(x)).alias("intercept"),
        F.min(x).alias("x_min"),
        F.max(x).alias("x_max"),
    )


def histogram(df: DataFrame, bins: int = 40, value: str = S.VOLUME) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty ones included.

    The rows are read once, into one count per distinct value; bounds, centre
    marks and bins all come from those counts.  The maximum belongs to the
    last bin.
    """
    counts = value_counts(df, value)
    marks = counts.agg(
        F.min(value).cast("double").alias("_lo"),
        F.max(value).cast("double").alias("_hi"),
        C.ratio(F.sum(F.col(value) * F.col("n")), F.sum("n")).alias("mean_mark"),
    ).crossJoin(F.broadcast(quantiles(counts, value, {"median_mark": 0.5})))
    position = C.ratio((F.col(value) - F.col("_lo")) * bins, F.col("_hi") - F.col("_lo"))
    filled = (
        counts.crossJoin(F.broadcast(marks))  # one row
        .withColumn("bin", F.least(F.floor(F.coalesce(position, F.lit(0.0))), F.lit(bins - 1)).cast("int"))
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    return (
        marks.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .join(filled, "bin", "left")
        .select(
            "bin",
            (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
            (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
            "mean_mark",
            "median_mark",
        )
    )


def share_where(condition: Column) -> Column:
    """Share of rows that satisfy a condition; an unknown condition counts as not."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))
