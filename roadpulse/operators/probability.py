"""Congestion probabilities: every figure from one pass of conditional counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C


def condition_flags(df: DataFrame) -> DataFrame:
    """Boolean conditions used by the probability reports."""
    return df.withColumns({
        "congested": F.col("traffic_volume") > S.CONGESTED_ABOVE,
        "clear": F.col("weather_main") == "Clear",
        "cloudy": F.col("weather_main") == "Clouds",
        "hot": F.col("temp") > S.HOT_ABOVE_KELVIN,
    })


def condition_counts(df: DataFrame) -> DataFrame:
    flagged = condition_flags(df)
    congested = F.col("congested")
    return flagged.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(congested).alias("n_congested"),
        F.count_if("clear").alias("n_clear"),
        F.count_if("cloudy").alias("n_cloudy"),
        F.count_if(congested & F.col("clear")).alias("n_congested_clear"),
        F.count_if(congested & F.col("cloudy")).alias("n_congested_cloudy"),
        F.count_if(congested & F.col("hot")).alias("n_congested_hot"),
    )


def probabilities(counts: DataFrame) -> DataFrame:
    n = F.col("n")
    return counts.select(
        "n",
        "n_congested",
        "n_clear",
        "n_congested_clear",
        C.ratio(F.col("n_congested"), n).alias("p_congested"),
        C.ratio(F.col("n_clear"), n).alias("p_clear"),
        C.ratio(F.col("n_congested_clear"), n).alias("p_both"),
    )


def conditional_probabilities(counts: DataFrame) -> DataFrame:
    return counts.select(
        C.ratio(F.col("n_congested_clear"), F.col("n_congested")).alias("p_clear_given_congested"),
        C.ratio(F.col("n_congested_hot"), F.col("n_congested")).alias("p_hot_given_congested"),
    )


def independence(counts: DataFrame, tolerance: float = 0.001) -> DataFrame:
    p = probabilities(counts)
    expected = F.col("p_congested") * F.col("p_clear")
    gap = F.col("p_both") - expected
    return p.select(
        expected.alias("expected"),
        F.col("p_both").alias("observed"),
        gap.alias("gap"),
        F.when(F.abs(gap) > tolerance, "not independent").otherwise("appear independent").alias("verdict"),
    )


def odds_ratio(counts: DataFrame) -> DataFrame:
    """Odds of congestion in clear against cloudy hours; NULL when a cell is empty."""
    clear = C.ratio(F.col("n_congested_clear"), F.col("n_clear") - F.col("n_congested_clear"))
    cloudy = C.ratio(F.col("n_congested_cloudy"), F.col("n_cloudy") - F.col("n_congested_cloudy"))
    rows = counts.select(
        clear.alias("odds_clear"), cloudy.alias("odds_cloudy"), F.try_divide(clear, cloudy).alias("odds_ratio")
    )
    ratio = F.col("odds_ratio")
    return rows.withColumns({
        "effect": F.when(ratio.isNull(), None).when((ratio > 0.7) & (ratio < 1.4), "modest").otherwise("meaningful"),
        "direction": F.when(ratio.isNull(), None)
        .when(F.abs(ratio - 1) <= 0.05, "same")
        .when(ratio > 1, "higher")
        .otherwise("lower"),
    })


def congestion_rate_by_weather(df: DataFrame, top: int = 6) -> DataFrame:
    """Congested share for the most frequent weather conditions."""
    return (
        df.groupBy(F.col("weather_main").alias("weather"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg((F.col("traffic_volume") > S.CONGESTED_ABOVE).cast("double")).alias("rate"),
        )
        .orderBy(F.desc("n"), "weather")
        .limit(top)
        .orderBy(F.desc("rate"), "weather")
    )
