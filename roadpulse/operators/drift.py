"""Distribution drift between the training and the recent period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.functions.significance import kolmogorov_p_value
from roadpulse.operators.ranks import running_totals


def feature_counts(df: DataFrame, features: Sequence[str], is_train: str = "is_train") -> DataFrame:
    """``(feature, value, n_train, n_test)``, one row per distinct feature value.

    Rows are counted per combination of feature values before they are turned
    into one row per feature, so the twenty-fold expansion applies to
    combinations instead of rows.
    """
    combos = df.groupBy(*features).agg(
        F.count_if(is_train).alias("n_train"), F.count_if(~F.col(is_train)).alias("n_test")
    )
    return long_counts(combos, features)


def long_counts(combos: DataFrame, features: Sequence[str]) -> DataFrame:
    entries = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    return (
        combos.select("n_train", "n_test", F.inline(F.array(*entries)))
        .filter("value IS NOT NULL")
        .groupBy("feature", "value")
        .agg(F.sum("n_train").alias("n_train"), F.sum("n_test").alias("n_test"))
    )


def ks_from_counts(counts: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    """Largest distance between the two empirical distributions per feature."""
    ranked = running_totals(counts, "value", ["n_train", "n_test"], by, few_groups=list(by) == ["feature"])

    def reached(side: str) -> Column:
        return C.ratio(F.col(f"{side}_before") + F.col(side), F.col(f"{side}_total"))

    return ranked.groupBy(*by).agg(
        F.max(F.abs(reached("n_train") - reached("n_test"))).alias("ks_statistic"),
        F.max("n_train_total").alias("n_train"),
        F.max("n_test_total").alias("n_test"),
    )


def ks_two_sample(df: DataFrame, features: Sequence[str] = tuple(S.FEATURES)) -> DataFrame:
    return ks_from_counts(feature_counts(df, features))


def drift_status(ks: DataFrame, alert_above: float = S.KS_ALERT_ABOVE) -> DataFrame:
    """Add the p-value and PASS or ALERT; largest distance first."""
    return (
        ks.withColumn("p_value", kolmogorov_p_value(F.col("ks_statistic"), F.col("n_train"), F.col("n_test")))
        .withColumn("status", C.alert(F.col("ks_statistic") > alert_above))
        .select("feature", "ks_statistic", "p_value", "status")
        .orderBy(F.desc("ks_statistic"), "feature")
    )


def drift_report(df: DataFrame, features: Sequence[str] = tuple(S.FEATURES)) -> DataFrame:
    return drift_status(ks_two_sample(df, features))


def drift_summary(report: DataFrame) -> DataFrame:
    """Overall status with the flagged features; one row per report."""
    flagged = F.when(F.col("status") == "ALERT", F.col("feature"))
    return report.agg(
        C.alert(F.coalesce(F.bool_or(F.col("status") == "ALERT"), F.lit(False))).alias("overall_status"),
        F.count(flagged).alias("n_alerts"),
        # At most one entry per feature.
        F.array_join(F.array_sort(F.collect_list(flagged)), ", ").alias("flagged"),
    )


def portable_share(number: Column, per_mille: int) -> Column:
    """A repeatable pseudo-random choice of rows from an integer id."""
    return F.pmod(number * F.lit(2654435761), F.lit(1000)) < per_mille


def hashed_share(columns: Sequence[str], per_mille: int) -> Column:
    """The same for arbitrary key columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1000)) < per_mille


def sample_rows(df: DataFrame, n: int, key: Sequence[str] = (*S.KEY, S.TS), seed: int = 42) -> DataFrame:
    """n rows chosen by the order of MD5 digests: the same rows whatever the partitioning or the engine."""
    named = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in key]).cast("binary"))
    return df.orderBy(named, *key).limit(n)


def inject_severe_weather(df: DataFrame, chosen: Column, is_train: str = "is_train") -> DataFrame:
    """Fault injection: turn the chosen test rows into thunderstorms."""
    hit = chosen & ~F.col(is_train)
    return df.withColumns({
        "is_severe_weather": F.when(hit, 1).otherwise(F.col("is_severe_weather")),
        "weather_Clear": F.when(hit, 0).otherwise(F.col("weather_Clear")),
        "weather_Thunderstorm": F.when(hit, 1).otherwise(F.col("weather_Thunderstorm")),
    })
