"""Regression and classification metrics over predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import columns as C
from roadpulse.operators.ranks import running_totals
from roadpulse.sources.storage import stage


# Keys with a fixed number of values: at most 24 x 7 x 2 x 2 combinations.
CALENDAR = {"hour", "day_of_week", "is_weekend", "is_holiday"}


def regression_metrics(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error and R squared in one aggregation.

    Rows without a value or a prediction are left out of both and counted in ``n_left_out``.
    """
    error = F.col(y).cast("double") - F.col(pred)
    actual = F.when(error.isNotNull(), F.col(y).cast("double"))
    return df.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("MAE"),
        (1 - C.ratio(F.sum(error * error), F.var_pop(actual) * F.count(actual))).alias("R2"),
        F.count(error).alias("n"),
        (F.count(F.lit(1)) - F.count(error)).alias("n_left_out"),
    )


def classification_metrics(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    threshold: float = 0.5,
    by: Sequence[str] = (),
) -> DataFrame:
    """Accuracy, precision, recall, F1 and ROC-AUC.

    Undefined precision, recall and F1 are 0.  Everything derives from
    positive and negative counts per distinct score; tied scores share their
    average rank in the AUC.
    """
    by = list(by)
    counts = df.groupBy(*by, score).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum(1 - F.col(label).cast("bigint")).alias("neg"),
    )
    ranked = running_totals(counts, score, ["neg"], by)
    pos, neg, flagged = F.col("pos"), F.col("neg"), F.col(score) >= threshold
    cells = ranked.groupBy(*by).agg(
        F.sum(F.when(flagged, pos).otherwise(0)).alias("tp"),
        F.sum(F.when(flagged, neg).otherwise(0)).alias("fp"),
        F.sum(F.when(~flagged, pos).otherwise(0)).alias("fn"),
        F.sum(F.when(~flagged, neg).otherwise(0)).alias("tn"),
        F.sum(pos * (F.col("neg_before") + neg / 2)).alias("wins"),
    )
    zero = F.lit(0.0)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select(
        *by,
        C.ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.coalesce(C.ratio(tp, tp + fp), zero).alias("precision"),
        F.coalesce(C.ratio(tp, tp + fn), zero).alias("recall"),
        F.coalesce(C.ratio(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
        C.ratio(F.col("wins"), (tp + fn) * (fp + tn)).alias("roc_auc"),
    )


def error_drift(df: DataFrame, alert_above: float, y: str = "y", pred: str = "pred", half: str = "half") -> DataFrame:
    """Mean absolute error in the first and second half of the test period."""
    size = F.abs(F.col(y) - F.col(pred))
    errors = df.agg(
        F.avg(F.when(F.col(half) == 1, size)).alias("mae_first_half"),
        F.avg(F.when(F.col(half) == 2, size)).alias("mae_second_half"),
    )
    change = C.ratio(F.col("mae_second_half") - F.col("mae_first_half"), F.col("mae_first_half"))
    return errors.withColumn("pct_change", change).withColumn(
        "status", C.alert(F.col("pct_change") > alert_above)
    )


def mean_profile(train: DataFrame, by: Sequence[str], target: str = "traffic_volume") -> DataFrame:
    """Training mean per group: the simplest predictor, and the one SQL can check."""
    return train.groupBy(*by).agg(F.avg(target).alias("pred"))


def predict_from_profile(df: DataFrame, profile: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach the profile's prediction; the table itself is not shuffled for calendar profiles.

    Other profiles are written first: the join then knows their size, broadcasts them below the
    threshold, and beyond it splits keys that hold many rows.
    """
    bounded = set(by) <= CALENDAR
    return df.join(F.broadcast(profile) if bounded else stage(profile, "profile"), list(by), "left")
