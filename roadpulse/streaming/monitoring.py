"""Daily drift checks over a stream of featured rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.operators import drift


#: Batch number of days that were closed because the input ended.
CLOSED = -1


def training_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, value, n_train)`` of the training rows, to be stored with the model."""
    return drift.feature_counts(df, features).filter("n_train > 0").select("feature", "value", "n_train")


def daily_counts(rows: DataFrame, features: Sequence[str], ts: str = S.TS, late: str = "1 day") -> DataFrame:
    """Rows per day, feature and value; a day is final once it is past the lateness allowed."""
    entries = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    return (
        rows.withColumn("_event_time", C.event_time(F.col(ts)))
        .withWatermark("_event_time", late)
        .select("_event_time", F.to_date(ts).alias("day"), F.inline(F.array(*entries)))
        .filter("value IS NOT NULL")
        # The window closes the day; the day itself is free of time zones.
        .groupBy(F.window("_event_time", "1 day"), "day", "feature", "value")
        .agg(F.count(F.lit(1)).alias("n_test"))
        .select("day", "feature", "value", "n_test")
    )


def daily_drift(counts: DataFrame, training: DataFrame) -> DataFrame:
    """KS distance of each finished day against the training rows."""
    days = counts.select("day", "feature").distinct()
    expected = days.join(training, "feature")
    both = expected.join(counts, ["day", "feature", "value"], "full").select(
        "day", "feature", "value",
        F.coalesce("n_train", F.lit(0)).alias("n_train"), F.coalesce("n_test", F.lit(0)).alias("n_test"),
    )
    ks = drift.ks_from_counts(both, ["day", "feature"])
    return ks.withColumn("status", C.alert(F.col("ks_statistic") > S.KS_ALERT_ABOVE))


def monitor_stream(
    rows: DataFrame, training: DataFrame, features: Sequence[str], path: str, checkpoint: str
) -> StreamingQuery:
    """Append one row per finished day and feature to ``path``."""

    def write(batch: DataFrame, number: int) -> None:
        # Several branches of the plan read the batch; its state must be worked out once.
        batch.persist()
        try:
            daily_drift(batch, training).write.mode("overwrite").parquet(f"{path}/batch={number}")
        finally:
            batch.unpersist()

    return (
        daily_counts(rows, features)
        .writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def close_days(rows: DataFrame, training: DataFrame, features: Sequence[str], path: str, ts: str = S.TS) -> None:
    """Judge the days that the stream has not written, from a batch of the same rows, when the input has ended.

    Written under a batch number of its own, so closing again replaces the first attempt; days that the stream has
    finished are never judged twice.
    """
    finished = rows.sparkSession.read.parquet(path).filter(F.col("batch") != CLOSED).select("day").distinct()
    entries = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    left = rows.withColumn("day", F.to_date(ts)).join(finished, "day", "left_anti")
    counts = (
        left.select("day", F.inline(F.array(*entries))).filter("value IS NOT NULL")
        .groupBy("day", "feature", "value").agg(F.count(F.lit(1)).alias("n_test"))
    )
    daily_drift(counts, training).write.mode("overwrite").parquet(f"{path}/batch={CLOSED}")


def daily_results(spark: SparkSession, path: str) -> DataFrame:
    """One row per day and feature: what the stream wrote, and closed days that it has not finished since."""
    rows = spark.read.parquet(path)
    streamed = rows.filter(F.col("batch") != CLOSED)
    closed = rows.filter(F.col("batch") == CLOSED).join(streamed.select("day", "feature").distinct(), ["day", "feature"], "left_anti")
    return streamed.unionByName(closed).drop("batch")
