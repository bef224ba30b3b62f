"""Cleaning raw observations as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.operators import cleaning
from roadpulse.operators.features import fit_feature_params
from roadpulse.streaming.arrivals import repaired


def raw_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(S.RAW_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def saved_params(cleaned: DataFrame, first_rows: DataFrame, path: str) -> None:
    """Fit on a finished batch what a stream cannot know: medians and feature scalars."""
    medians = cleaning.monthly_medians(first_rows, "temp", cleaning.invalid_temp()).join(
        cleaning.monthly_medians(first_rows, "rain_1h", cleaning.invalid_rain()), "month", "full"
    )
    medians.write.mode("overwrite").parquet(f"{path}/medians")
    fit_feature_params(cleaned).write.mode("overwrite").parquet(f"{path}/features")


def clean_stream(raw: DataFrame, medians: DataFrame, late: str = "1 day") -> DataFrame:
    """Row-level cleaning and one row per hour.

    The state holds one key per hour within the lateness allowed; rows that
    come later still are left out here; :mod:`arrivals` keeps them and merges them in.  Copies that
    arrive together keep the one that is seen first; the batch job's total
    order needs the whole hour, which a merge has.
    """
    parsed = cleaning.parse_times(cleaning.standardise_text(raw))
    timed = parsed.withColumn("_event_time", C.event_time(F.col(S.TS))).withWatermark("_event_time", late)
    hourly = timed.dropDuplicatesWithinWatermark([*S.KEY, S.TS]).drop("_event_time")
    return repaired(hourly, medians)


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything available, then stop; a restart continues at the checkpoint."""
    return (
        df.withColumn("year", F.year(S.TS))
        .writeStream.format("parquet")
        .partitionBy("year")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that the last batches of a query left out because they came later than the watermark allows.

    From the query's progress reports, of which Spark keeps the last hundred of one run; the whole count is
    :func:`roadpulse.streaming.arrivals.late_counts`.
    """
    return sum(state["numRowsDroppedByWatermark"] for report in query.recentProgress for state in report["stateOperators"])
