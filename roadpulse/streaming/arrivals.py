"""Arrivals of a stream and their merge into the cleaned table: no row is lost for coming late.

:func:`arrive` keeps every parsed row of every batch and marks those behind the watermark, which
:func:`roadpulse.streaming.ingest.clean_stream` leaves out.  :func:`merge` then rebuilds the years that new batches
touched, with the batch job's own order of copies, and overwrites only those.  Both can be repeated: a batch
replaces its own folder, and a merge that failed is done again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadpulse import schema as S
from roadpulse.operators import cleaning

_MARKS = T.StructType([
    T.StructField("latest", T.TimestampNTZType()), T.StructField("n_rows", T.LongType()), T.StructField("n_late", T.LongType()),
    T.StructField("batch", T.LongType()),
])


def arrive(raw: DataFrame, path: str, checkpoint: str, late: str = "1 day") -> StreamingQuery:
    """Keep all rows by batch and year, with ``late`` for those behind the latest time of earlier batches less the lateness allowed."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        seen = _marks(spark, path).filter(F.col("batch") < number).agg(F.max("latest")).first()[0]
        parsed = cleaning.parse_times(cleaning.standardise_text(batch))
        behind = F.lit(False) if seen is None else F.col(S.TS) < F.lit(seen).cast("timestamp_ntz") - F.expr(f"INTERVAL {late}")
        target = f"{path}/rows/batch={number}"
        parsed.select("*", behind.alias("late"), F.year(S.TS).alias("year")).write.mode("overwrite").partitionBy("year").parquet(target)
        written = spark.read.schema(f"{S.TS} timestamp_ntz, late boolean, year int").parquet(target)
        written.agg(
            F.max(S.TS).alias("latest"), F.count(F.lit(1)).alias("n_rows"), F.count_if("late").alias("n_late")
        ).write.mode("overwrite").parquet(f"{path}/marks/batch={number}")

    return (
        raw.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _marks(spark: SparkSession, path: str) -> DataFrame:
    if not _exists(spark, f"{path}/marks"):
        return spark.createDataFrame([], _MARKS)
    return spark.read.schema(_MARKS).parquet(f"{path}/marks")


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows and late rows of every batch that arrived, from the first one on."""
    return _marks(spark, path).select("batch", "n_rows", "n_late")


def arrived(spark: SparkSession, path: str) -> DataFrame:
    """All rows that arrived, with ``batch``, ``year`` and ``late``."""
    return spark.read.parquet(f"{path}/rows")


def merge(spark: SparkSession, path: str, out: str, medians: DataFrame) -> list[int]:
    """Bring the cleaned table at ``out`` up to date with all batches; returns the years that were rewritten."""
    last = _marks(spark, path).agg(F.max("batch")).first()[0]
    done = -1
    if _exists(spark, f"{path}/merged"):
        done = spark.read.schema("batch long").parquet(f"{path}/merged").agg(F.max("batch")).first()[0]
    if last is None or last <= done:
        return []
    rows = arrived(spark, path).filter(F.col("batch") <= last)
    years = sorted(r[0] for r in rows.filter(F.col("batch") > done).select("year").distinct().collect())
    first = cleaning.keep_first(rows.filter(F.col("year").isin(years)).drop("batch", "late", "year"))
    # Whole years of every batch are read; a year's folder is replaced in one step when the job commits.
    (
        repaired(first, medians).withColumn("year", F.year(S.TS)).repartition("year", F.to_date(S.TS))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(out)
    )
    spark.createDataFrame([(last,)], "batch long").write.mode("append").parquet(f"{path}/merged")
    return years


def repaired(rows: DataFrame, medians: DataFrame) -> DataFrame:
    """Implausible readings replaced by the saved medians of their months."""
    temps = medians.select("month", "temp_median").filter("temp_median IS NOT NULL")
    rains = medians.select("month", "rain_1h_median").filter("rain_1h_median IS NOT NULL")
    fixed = cleaning.impute_monthly_median(rows, "temp", cleaning.invalid_temp(), temps)
    return cleaning.impute_monthly_median(fixed, "rain_1h", cleaning.invalid_rain(), rains)
