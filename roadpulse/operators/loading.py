"""Load checks: counts, time range, repeated hours, schema, preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import schema as S


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def time_range(df: DataFrame, ts: str = S.TS) -> DataFrame:
    return df.agg(F.min(ts).alias("earliest"), F.max(ts).alias("latest"))


def duplicate_groups(df: DataFrame, key: Sequence[str] = (*S.KEY, "date_time")) -> DataFrame:
    """How many keys occur more than once."""
    return (
        df.groupBy(*key).count().filter("count > 1").agg(F.count(F.lit(1)).alias("duplicate_groups"))
    )


def verify_load(raw: DataFrame, expected: Sequence[str] = tuple(S.RAW_COLUMNS)) -> DataFrame:
    """Row and column counts, time range, repeated hours and missing columns in one row.

    One grouping by hour answers everything, so the table is read once.
    """
    key = [*S.KEY, "date_time"]
    per_hour = raw.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    missing = sorted(set(expected) - set(raw.columns))
    return per_hour.agg(
        F.sum("_n").cast("bigint").alias("row_count"),
        F.lit(len(raw.columns)).cast("bigint").alias("column_count"),
        F.lit(", ".join(raw.columns)).alias("columns"),
        F.min(F.col("date_time").try_cast("timestamp_ntz")).alias("earliest"),
        F.max(F.col("date_time").try_cast("timestamp_ntz")).alias("latest"),
        F.count_if(F.col("_n") > 1).alias("duplicate_groups"),
        F.lit(", ".join(missing)).alias("missing_columns"),
    )


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and how many rows fill it."""
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
            F.col(field.name).alias("filled_rows"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return filled.select(F.inline(F.array(*entries)))


def preview(df: DataFrame, rows: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """First rows in a stated order; each task forwards only its own first rows."""
    return df.orderBy(*(order_by or df.columns)).limit(rows)
