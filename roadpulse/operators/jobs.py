"""The batch job from a raw file to the cleaned and the featured table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.operators import cleaning, features
from roadpulse.sources import files


def run_pipeline(spark: SparkSession, source: str, target: str, keep_going: bool = False, csv: bool = False) -> DataFrame:
    """Load and check ``source``, write both tables by year under ``target``, return the cleaning audit.

    Each table is read back by the next step, so nothing is worked out twice.  With ``keep_going`` broken
    lines go to ``target``/quarantine instead of ending the job; with ``csv`` the featured table is written as CSV too.
    """
    if keep_going:
        raw = files.quarantine(spark, source, f"{target}/quarantine")
    else:
        files.check_load(spark, source)
        raw = files.read_raw_csv(spark, source)
    files.save_by_year(cleaning.clean(raw), f"{target}/cleaned")
    cleaned = files.load_features(spark, f"{target}/cleaned").drop("year")
    files.save_by_year(features.add_risk_label(features.engineer(cleaned)), f"{target}/featured")
    if csv:
        files.save_csv(files.load_features(spark, f"{target}/featured"), f"{target}/featured_csv")
    cleaning.clean_audit(raw).write.mode("overwrite").parquet(f"{target}/audit")
    return spark.read.parquet(f"{target}/audit")
