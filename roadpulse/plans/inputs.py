"""Tables the queries start from.

``traffic_raw`` is lazy.  The hourly view, the cleaned and the featured table
are stage boundaries: they are written once per application and read by
many queries, as one would between the cleaning job and its consumers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.operators import cleaning, features, model_store, series
from roadpulse.sources.standin import table, traffic_raw
from roadpulse.sources.storage import shared_dir, stage

# Years present in the test tables; the last one is partial and left out.
FIRST_YEAR, LAST_YEAR = 1995, 2000
HOLIDAY_FIRST, HOLIDAY_LAST = 1998, 2000

_written: dict[tuple[str, str, str], DataFrame] = {}
_loaded: dict[tuple[str, str, str], tuple[PipelineModel, dict]] = {}

# Part of what a model is known by: raised when a fit or the tables before it change.
RECIPE = 1


def _written_once(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], partition_by: list[str] | None = None
) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = stage(build(), name, partition_by)
    # A fresh reader per use: a DataFrame joined with itself needs new column ids.
    return _written[key].select("*")


def forget_tables() -> None:
    """Let the next query write its input tables again (used when timing)."""
    _written.clear()
    _loaded.clear()


def raw(spark: SparkSession, sf_dir: str, **years: int) -> DataFrame:
    return traffic_raw(spark, sf_dir, **years)


def parsed(spark: SparkSession, sf_dir: str, **years: int) -> DataFrame:
    return cleaning.parse_times(cleaning.standardise_text(raw(spark, sf_dir, **years)))


def hourly(spark: SparkSession, sf_dir: str, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """The saved hourly view, written by year; a year range reads only its folders."""
    view = _written_once(
        spark, sf_dir, "hourly", lambda: cleaning.hourly_from_raw(raw(spark, sf_dir)).withColumn("_year", F.year("ts")), ["_year"]
    )
    if first_year is not None:
        view = view.filter(F.col("_year") >= first_year)
    if last_year is not None:
        view = view.filter(F.col("_year") <= last_year)
    return view.drop("_year")


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written_once(
        spark, sf_dir, "first_rows", lambda: cleaning.keep_first(parsed(spark, sf_dir))
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written_once(
        spark, sf_dir, "cleaned", lambda: cleaning.repair_readings(first_rows(spark, sf_dir))
    )


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features and the risk label."""
    return _written_once(
        spark, sf_dir, "featured", lambda: features.add_risk_label(features.engineer(cleaned(spark, sf_dir)))
    )


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Featured rows with numeric flags and the chronological split."""
    return _written_once(
        spark,
        sf_dir,
        "model_table",
        lambda: series.chronological_split(
            featured(spark, sf_dir).withColumn("is_holiday", F.col("is_holiday").cast("int"))
        ),
    )


def lag_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous 24 values with the context features, split by time."""
    return _written_once(
        spark,
        sf_dir,
        "lag_table",
        lambda: series.lag_features(
            series.chronological_split(
                featured(spark, sf_dir)
                .withColumn("is_holiday", F.col("is_holiday").cast("int"))
                .select("corridor", "ts", "traffic_volume", *S.FEATURES),
                skip=S.LOOKBACK,
            )
        ),
    )


def model_registry(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/model-registry"


def fitted(
    spark: SparkSession, sf_dir: str, name: str, fit: Callable[[], PipelineModel], params: dict[str, object] | None = None
) -> tuple[PipelineModel, dict]:
    """The newest published model for these tables and its entry; the first job that needs it fits and publishes it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _loaded:
        trained_on = model_store.fingerprint(spark, sf_dir, name, sorted((params or {}).items()), RECIPE)
        _loaded[key] = model_store.fit_once(spark, model_registry(spark), name, trained_on, fit, params)
    return _loaded[key]


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_table(spark, sf_dir).filter("is_train")


def test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_table(spark, sf_dir).filter("NOT is_train")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times people ask about, one per order: ``(corridor, requested)`` as text, some malformed."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    # Whole minutes spread over the order's day.
    when = F.expr("CAST(o_orderdate AS DATE) + make_dt_interval(0, 0, CAST(o_orderkey * 37 % 1440 AS INT), 0)")
    return orders.select(
        (F.col("o_custkey") % 4).cast("int").alias("corridor"),
        F.when(key % 1499 == 5, "sometime soon").otherwise(F.date_format(when, "yyyy-MM-dd HH:mm:ss")).alias("requested"),
    )


def scenario_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scenario request per raw observation, some of them invalid."""
    part, at = F.col("clouds_all"), F.col("_at")
    # As in ``parse_times``: checks of the hour and the day type read the parsed time instead of the text, time and again.
    df = raw(spark, sf_dir).select("*", F.explode(F.array(C.parse_time(F.col("date_time")))).alias("_at"))
    hour = F.coalesce(F.hour(at), F.lit(24))
    weekend = C.is_weekend(at)
    return df.select(
        "corridor",
        hour.alias("hour"),
        F.when(part == 50, "holiday").when(weekend, "weekend").otherwise("weekday").alias("day_type"),
        F.when(part == 70, "Hail").when(part == 10, None).otherwise(F.col("weather_main")).alias("weather"),
        C.clean_holiday(F.col("holiday")).isNotNull().alias("is_holiday"),
    )


def observed_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (day type, weather, holiday) situations seen on the road."""
    return (
        featured(spark, sf_dir)
        .select(
            C.day_type(F.col("is_weekend"), S.DAY_TYPES).alias("day_type"),
            F.col("weather_main").alias("weather"),
            "is_holiday",
        )
        .distinct()
    )
