"""Log of training runs and the comparisons built on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
])

# The parameter and metric names training runs record.
PARAMS = ["model", "task", "n_estimators", "max_depth", "lookback", "units", "epochs", "batch_size"]
METRICS = [
    "MAE", "R2", "final_train_loss", "final_val_loss",
    "accuracy", "precision", "recall", "f1", "roc_auc",
]


def as_map(entries: Mapping[str, Column], value_type: str) -> Column:
    """Map column without the entries whose value is NULL."""
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), v.cast(value_type).alias("v")) for k, v in entries.items()])
    return F.map_from_entries(F.filter(pairs, lambda p: p["v"].isNotNull()))


def append_runs(runs: DataFrame, path: str) -> None:
    """Add runs to the log; the log itself is never rewritten."""
    runs.select(*[F.col(f.name).cast(f.dataType) for f in RUN_LOG_SCHEMA]).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)


def logged_runs(log: DataFrame, ignore: str = "Default") -> DataFrame:
    return log.filter(F.col("experiment") != ignore)


def wide_runs(
    log: DataFrame, params: Sequence[str] = tuple(PARAMS), metrics: Sequence[str] = tuple(METRICS)
) -> DataFrame:
    """Params and metrics as columns.  The names are known, so no pivot and no shuffle."""
    return log.select(
        "experiment",
        "run_name",
        "start_time",
        *[F.try_element_at("params", F.lit(p)).alias(p) for p in params],
        *[F.try_element_at("metrics", F.lit(m)).alias(m) for m in metrics],
    )


def run_comparison(log: DataFrame, metrics: Sequence[str] = tuple(METRICS)) -> DataFrame:
    """All runs, repeats with equal name and metrics reduced to the newest."""
    newest = Window.partitionBy("run_name", *metrics).orderBy(F.desc("start_time"), "experiment")
    return (
        wide_runs(logged_runs(log), metrics=metrics)
        .withColumn("_rank", F.row_number().over(newest))
        .filter("_rank = 1")
        .drop("_rank")
        .orderBy("experiment", "run_name", "start_time")
    )


def strip_prefixes(df: DataFrame, prefixes: Sequence[str] = ("metrics_", "params_")) -> DataFrame:
    """Rename columns by dropping a known prefix."""
    renames = {c: c[len(p):] for c in df.columns for p in prefixes if c.startswith(p)}
    return df.withColumnsRenamed(renames)


def named_like(runs: DataFrame, part: str) -> DataFrame:
    return runs.filter(F.col("run_name").contains(part))


def union_runs(*tables: DataFrame) -> DataFrame:
    """Rows of run tables whose columns differ."""
    first, *others = tables
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def classification_comparison(runs: DataFrame, task: str) -> DataFrame:
    return (
        runs.filter(F.col("task") == task)
        .select("run_name", "model", "precision", "recall", "f1", "roc_auc")
        .na.drop(subset=["precision"])
    )


def best_run_per_model(runs: DataFrame, metric: str = "R2") -> DataFrame:
    """The run with the highest metric for each model, worst model first."""
    best = Window.partitionBy("model").orderBy(F.desc(metric), "run_name", F.desc("start_time"))
    return (
        runs.na.drop(subset=[metric])
        .withColumn("_rank", F.row_number().over(best))
        .filter("_rank = 1")
        .select("run_name", "model", metric)
        .orderBy(metric, "model")
    )
