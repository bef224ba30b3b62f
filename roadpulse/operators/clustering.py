"""k-means over hour, weather severity and volume.

The three features take few distinct combinations compared with the number of
rows, so fits run on combinations weighted by their row counts.  Weighted
k-means on them minimises exactly the same cost as k-means on the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import columns as C
from roadpulse.sources.storage import stage

CLUSTER_COLUMNS = ["hour", "weather_severity", "traffic_volume"]
SEEDS = tuple(range(42, 52))


def cluster_features(featured: DataFrame) -> DataFrame:
    return featured.select(
        "corridor", "ts", "hour", C.severity(F.col("weather_main")).alias("weather_severity"), "traffic_volume"
    )


def scale_of(df: DataFrame, columns: Sequence[str] = tuple(CLUSTER_COLUMNS)) -> DataFrame:
    """Mean and population deviation per column, as one row."""
    return df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}_std") for c in columns]
    )


def standardise(
    df: DataFrame, scale: DataFrame | None = None, columns: Sequence[str] = tuple(CLUSTER_COLUMNS)
) -> DataFrame:
    scale = scale_of(df, columns) if scale is None else scale
    return (
        df.crossJoin(F.broadcast(scale))  # one row
        .withColumns({f"{c}_z": C.ratio(F.col(c) - F.col(f"{c}_mean"), F.col(f"{c}_std")) for c in columns})
        .drop(*scale.columns)
    )


def weighted_points(points: DataFrame, columns: Sequence[str] = tuple(CLUSTER_COLUMNS)) -> DataFrame:
    """Distinct standardised points with their row counts, written once for all fits."""
    known = points.na.drop(subset=list(columns))
    counts = known.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return stage(standardise(counts, scale_of(known, columns), columns), "cluster_points")


def assemble(df: DataFrame, columns: Sequence[str] = tuple(CLUSTER_COLUMNS)) -> DataFrame:
    return VectorAssembler(inputCols=[f"{c}_z" for c in columns], outputCol="features").transform(df)


def fit_kmeans(
    vectors: DataFrame, k: int, seeds: Sequence[int] = SEEDS, parallelism: int = 8
) -> KMeansModel:
    """The restart with the lowest cost.  Restarts are independent, so their jobs overlap."""

    def fit(seed: int) -> KMeansModel:
        return KMeans(k=k, seed=seed, featuresCol="features", weightCol="weight", predictionCol="cluster").fit(vectors)

    with ThreadPoolExecutor(parallelism) as pool:
        models = list(pool.map(inheritable_thread_target(vectors.sparkSession)(fit), seeds))
    return min(models, key=lambda model: model.summary.trainingCost)


def choose_k(
    vectors: DataFrame, candidates: Sequence[int] = range(2, 7), seeds: Sequence[int] = SEEDS
) -> tuple[KMeansModel, DataFrame]:
    """The model with the best silhouette, and ``(k, cost, silhouette)`` per candidate.

    The silhouette uses squared distances, which needs one pass and no sample.
    """
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", weightCol="weight")
    scored = []
    for k in candidates:
        model = fit_kmeans(vectors, k, seeds)
        scored.append((evaluator.evaluate(model.transform(vectors)), model, k))
    best = max(scored, key=lambda entry: (entry[0], -entry[2]))
    table = vectors.sparkSession.createDataFrame(
        [(k, float(model.summary.trainingCost), float(score)) for score, model, k in scored],
        "k bigint, cost double, silhouette double",
    )
    return best[1], table


def cluster_summary(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster").agg(
        *[F.round(F.avg(c), 1).alias(c) for c in CLUSTER_COLUMNS], F.count(F.lit(1)).alias("n_hours")
    )


def weighted_summary(clustered: DataFrame) -> DataFrame:
    """:func:`cluster_summary` of weighted distinct points."""
    weight = F.col("weight")
    return clustered.groupBy("cluster").agg(
        *[F.round(F.sum(F.col(c) * weight) / F.sum(weight), 1).alias(c) for c in CLUSTER_COLUMNS],
        F.sum(weight).cast("bigint").alias("n_hours"),
    )
