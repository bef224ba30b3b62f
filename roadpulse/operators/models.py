"""Risk classification and volume regression with Spark ML.

The twenty context features take few distinct combinations (hour x weekday x
weather x wet x holiday), so most fits run on combinations with row counts as
weights.  That table stays the same size however many hours were recorded.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.operators.metrics import regression_metrics
from roadpulse.operators.scenarios import ASKED, every_scenario, scenario_features
from roadpulse.sources.storage import stage

LAG_COLUMNS = [f"lag_{k}" for k in range(1, S.LOOKBACK + 1)]
# Rows of a range whose values are exchanged when a feature's importance is measured.
EXCHANGE_ROWS = 10_000
# Each partition adds up statistics of all open nodes of a forest, as many for few rows as for many.
FOREST_PARTITION_ROWS = 50_000
# Fits that a large forest is grown in.
FOREST_PARTS = 8


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


# -- training tables ----------------------------------------------------------
def regression_cells(
    train: DataFrame, features: Sequence[str] = tuple(S.FEATURES), target: str = S.VOLUME
) -> DataFrame:
    """Mean target and row count per feature combination.

    For squared error this gives the same least-squares solution and the same
    tree splits as the rows themselves: rows of one combination always share a
    leaf, and their scatter around their mean is a constant.
    """
    return train.groupBy(*features).agg(
        F.avg(target).alias("label"), F.count(F.lit(1)).cast("double").alias("weight")
    )


def class_weights(train: DataFrame, label: str = "high_risk") -> DataFrame:
    """Balanced weights ``n / (classes * n_class)``, one row per class."""
    counts = train.groupBy(F.col(label).cast("double").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()  # one row per class
    share = F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n"))
    return counts.withColumn("class_weight", share)


def classification_cells(
    train: DataFrame, features: Sequence[str] = tuple(S.FEATURES), label: str = "high_risk"
) -> DataFrame:
    """``(features, label, n, weight)`` with balanced class weights times counts."""
    cells = train.groupBy(*features, F.col(label).cast("double").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    weights = class_weights(train, label).select("label", "class_weight")
    return cells.join(F.broadcast(weights), "label").withColumn(  # one row per class
        "weight", F.col("n") * F.col("class_weight")
    )


def filled_partitions(rows: DataFrame, least: int = FOREST_PARTITION_ROWS) -> DataFrame:
    """``rows`` in no more partitions than hold about ``least`` rows each; large tables keep theirs."""
    return rows.coalesce(max(1, math.ceil(rows.count() / least)))


# -- fits -------------------------------------------------------------------------
def fit_logistic(train: DataFrame, features: Sequence[str] = tuple(S.FEATURES), max_iter: int = 1000) -> PipelineModel:
    """Balanced logistic regression with unit inverse penalty on the summed loss."""
    cells = stage(classification_cells(train, features), "logistic_cells")
    rows = cells.agg(F.sum("n").alias("n")).first()["n"]
    model = LogisticRegression(
        weightCol="weight", maxIter=max_iter, tol=1e-10, standardization=False, regParam=1.0 / rows, elasticNetParam=0.0
    )
    return Pipeline(stages=[_assembler(features), model]).fit(cells)


def fit_forest_classifier(
    train: DataFrame,
    features: Sequence[str] = tuple(S.FEATURES),
    trees: int = 200,
    depth: int = 10,
    seed: int = 42,
    label: str = "high_risk",
) -> PipelineModel:
    """A forest redraws its training rows for each tree, so it trains on the rows, weighted by class."""
    weights = class_weights(train, label).select("label", F.col("class_weight").alias("weight"))
    rows = train.select(*features, F.col(label).cast("double").alias("label")).join(F.broadcast(weights), "label")  # one row per class
    rows = stage(rows, "forest_rows")
    model = RandomForestClassifier(
        weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt",
        maxMemoryInMB=512, cacheNodeIds=True,
    )
    return Pipeline(stages=[_assembler(features), model]).fit(filled_partitions(rows))


def fit_linear(train: DataFrame, features: Sequence[str] = tuple(S.FEATURES)) -> PipelineModel:
    """Unpenalised least squares by the normal equations."""
    cells = stage(regression_cells(train, features), "linear_cells")
    model = LinearRegression(weightCol="weight", solver="normal", regParam=0.0)
    return Pipeline(stages=[_assembler(features), model]).fit(cells)


def fit_boosting(
    train: DataFrame,
    features: Sequence[str] = tuple(S.FEATURES),
    rounds: int = 200,
    depth: int = 4,
    rate: float = 0.1,
    seed: int = 42,
) -> PipelineModel:
    cells = stage(regression_cells(train, features), "boosting_cells")
    model = GBTRegressor(weightCol="weight", maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed, cacheNodeIds=True)
    return Pipeline(stages=[_assembler(features), model]).fit(filled_partitions(cells))


def fit_lag_forest(
    train: DataFrame,
    features: Sequence[str] = tuple(LAG_COLUMNS + S.FEATURES),
    target: str = S.VOLUME,
    trees: int = 200,
    depth: int = 10,
    seed: int = 42,
    parts: int = FOREST_PARTS,
) -> PipelineModel:
    """Forest over the last 24 values and the context features.

    Lag combinations hardly repeat, so this one trains on the rows.  Trees do not depend on one another: the
    forest grows in ``parts`` fits that run side by side, so a pass adds up and ships statistics of its own part's nodes only.
    Rows remember their node in every tree instead of walking down the forest again.
    """
    rows = stage(filled_partitions(train.select(*features, target)), "lag_rows")
    vectors = _assembler(features).transform(filled_partitions(rows)).select("features", target)
    shares = [trees // parts + (i < trees % parts) for i in range(parts)]

    def fit(part: int) -> Transformer:
        return RandomForestRegressor(
            labelCol=target, predictionCol=f"_part{part}", numTrees=shares[part], maxDepth=depth, seed=seed + part,
            featureSubsetStrategy="all", maxMemoryInMB=256, cacheNodeIds=True,
        ).fit(vectors)

    grown = [i for i in range(parts) if shares[i]]
    with ThreadPoolExecutor(len(grown)) as pool:
        forests = list(pool.map(fit, grown))
    mean = " + ".join(f"{shares[i]} * _part{i}" for i in grown)
    hidden = ", ".join(f"_part{i}" for i in grown)
    whole = SQLTransformer(statement=f"SELECT * EXCEPT ({hidden}), ({mean}) / {trees} AS prediction FROM __THIS__")
    return PipelineModel([_assembler(features), *forests, whole])


# -- model files ---------------------------------------------------------------------
def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# -- predictions --------------------------------------------------------------------
def predict_volume(model: PipelineModel, df: DataFrame, into: str = "pred") -> DataFrame:
    return model.transform(df).withColumnRenamed("prediction", into).drop("features")


def predict_risk(model: PipelineModel, df: DataFrame, into: str = "score") -> DataFrame:
    return (
        model.transform(df)
        .withColumn(into, vector_to_array("probability")[1])
        .drop("features", "rawPrediction", "probability", "prediction")
    )


def score_volume(model: PipelineModel, scenarios: DataFrame) -> DataFrame:
    """Predicted volume per validated scenario, one decimal."""
    scored = predict_volume(model, scenarios, "_volume")
    return scored.withColumn("predicted_traffic_volume", F.round("_volume", 1)).drop("_volume")


def score_risk(model: PipelineModel, scenarios: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Risk probability per validated scenario, four decimals, and the yes/no call."""
    scored = predict_risk(model, scenarios, "_risk")
    return scored.withColumns({
        "high_risk_probability": F.round("_risk", 4), "high_risk_prediction": F.col("_risk") >= threshold,
    }).drop("_risk")


def scenario_answers(
    spark: SparkSession, volume_model: PipelineModel | None = None, risk_model: PipelineModel | None = None
) -> DataFrame:
    """Every valid scenario with the answers of the given models, written once.

    Requests outnumber what can be asked by far: they look their answers up (``scenarios.look_up``) instead of
    each walking down every tree.
    """
    answers = scenario_features(every_scenario(spark))
    if volume_model is not None:
        answers = score_volume(volume_model, answers)
    if risk_model is not None:
        answers = score_risk(risk_model, answers)
    # Features hold the holiday as a number, requests as yes or no.
    answers = answers.withColumn("is_holiday", F.col("is_holiday").cast("boolean")).drop(*[f for f in S.FEATURES if f not in ASKED])
    return stage(answers, "scenario_answers")


# -- explanations ----------------------------------------------------------------------
def linear_contributions(
    model: PipelineModel, df: DataFrame, features: Sequence[str] = tuple(S.FEATURES)
) -> DataFrame:
    """Mean absolute contribution ``|coefficient * (x - mean)|`` per feature.

    For a linear model these are the exact additive attributions.
    """
    coefficients = dict(zip(features, model.stages[-1].coefficients.toArray().tolist()))
    cells = df.groupBy(*features).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    means = cells.agg(*[(F.sum(F.col(f) * F.col("n")) / total).alias(f"{f}_mean") for f in features])
    spread = cells.crossJoin(F.broadcast(means)).agg(*[  # one row
        (F.sum(F.abs(F.lit(coefficients[f]) * (F.col(f) - F.col(f"{f}_mean"))) * F.col("n")) / total).alias(f)
        for f in features
    ])
    entries = [F.struct(F.lit(f).alias("feature"), F.col(f).alias("contribution")) for f in features]
    return spread.select(F.inline(F.array(*entries))).orderBy(F.desc("contribution"), "feature")


def logistic_gradient(
    model: PipelineModel, train: DataFrame, features: Sequence[str] = tuple(S.FEATURES), label: str = "high_risk"
) -> DataFrame:
    """Per feature: weighted sum of its values over positive rows, and what is left of the loss's gradient.

    At the optimum the sum of weight x (probability - label) x value and the penalty cancel; ``relative`` is their
    difference as a share of the sum of weight x absolute value.  The intercept is a feature that is always 1.
    """
    fitted = model.stages[-1]
    cells = classification_cells(train, features, label)
    p, w, y = F.col("_p"), F.col("weight"), F.col("label")
    scored = predict_risk(model, cells, "_p")
    slopes = [*zip(features, fitted.coefficients.toArray().tolist(), [F.col(f) for f in features]), ("intercept", 0.0, F.lit(1.0))]
    rate = fitted.getRegParam()
    sums = scored.agg(*[
        F.struct(
            F.lit(name).alias("feature"), F.sum(w * y * x).alias("positive_sum"),
            (F.abs(F.sum(w * (p - y) * x) + rate * slope * F.sum(w)) / F.sum(w * F.abs(x))).alias("relative"),
        ).alias(f"g{i}")
        for i, (name, slope, x) in enumerate(slopes)
    ])
    return sums.select(F.inline(F.array(*[f"g{i}" for i in range(len(slopes))])))


def permutation_importance(
    model: PipelineModel,
    df: DataFrame,
    features: Sequence[str],
    target: str = S.VOLUME,
    seed: int = 42,
) -> DataFrame:
    """Rise in mean absolute error when one feature's values are shuffled, over all rows.

    Rows are dealt by hash into ranges of about ``EXCHANGE_ROWS``; each takes
    the value of the next row of its range in hash order.  All features are
    scored in a single pass.
    """
    rows = stage(df.select(*S.KEY, S.TS, target, *features), "importance_rows")
    ranges = max(1, round(rows.count() / EXCHANGE_ROWS))
    place = F.xxhash64(F.lit(seed), *S.KEY, S.TS)
    mixed = Window.partitionBy("_range").orderBy(F.xxhash64(F.lit(seed + 1), *S.KEY, S.TS), *S.KEY, S.TS)
    whole = mixed.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    donor = F.struct(*features)
    paired = rows.withColumn("_range", F.pmod(place, F.lit(ranges))).withColumn("_donor", F.coalesce(F.lead(donor).over(mixed), F.first(donor).over(whole)))
    # Ranges may be fewer than cores; the copies of rows are scored in as many tasks as there are cores, or more.
    paired = paired.drop("_range").repartition(max(2 * df.sparkSession.sparkContext.defaultParallelism, ranges))
    paired = paired.withColumn("_shuffled", F.explode(F.array(F.lit(""), *[F.lit(f) for f in features])))
    variants = paired.withColumns({
        f: F.when(F.col("_shuffled") == f, F.col(f"_donor.{f}")).otherwise(F.col(f)) for f in features
    })
    errors = regression_metrics(predict_volume(model, variants), target, "pred", by=["_shuffled"])
    base = errors.filter("_shuffled = ''").select(F.col("MAE").alias("_base"))
    return (
        errors.filter("_shuffled <> ''")
        .crossJoin(F.broadcast(base))  # one row
        .select(F.col("_shuffled").alias("feature"), (F.col("MAE") - F.col("_base")).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )
