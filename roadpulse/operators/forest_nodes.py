"""Tree ensembles as tables of nodes: predictions and attributions by walking from root to leaf.

A saved forest or boosted model is read back as rows (tree, node, feature, threshold, left, right, value,
weight).  A row of features meets every tree and walks down its nodes inside one column expression, so
scores can be recomputed and explained with joins and sums alone, without the model object.

Attributions follow the path: each step from a node to its child changes the mean value, and the
change belongs to the feature that the node asks for.  A row's changes and the roots' values add up to its prediction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.sources.storage import stage

#: Nodes of all trees together up to which the trees are broadcast (some 60 bytes each).
BROADCAST_NODES = 1_000_000


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of all trees in a saved pipeline; ``feature`` is -1 at leaves, ``depth`` what trees may have.

    ``value`` is a node's mean (for two classes, the share of the second), ``weight`` what its tree counts in the sum.
    A forest grown in parts is one table with its trees numbered through.
    """
    stages = PipelineModel.load(path).stages
    digits = len(str(len(stages)))
    members = [(i, s) for i, s in enumerate(stages) if hasattr(s, "treeWeights")]
    averaged = any("RandomForest" in type(s).__name__ for _, s in members)
    total, before, tables = sum(s.getNumTrees for _, s in members), 0, []
    for i, member in members:
        folder = f"{path}/stages/{i:0{digits}d}_{member.uid}"
        tables.append(_nodes_of(spark, folder, member, before, 1.0 / total if averaged else None))
        before += member.getNumTrees
    first, *others = tables
    for other in others:
        first = first.unionAll(other)
    return first


def _nodes_of(spark: SparkSession, folder: str, model: Model, before: int, weight: float | None) -> DataFrame:
    trees = spark.read.parquet(f"{folder}/treesMetadata")
    own = F.col(trees.columns[-1]).cast("double") if weight is None else F.lit(weight)
    trees = trees.select(F.col(trees.columns[0]).alias("tree"), own.alias("weight"))
    node = F.col("nodeData")
    share = F.get(node["impurityStats"], F.lit(1)) / F.aggregate(node["impurityStats"], F.lit(0.0), lambda a, b: a + b)
    nodes = spark.read.parquet(f"{folder}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        (share if getattr(model, "numClasses", 0) == 2 else node["prediction"]).alias("value"), F.lit(model.getMaxDepth()).alias("depth"),
    )
    return nodes.join(trees, "tree").withColumn("tree", F.col("tree") + before)


def _by_tree(nodes: DataFrame) -> DataFrame:
    """One row for each tree with its nodes in order; a tree's size is bounded by its depth."""
    packed = F.array_sort(F.collect_list(F.struct("node", "feature", "threshold", "left", "right", "value")))
    return nodes.groupBy("tree").agg(packed.alias("nodes"), F.first("weight").alias("weight"), F.first("depth").alias("depth"))


def _next(nodes: Column, at: Column, features: Column) -> Column:
    """The child that a row goes to, or the node itself at a leaf."""
    node = F.get(nodes, at)
    below = F.when(F.get(features, node["feature"]) <= node["threshold"], node["left"]).otherwise(node["right"])
    return F.when(node["left"] < 0, at).otherwise(below)


def _with_trees(rows: DataFrame, nodes: DataFrame) -> tuple[DataFrame, int]:
    """Every row once for each tree, and how deep trees may be."""
    trees = stage(_by_tree(nodes), "trees")
    trees_, size, depth = trees.agg(F.count(F.lit(1)), F.sum(F.size("nodes")), F.max("depth")).first()
    each = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(max(trees_, 1) - 1))))
    return each.join(F.broadcast(trees) if (size or 0) <= BROADCAST_NODES else trees, "tree"), depth or 0


def predict(rows: DataFrame, nodes: DataFrame, features: Sequence[str], key: str, into: str = "replayed") -> DataFrame:
    """(key, prediction) of rows with distinct keys."""
    vector = F.array(*[F.col(f).cast("double") for f in features])
    each, depth = _with_trees(rows.select(key, vector.alias("_x")), nodes)
    at = F.aggregate(F.sequence(F.lit(0), F.lit(depth)), F.lit(0), lambda at, _: _next(F.col("nodes"), at, F.col("_x")))
    leaves = each.select(key, (F.col("weight") * F.get(F.col("nodes"), at)["value"]).alias("_part"))
    return leaves.groupBy(key).agg(F.sum("_part").alias(into))


def contributions(rows: DataFrame, nodes: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """(key, feature, contribution) of every feature that a row's paths ask for, and the roots' sum as feature NULL."""
    vector = F.array(*[F.col(f).cast("double") for f in features])
    each, depth = _with_trees(rows.select(key, vector.alias("_x")), nodes)
    nodes_, x = F.col("nodes"), F.col("_x")
    steps = F.array().cast("array<struct<feature:int,change:double>>")

    def step(state: Column, _: Column) -> Column:
        here = F.get(nodes_, state["at"])
        then = _next(nodes_, state["at"], x)
        change = F.struct(here["feature"].alias("feature"), (F.get(nodes_, then)["value"] - here["value"]).alias("change"))
        return F.struct(then.alias("at"), F.when(here["left"] < 0, state["steps"]).otherwise(F.array_append(state["steps"], change)).alias("steps"))

    root = F.array(F.struct(F.lit(-1).alias("feature"), F.get(nodes_, F.lit(0))["value"].alias("change")))
    path = F.aggregate(
        F.sequence(F.lit(0), F.lit(depth)), F.struct(F.lit(0).alias("at"), steps.alias("steps")), step, lambda s: F.concat(root, s["steps"])
    )
    names = F.array(*[F.lit(f) for f in features])
    parts = each.select(key, "weight", F.explode(path).alias("_step"))
    return (
        parts.groupBy(key, F.col("_step.feature").alias("_feature"))
        .agg(F.sum(F.col("weight") * F.col("_step.change")).alias("contribution"))
        .select(key, F.when(F.col("_feature") >= 0, F.get(names, F.col("_feature"))).alias("feature"), "contribution")
    )


def with_keys(rows: DataFrame, features: Sequence[str], key: str = "cell") -> DataFrame:
    """Distinct feature combinations with a number each and their row count ``n``, written once so that numbers stay."""
    return stage(rows.groupBy(*features).agg(F.count(F.lit(1)).alias("n")).withColumn(key, F.monotonically_increasing_id()), "feature-cells")
