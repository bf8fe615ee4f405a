"""Boosted trees as a table: stored, read, scored and weighed without the model that made them.

One row per node: ``tree, weight, node, feature, threshold, left, right, prediction, gain, rows``.
A leaf has NULL in ``feature``, ``threshold``, ``left``, ``right`` and ``gain``; node 0 is a tree's root.
A row goes left where its feature is at most the threshold. The score is the sum over all trees
of the weight times the prediction of the leaf that is reached.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Nodes a forest may have to be carried to the rows; 400 trees of depth 6 have at most 50,800.
MOST_NODES = 1_000_000


def store_trees(model: GBTRegressionModel, path: str) -> DataFrame:
    """Save a model at ``path`` and give its node table, read from there."""
    model.write().overwrite().save(path)
    return read_trees(SparkSession.active(), path)


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    """Node table of a saved model; splits are on numbers, as ``assemble`` makes no categories."""
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "_settings", "weight")
    node = F.col("nodeData")
    inner = node["leftChild"] >= 0
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        F.when(inner, node["split"]["featureIndex"]).alias("feature"),
        F.when(inner, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner, node["leftChild"]).alias("left"),
        F.when(inner, node["rightChild"]).alias("right"),
        node["prediction"].alias("prediction"),
        F.when(inner, node["gain"]).alias("gain"),
        F.get(node["impurityStats"], F.lit(0)).alias("rows"),
    )
    return nodes.join(weights.select("tree", "weight"), "tree").select(
        "tree", "weight", "node", "feature", "threshold", "left", "right", "prediction", "gain", "rows"
    )


def _forest(trees: DataFrame) -> DataFrame:
    """All trees in one row: per tree its weight and its nodes, each at its number's place."""
    node = F.struct("node", "feature", "threshold", "left", "right", "prediction")
    by_tree = trees.groupBy("tree").agg(
        F.max("weight").alias("weight"), F.sort_array(F.collect_list(node)).alias("nodes")
    )
    return by_tree.agg(F.sort_array(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("forest"))


def score_trees(
    df: DataFrame,
    trees: DataFrame,
    features: Sequence[str],
    out: str,
    most_nodes: int = MOST_NODES,
    size: tuple[int, int] | None = None,
) -> DataFrame:
    """Adds the score as ``out``. A feature that is NULL or NaN counts as 0, like in training.

    The forest comes to the rows as one scalar value, after a check of its size; every row then
    walks the trees in expressions. No join, no shuffle of the rows and no Python. Without any
    tree the score is 0. ``size`` is ``forest_size(trees)`` where that is known already.
    """
    nodes, deepest = size or forest_size(trees)
    if nodes > most_nodes:
        raise ValueError(f"a forest of {nodes} nodes, more than {most_nodes}")
    values = F.array(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in features])

    def leaf_value(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree["nodes"], at)
            down = F.when(F.get(F.col("_values"), node["feature"]) <= node["threshold"], node["left"])
            return F.when(node["left"].isNull(), at).otherwise(down.otherwise(node["right"]))

        steps = F.sequence(F.lit(1), F.lit(deepest)) if deepest else F.array().cast("array<int>")
        return F.get(tree["nodes"], F.aggregate(steps, F.lit(0), step))["prediction"]

    total = F.aggregate("_trees", F.lit(0.0), lambda sum_, tree: sum_ + tree["weight"] * leaf_value(tree))
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), values.alias("_values"))
    with_forest = row.withColumn("_trees", _forest(trees).scalar())
    scored = with_forest.select("_row", F.coalesce(total, F.lit(0.0)).alias("_score"))
    kept = [c for c in df.columns if c != out]
    return scored.select(*[F.col("_row")[c].alias(c) for c in kept], F.col("_score").alias(out))


def forest_size(trees: DataFrame) -> tuple[int, int]:
    """Number of nodes, and the most inner nodes on any way down.

    Nodes are numbered before their children, so a tree's depth is found in one pass over its
    sorted nodes; only the two largest numbers come to the driver.
    """
    node = F.struct("node", "left", "right")
    by_tree = trees.groupBy("tree").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    levels = F.aggregate(
        "nodes",
        F.create_map(F.lit(0), F.lit(0)),
        lambda at, n: F.when(n["left"].isNull(), at).otherwise(
            F.map_concat(
                at,
                F.create_map(n["left"], at[n["node"]] + 1, n["right"], at[n["node"]] + 1),
            )
        ),
    )
    depth = F.array_max(F.map_values(levels))
    found = by_tree.agg(F.sum(F.size("nodes")), F.max(depth)).first()
    return int(found[0] or 0), int(found[1] or 0)


def tree_importance(trees: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Share of each feature in all gains, weighted by the rows of the split; largest first.

    One row per feature, 0 for those no tree splits on.
    """
    names = F.array(*[F.lit(f) for f in features])
    gains = (
        trees.filter("feature IS NOT NULL")
        .groupBy("feature")
        .agg(F.sum(F.col("gain") * F.col("rows")).alias("_gain"))
    )
    total = gains.agg(F.sum("_gain")).scalar()
    spark = trees.sparkSession
    listed = spark.range(1).select(F.posexplode(names).alias("feature", "feature_name"))
    share = F.when(total > 0, F.col("_gain") / total)
    return (
        listed.join(gains, "feature", "left")
        .select("feature_name", F.coalesce(share, F.lit(0.0)).alias("importance"), F.lit(target).alias("target_metric"))
        .orderBy(F.desc("importance"), "feature_name")
    )
