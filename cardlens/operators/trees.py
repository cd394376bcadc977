"""Fitted trees as tables: a row for each node, read from the model as it is stored."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlens.session import scratch_folder


def tree_nodes(model: Model, features: list[str], spark: SparkSession) -> DataFrame:
    """``tree, node, feature, threshold, left, right, gain, prediction, weight, row_count``.

    Inner nodes send rows at or below the threshold of a feature to the left. ``weight`` and
    ``row_count`` are what the training rows add up to there (drawn rows count as often as they
    were drawn). Leaves have no feature, threshold, children or gain.
    """
    path = scratch_folder(spark, "trees")
    model.save(path)
    data = spark.read.parquet(f"{path}/data")
    tree = F.col("treeID") if "treeID" in data.columns else F.lit(0)
    node = data.select(tree.cast("int").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0
    # class weights add up for a classifier; a regressor's first statistic is the weight
    counts = F.aggregate("impurityStats", F.lit(0.0), lambda total, part: total + part)
    weight = counts if _counts_classes(model) else F.col("impurityStats")[0]
    place = F.col("split.featureIndex")
    return node.select(
        "tree",
        F.col("id").alias("node"),
        F.when(inner, F.get(F.array(*map(F.lit, features)), place)).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, F.col("gain")).alias("gain"),
        "prediction",
        weight.alias("weight"),
        F.col("rawCount").alias("row_count"),
    )


def _counts_classes(model: Model) -> bool:
    """A forest of class counts; boosted trees fit residuals as numbers."""
    kind = type(model).__name__
    return kind.endswith("ClassificationModel") and not kind.startswith("GBT")


def importances(nodes: DataFrame, features: list[str], name: str, per_tree: bool = True) -> DataFrame:
    """``model, feature, importance, place``: each input's share of the weighted gains.

    With ``per_tree`` every tree that splits at all counts the same, as in a forest; boosted
    trees add up as they are. Inputs without a split have importance 0.
    """
    gains = nodes.where("feature IS NOT NULL").groupBy("tree", "feature").agg(
        F.sum(F.col("gain") * F.col("weight")).alias("gain")
    )
    if per_tree:
        whole = F.sum("gain").over(Window.partitionBy("tree"))  # a row for each input
        gains = gains.select("feature", F.try_divide("gain", whole).alias("gain"))
    inputs = nodes.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    sums = gains.groupBy("feature").agg(F.sum("gain").alias("gain"))
    listed = inputs.join(sums, "feature", "left").select("feature", F.coalesce("gain", F.lit(0.0)).alias("gain"))
    everything = Window.partitionBy()  # as many rows as inputs
    share = F.coalesce(F.try_divide("gain", F.sum("gain").over(everything)), F.lit(0.0))
    place = F.row_number().over(Window.orderBy(F.desc("importance"), "feature"))
    return listed.select(F.lit(name).alias("model"), "feature", share.alias("importance")).withColumn("place", place)
