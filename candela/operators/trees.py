"""F5, M2, M4 for trees: fitted trees as column expressions, and boosting with a real early stop.

A fitted tree is a handful of thresholds, so it is a nested ``CASE WHEN`` over the lagged values.  As a
column it predicts inside whole-stage code, without vectors, and it can be folded over the days
of a roll-out in one higher-order ``aggregate`` on one row per ticker.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Feature = Callable[[int], Column]


def tree_column(tree, at: Feature) -> Column:
    """The prediction of a fitted regression tree, given the column of each feature."""
    def value(node) -> Column:
        if node.subtreeDepth() == 0:
            return F.lit(float(node.prediction()))
        split = node.split()
        left, right = value(node.leftChild()), value(node.rightChild())
        return F.when(at(split.featureIndex()) <= F.lit(float(split.threshold())), left).otherwise(right)

    return value(tree._java_obj.rootNode())


def model_column(model, at: Feature) -> Column:
    """The prediction of a fitted model of weighted trees (or of one tree)."""
    if not hasattr(model, "trees"):
        return tree_column(model, at)
    return reduce(add, (tree_column(t, at) * F.lit(float(w)) for t, w in zip(model.trees, model.treeWeights)))


class BoostedTrees:
    """Trees grown one after the other on what those before leave over."""

    def __init__(self, trees: list, treeWeights: list[float]):
        self.trees, self.treeWeights = list(trees), list(treeWeights)

    def transform(self, samples: DataFrame, x: str = "x", out: str = "yhat_s") -> DataFrame:
        return samples.withColumn(out, model_column(self, lambda i: F.element_at(x, i + 1)))

    def save_to(self, path: str) -> None:
        """Each tree in its own folder, the weights beside them."""
        for i, tree in enumerate(self.trees):
            tree.write().overwrite().save(f"{path}/tree={i}")
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(self.treeWeights),)], "value string").write.mode("overwrite").text(f"{path}/weights")

    @classmethod
    def load_from(cls, spark: SparkSession, path: str) -> BoostedTrees:
        from pyspark.ml.regression import DecisionTreeRegressionModel
        weights = json.loads(spark.read.text(f"{path}/weights").first()[0])
        return cls([DecisionTreeRegressionModel.load(f"{path}/tree={i}") for i in range(len(weights))], weights)


def grow_until(train: DataFrame, valid: DataFrame, epochs: int, patience: int, depth: int = 3, step: float = 0.1,
               seed: int = 7) -> tuple[BoostedTrees, list[float]]:
    """M4: least-squares boosting that ends when ``patience`` rounds in a row bring no better validation loss.

    A round fits one tree to the residuals (the first to the values themselves) and measures the mean squared
    error of the validation rows in one aggregate; no round is grown that is not needed to know that.
    Returns the trees of the best round and the validation loss of every round grown.
    """
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import DecisionTreeRegressor
    trees, weights, losses = [], [], []
    at = lambda i: F.element_at("x", i + 1)
    rows = train.select(array_to_vector("x").alias("features"), "x", "y")
    best = 0
    for i in range(max(int(epochs), 1)):
        rest = F.col("y") - model_column(BoostedTrees(trees, weights), at) if trees else F.col("y")
        grower = DecisionTreeRegressor(featuresCol="features", labelCol="rest", maxDepth=depth, seed=seed)
        trees.append(grower.fit(rows.withColumn("rest", rest)))
        weights.append(step if i else 1.0)
        error = F.col("y") - model_column(BoostedTrees(trees, weights), at)
        losses.append(valid.agg(F.avg(error * error)).first()[0])
        if losses[i] is None or losses[i] < losses[best]:
            best = i
        elif i - best >= max(int(patience), 1):
            break
    return BoostedTrees(trees[:best + 1], weights[:best + 1]), losses
