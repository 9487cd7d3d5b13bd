"""Tree ensembles as Spark ML models: the nodes are written in the layout in
which Spark ML keeps ensembles and loaded by it, so that scoring runs in the
JVM, in batch and in streams, and the model is saved and loaded as any other.

Nodes: (tree, id, feature, threshold, left, right, n, w0, w1, gain) of a
forest; of boosting (tree, id, feature, threshold, left, right, cover,
value, gain). Leaves have feature -1; rows go left at values up to the
threshold.
"""

from __future__ import annotations

import json
import uuid

from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from . import trees as T

BOOSTED = "tree int, id int, feature int, threshold double, left int, right int, cover double, value double, gain double"
_STAGE = {
    "forest": ("org.apache.spark.ml.classification.RandomForestClassificationModel", "org.apache.spark.ml.classification.DecisionTreeClassificationModel"),
    "boost": ("org.apache.spark.ml.classification.GBTClassificationModel", "org.apache.spark.ml.regression.DecisionTreeRegressionModel"),
}


def boosted_nodes(spark: SparkSession, ensemble: list[T.Tree], bins: T.Bins) -> DataFrame:
    """Nodes of boosted trees; ``cover`` is the sum of second derivatives."""
    rows = [(t, i, f, float(bins.cuts[f][c]) if f >= 0 else 0.0, a, b, s[1] / T.UNIT, v, g)
            for t, tree in enumerate(ensemble)
            for i, (f, c, a, b, s, v, g) in enumerate(zip(tree.feature, tree.cut, tree.left, tree.right, tree.stats, tree.value, tree.gain))]
    return spark.createDataFrame(rows, BOOSTED)


def load(nodes: DataFrame, kind: str, width: int, max_depth: int = 30):
    """The Spark ML model of an ensemble's nodes. Probabilities of a forest
    are the mean shares of its leaves, those of boosting the logistic
    function of the sum of its leaves."""
    spark = nodes.sparkSession
    path = shared_path(spark, "models", kind)
    leaf = F.col("feature") < 0
    if kind == "forest":
        stats, share = F.array("w0", "w1"), F.col("w1") / F.greatest(F.col("w0") + F.col("w1"), F.lit(1e-300))
        prediction, impurity, count = (F.col("w1") > F.col("w0")).cast("double"), 2 * share * (1 - share), F.col("n")
        tree_weight = 1.0
    else:
        stats, prediction, impurity, count = F.array("cover", F.lit(0.0), F.lit(0.0)), F.col("value"), F.lit(0.0), F.ceil("cover")
        tree_weight = 0.5  # Spark's probability is the logistic function of twice the margin
    split = F.struct(F.col("feature").alias("featureIndex"), F.when(leaf, F.array().cast("array<double>")).otherwise(F.array("threshold")).alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    node = F.struct(F.col("id"), prediction.alias("prediction"), impurity.cast("double").alias("impurity"), stats.alias("impurityStats"), count.cast("long").alias("rawCount"),
                    F.when(leaf, -1.0).otherwise(F.col("gain")).alias("gain"), F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split"))
    nodes.select(F.col("tree").alias("treeID"), node.alias("nodeData")).write.parquet(f"{path}/data")
    n_trees = nodes.agg(F.max("tree")).first()[0] + 1
    whole, one = _STAGE[kind]

    def metadata(name: str, given: dict | None = None, **more) -> str:
        params = {"maxDepth": min(max_depth, 30), "impurity": "gini" if kind == "forest" else "variance", "featuresCol": "features", "labelCol": "label", "predictionCol": "prediction"}
        if "classification" in name:
            params |= {"probabilityCol": "probability", "rawPredictionCol": "rawPrediction"}
        return json.dumps({"class": name, "timestamp": 0, "sparkVersion": spark.version, "uid": f"{kind}_{uuid.uuid4().hex[:12]}", "paramMap": given or {}, "defaultParamMap": params, **more})

    extra = {"numFeatures": width, "numTrees": n_trees, **({"numClasses": 2} if kind == "forest" else {})}
    spark.createDataFrame([(metadata(whole, {"numTrees" if kind == "forest" else "maxIter": n_trees}, **extra),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    trees = [(t, metadata(one, numFeatures=width, numClasses=2) if kind == "forest" else metadata(one, numFeatures=width), tree_weight) for t in range(n_trees)]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    return (RandomForestClassificationModel if kind == "forest" else GBTClassificationModel).load(path)


def importance(nodes: DataFrame, kind: str) -> DataFrame:
    """(feature int, importance): of a forest, each tree's impurity decreases
    by weight, as shares, averaged; of boosting, a feature's mean gain per
    split, as shares. Features without splits are left out."""
    splits = nodes.where("feature >= 0")
    if kind == "forest":
        each = splits.groupBy("tree", "feature").agg(F.sum(F.col("gain") * (F.col("w0") + F.col("w1"))).alias("v"))
        total = each.groupBy("tree").agg(F.sum("v").alias("total"))
        each = each.join(total, "tree").where("total > 0").groupBy("feature").agg(F.sum(F.col("v") / F.col("total")).alias("v"))
    else:
        each = splits.groupBy("feature").agg(F.avg("gain").alias("v"))
    whole = each.agg(F.sum("v").alias("whole"))
    return each.join(F.broadcast(whole)).select("feature", (F.col("v") / F.col("whole")).alias("importance"))  # one row of sums
