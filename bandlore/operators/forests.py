"""Random forests with a minimum number of rows to split, by cutting fitted trees.

Growth is greedy: what happens below a node never changes the node itself. So the forest that splits no node of fewer
than ``bound`` rows is the unbounded forest with every such node made a leaf, and one fit serves every bound.
"""

from pyspark.ml import Estimator
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Window
from pyspark.sql import functions as F

from bandlore.session import removed, scratch_path

def node_table(spark, path):
    """One row per node of the forest saved at ``path``: treeID, id (0 is the root, a parent before its left and that
    before its right subtree), rawCount (rows drawn for the tree that reach it), its class counts, children (-1: none)
    and split."""
    return spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")


def cut_nodes(nodes, bound):
    """The node table in which nodes of fewer than ``bound`` rows are leaves, numbered anew.

    A node stays if its parent still splits. Counts only fall on the way down, so nothing below a leaf has such a parent.
    """
    below = nodes.where("leftChild >= 0").select(
        "treeID", F.explode(F.array("leftChild", "rightChild")).alias("id"), (F.col("rawCount") >= bound).alias("reached"))
    kept = nodes.join(below, ["treeID", "id"], "left").where(F.coalesce("reached", F.lit(True))).drop("reached")
    # a tree's nodes, which its model holds in memory anyway
    kept = kept.withColumn("new", F.row_number().over(Window.partitionBy("treeID").orderBy("id")) - 1)
    right = kept.select("treeID", F.col("id").alias("rightChild"), F.col("new").alias("new_right"))
    kept = kept.join(right, ["treeID", "rightChild"], "left")
    splits = (F.col("leftChild") >= 0) & (F.col("rawCount") >= bound)
    none = F.struct(F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"),
                    F.lit(-1).alias("numCategories"))
    return kept.select(
        "treeID", F.col("new").alias("id"), "prediction", "impurity", "impurityStats", "rawCount",
        F.when(splits, F.col("gain")).otherwise(-1.0).alias("gain"),
        F.when(splits, F.col("new") + 1).otherwise(-1).alias("leftChild"),
        F.when(splits, F.col("new_right")).otherwise(-1).alias("rightChild"),
        F.when(splits, F.col("split")).otherwise(none).alias("split"))


def with_minimum_to_split(spark, model, bound):
    """The fitted forest without the splits of nodes of fewer than ``bound`` rows.

    Rows are counted as drawn for the tree, repeats included, as for the leaf minimum. Up to 2 nothing changes: a node of
    one row is never split.
    """
    if bound <= 2:
        return model
    whole, cut = scratch_path(spark, "forest"), scratch_path(spark, "forest")
    try:
        for path in (whole, cut):
            model.write().save(path)
        nodes = cut_nodes(node_table(spark, whole), bound)
        fields = [c for c in nodes.columns if c != "treeID"]
        nodes.select("treeID", F.struct(*fields).alias("nodeData")).write.mode("overwrite").parquet(f"{cut}/data")
        return RandomForestClassificationModel.load(cut)
    finally:
        removed(spark, whole)
        removed(spark, cut)


class BoundedForest(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """A Gini forest that splits no node of fewer than ``minSplit`` rows."""

    minSplit = Param(Params._dummy(), "minSplit", "fewest rows of a node that is split", TypeConverters.toInt)
    settings = Param(Params._dummy(), "settings", "parameters of the forest", TypeConverters.identity)

    def __init__(self, minSplit=2, **settings):
        super().__init__()
        self._set(minSplit=minSplit, settings=settings)

    def _fit(self, dataset):
        whole = RandomForestClassifier(**self.getOrDefault("settings")).fit(dataset)
        return with_minimum_to_split(dataset.sparkSession, whole, self.getOrDefault("minSplit"))
