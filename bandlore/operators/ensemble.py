"""Soft voting over members and two-tier stacking, row by row."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.operators import evaluate as E
from bandlore.operators import models as M
from bandlore.operators.training import _fit

VOTING = "Soft-Voting Ensemble"
STACKING = "Stacking Classifier"
ENSEMBLE = "ensemble"  # the folder that marks a saved ensemble


def member_probabilities(df, members, out="_members"):
    """Add the array of the members' probabilities; the rows stay where they are."""
    scored = df
    for i, (_, model) in enumerate(members.items()):
        scored = M.with_scores(model, scored).drop("pred_label").withColumnRenamed("prob", f"_p{i}")
    probs = F.array(*[F.col(f"_p{i}") for i in range(len(members))])
    return scored.withColumn(out, probs).drop(*[f"_p{i}" for i in range(len(members))])


class VotingModel:
    """Weighted mean of the member probabilities; members are refitted on the rows given."""

    def __init__(self, makers):
        self.makers = makers

    def fit(self, train):
        self.members = {name: _fit(make, train) for name, make in self.makers.items()}
        return self

    def transform(self, df):
        names = list(self.members)
        weights = E.voting_weights(names) or dict.fromkeys(names, 1.0)
        parts = [F.col("_members")[i] * w for i, w in enumerate(weights.values())]
        mean = sum(parts[1:], parts[0]) / sum(weights.values())
        voted = member_probabilities(df, self.members).withColumn("prob", mean).drop("_members")
        return voted.withColumn("pred_label", (F.col("prob") >= K.DEFAULT_TAU).cast("int"))

    def save(self, path):
        return _save(self.members, path)

    @classmethod
    def load(cls, spark, path):
        model = cls({})
        model.members, _ = _load(spark, path)
        return model


class StackingModel:
    """Logistic meta-model over out-of-fold member probabilities; members refitted on all rows."""

    def __init__(self, makers, k=5):
        self.makers, self.k = makers, k

    def fit(self, folded):
        parts = None
        for f in range(self.k):
            rest = folded.where(F.col("fold") != f)
            members = {name: _fit(make, rest) for name, make in self.makers.items()}
            part = member_probabilities(folded.where(F.col("fold") == f), members).select("id", "y", "_members")
            parts = part if parts is None else parts.unionByName(part)
        meta = parts.select("id", "y", array_to_vector("_members").alias("meta")).persist()
        self.meta_model = M.logistic(meta.count(), features="meta").fit(meta)
        meta.unpersist()
        self.members = {name: _fit(make, folded) for name, make in self.makers.items()}
        return self

    def transform(self, df):
        scored = member_probabilities(df, self.members).withColumn("meta", array_to_vector("_members"))
        return M.with_scores(self.meta_model, scored).drop("meta", "_members")

    def save(self, path):
        return _save(self.members, path, self.meta_model)

    @classmethod
    def load(cls, spark, path):
        model = cls({})
        model.members, model.meta_model = _load(spark, path)
        return model


def _save(members, path, meta=None):
    """A folder per member, numbered in listing order, the meta model, and the names as a small table."""
    from pyspark.sql import SparkSession

    from bandlore.sources import sinks

    spark = SparkSession.getActiveSession()
    for i, model in enumerate(members.values()):
        sinks.save_model(model, f"{path}/member_{i}")
    if meta is not None:
        sinks.save_model(meta, f"{path}/meta")
    rows = [(i, name, meta is not None) for i, name in enumerate(members)]
    table = spark.createDataFrame(rows, "number int, name string, stacked boolean")
    table.coalesce(1).write.mode("overwrite").json(f"{path}/{ENSEMBLE}")
    return path


def _load(spark, path):
    from bandlore.sources import sinks

    rows = _listed(spark, path).orderBy("number").collect()
    members = {r["name"]: sinks.load_model(spark, f"{path}/member_{r['number']}") for r in rows}
    return members, sinks.load_model(spark, f"{path}/meta") if rows[0]["stacked"] else None


def _listed(spark, path):
    return spark.read.schema("number int, name string, stacked boolean").json(f"{path}/{ENSEMBLE}")


def load_ensemble(spark, path):
    """A saved voting or stacking model; its table of names tells which."""
    return (StackingModel if _listed(spark, path).head()["stacked"] else VotingModel).load(spark, path)
