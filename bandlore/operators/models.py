"""Classifiers as ML pipelines with one common output: prob and pred_label."""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.functions import vectors as V
from bandlore.operators.deep_forests import DeepForestModel
from bandlore.operators.forests import BoundedForest
from bandlore.operators.neighbors import KnnClassifier
from bandlore.operators.sampling import class_counts, order_key, stratified_folds
from bandlore.session import removed, scratch_path

LOGISTIC = "Logistic Regression"
NEIGHBORS = "K-Nearest Neighbors"
SVM = "Support Vector Machine"
FOREST = "Random Forest"
MLP = "Deep Neural Network (MLP)"

#: Rows that one task maps to kernel values.
MAPPED_ROWS = 4096


def logistic(n_rows, c=1.0, features="scaled", label="y"):
    """L2 logistic regression; the penalty follows from C and the rows of this very fit."""
    return LogisticRegression(
        featuresCol=features, labelCol=label, regParam=1.0 / (c * n_rows), elasticNetParam=0.0,
        standardization=False, maxIter=1000,
    )


def forest(trees=100, depth=None, min_leaf=1, subset="sqrt", seed=42, features="scaled", label="y", min_split=2,
           bootstrap=True):
    """Gini forest. No depth limit means the deepest trees Spark builds, 30 levels."""
    settings = dict(
        featuresCol=features, labelCol=label, numTrees=trees, impurity="gini",
        maxDepth=30 if depth is None else depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy=subset, seed=seed, maxMemoryInMB=1024, bootstrap=bootstrap,
    )
    return RandomForestClassifier(**settings) if min_split <= 2 else BoundedForest(min_split, **settings)


def perceptron(layers=(K.N_BANDS, 64, 32, 2), iterations=600, seed=42, features="scaled", label="y"):
    return MultilayerPerceptronClassifier(
        featuresCol=features, labelCol=label, layers=list(layers), maxIter=iterations, seed=seed,
    )


def training_loss(model):
    """(iteration, loss) of a fitted perceptron or logistic model."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    summary = last.summary
    history = (summary() if callable(summary) else summary).objectiveHistory
    rows = [(i, float(v)) for i, v in enumerate(history)]
    return _spark().createDataFrame(rows, "iteration int, loss double")


def _spark():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


class ArrayToVector(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    inputCol = Param(Params._dummy(), "inputCol", "array column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    def __init__(self, inputCol="features", outputCol="scaled"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, dataset):
        return dataset.withColumn(
            self.getOrDefault("outputCol"), array_to_vector(F.col(self.getOrDefault("inputCol")))
        )


class KernelMap(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Features whose dot products approximate the RBF kernel, from landmark rows.

    A row becomes its kernel values to the landmarks, whitened by the kernel between the
    landmarks (Williams and Seeger 2001). With as many landmarks as training rows the
    kernel is exact; their number bounds the work per row, whatever the table's size.
    """

    inputCol = Param(Params._dummy(), "inputCol", "input vector", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output vector", TypeConverters.toString)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    width = Param(Params._dummy(), "width", "features read", TypeConverters.toInt)
    landmarks = Param(Params._dummy(), "landmarks", "landmark rows, flattened", TypeConverters.toListFloat)

    def __init__(self, landmarks=(), gamma=1.0 / K.N_BANDS, inputCol="scaled", outputCol="kernel", width=K.N_BANDS):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, gamma=gamma, width=width, landmarks=list(landmarks))

    def _transform(self, dataset):
        marks = np.array(self.getOrDefault("landmarks")).reshape(-1, self.getOrDefault("width"))
        gamma = self.getOrDefault("gamma")

        def kernel(a, b):
            sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
            return np.exp(-gamma * np.maximum(sq, 0.0))

        @F.pandas_udf("array<double>")
        def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            values, axes = np.linalg.eigh(kernel(marks, marks))
            use = values > 1e-10 * values[-1]
            whiten = axes[:, use] / np.sqrt(values[use])
            for batch in batches:
                yield pd.Series(list(kernel(np.stack(batch.to_numpy()), marks) @ whiten))

        features = project(vector_to_array(F.col(self.getOrDefault("inputCol"))))
        return dataset.withColumn(self.getOrDefault("outputCol"), array_to_vector(features))


def landmark_rows(train, size, seed, column="scaled"):
    """A seeded sample of distinct rows as one flat list, at most ``size`` x width numbers."""
    rows = train.select("id", vector_to_array(column).alias("v")).orderBy(order_key(seed), "id").limit(size).collect()
    distinct = dict.fromkeys(tuple(r["v"]) for r in rows)
    return [x for v in distinct for x in v]


def kernel_gamma(train, gamma="scale", column="scaled", width=K.N_BANDS):
    """scale: 1 / (width * population variance of all values); auto: 1 / width; or a number."""
    if gamma == "auto":
        return 1.0 / width
    if gamma == "scale":
        values = train.select(F.explode(vector_to_array(column)).alias("x"))
        return 1.0 / (width * values.agg(F.var_pop("x")).head()[0])
    return float(gamma)


class KernelSvm(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """RBF support vector classifier: a kernel map, a linear SVM over it, and a probability.

    The probability is a logistic curve over the margin (Platt 1999), fitted on margins of
    rows the SVM did not see, from stratified folds. ``folds=0`` leaves the curve at its
    standard form, for uses that only read the hard label.
    """

    c = Param(Params._dummy(), "c", "inverse penalty", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "kernel width or rule", TypeConverters.toString)
    landmarks = Param(Params._dummy(), "landmarks", "landmark rows of the kernel", TypeConverters.toInt)
    folds = Param(Params._dummy(), "folds", "folds for the probability", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)
    iterations = Param(Params._dummy(), "iterations", "SVM iterations", TypeConverters.toInt)

    def __init__(self, c=1.0, gamma="scale", landmarks=512, folds=5, seed=42, iterations=100):
        super().__init__()
        self._set(c=float(c), gamma=str(gamma), landmarks=landmarks, folds=folds, seed=seed,
                  iterations=iterations)

    def _svm(self, n_rows):
        return LinearSVC(
            featuresCol="kernel", labelCol="y", regParam=1.0 / (self.getOrDefault("c") * n_rows),
            standardization=False, maxIter=self.getOrDefault("iterations"),
            rawPredictionCol="raw_svm", predictionCol="svm_label",
        )

    def _fit(self, dataset):
        path = scratch_path(dataset.sparkSession, "kernel")
        try:
            mapped, rows = self._written(dataset, path)
            folds = self.getOrDefault("folds")
            platt = self._probability(rows, class_counts(rows, "fold")) if folds else PlattScaling()
            svm = self._svm(rows.count()).fit(rows)
        finally:
            removed(dataset.sparkSession, path)
        return PipelineModel([mapped, svm, platt])

    def _written(self, dataset, path):
        """The kernel map and its rows, which are made once for all fits; a fit keeps its own blocks of them while it runs.

        The narrow rows are dealt to tasks before, as a table may come in one large piece.
        """
        folds, seed = self.getOrDefault("folds"), self.getOrDefault("seed")
        tasks = max(1, math.ceil(dataset.count() / MAPPED_ROWS))
        slim = dataset.select("id", "y", "scaled").repartition(tasks, "id").persist()
        try:
            mapped = KernelMap(
                landmark_rows(slim, self.getOrDefault("landmarks"), seed + 1),
                kernel_gamma(slim, self.getOrDefault("gamma")),
            )
            wide = mapped.transform(stratified_folds(slim, folds, seed) if folds else slim).drop("id", "scaled")
            wide.write.parquet(path)
        finally:
            slim.unpersist()
        return mapped, dataset.sparkSession.read.schema(wide.schema).parquet(path)

    def _probability(self, rows, sizes):
        held_out = None
        for f, size in sizes.items():
            fitted = self._svm(sum(sizes.values()) - size).fit(rows.where(F.col("fold") != f))
            part = fitted.transform(rows.where(F.col("fold") == f)).select(
                "y", F.array(vector_to_array("raw_svm")[1]).alias("m")
            )
            held_out = part if held_out is None else held_out.unionByName(part)
        curve = LogisticRegression(featuresCol="v", labelCol="y", maxIter=100).fit(
            held_out.select("y", array_to_vector("m").alias("v"))
        )
        return PlattScaling(slope=float(curve.coefficients[0]), intercept=float(curve.intercept))


class PlattScaling(Model, DefaultParamsReadable, DefaultParamsWritable):
    slope = Param(Params._dummy(), "slope", "slope over the margin", TypeConverters.toFloat)
    intercept = Param(Params._dummy(), "intercept", "offset", TypeConverters.toFloat)

    def __init__(self, slope=1.0, intercept=0.0):
        super().__init__()
        self._set(slope=slope, intercept=intercept)

    def _transform(self, dataset):
        m = vector_to_array("raw_svm")[1]
        p = V.sigmoid(m * self.getOrDefault("slope") + F.lit(self.getOrDefault("intercept")))
        return dataset.withColumn("probability", array_to_vector(F.array(1.0 - p, p))).withColumn(
            "prediction", F.col("svm_label")
        ).drop("raw_svm", "svm_label", "kernel")


def baseline_models(n_rows, seed=42):
    """The four baseline classifiers in listing order."""
    return {
        LOGISTIC: logistic(n_rows),
        NEIGHBORS: KnnClassifier(features="scaled_array"),
        SVM: KernelSvm(seed=seed),
        FOREST: forest(seed=seed),
    }


def with_scores(model, df, name=None):
    """Score rows with any fitted model: adds prob (positive class) and pred_label.

    A model without a probability gives its hard label as 0 or 1.
    """
    out = model.transform(df)
    if "prob" not in out.columns:
        hard = F.col("prediction").cast("int")
        prob = vector_to_array("probability")[1] if "probability" in out.columns else hard.cast("double")
        out = out.withColumn("prob", prob).withColumn("pred_label", hard)
    out = out.select(*df.columns, "prob", "pred_label")
    return out.withColumn("model", F.lit(name)) if name else out


def batch_scorer(model):
    """A function from a matrix of inputs to (probabilities, hard labels) that runs inside a task, or None.

    Linear models have one: a few numbers that tasks carry. ``explain`` then makes, scores and sums all its changed rows
    where they are; other models score them as rows.
    """
    last = model.stages[-1] if isinstance(model, PipelineModel) and len(model.stages) == 1 else model
    if isinstance(last, LogisticRegressionModel):
        weights, intercept, slope, inclusive = last.coefficients.toArray(), last.intercept, 1.0, False
    elif hasattr(last, "centre") and hasattr(last, "slope"):
        weights, slope, inclusive = np.array(last.weight), last.slope, True
        intercept = -float(np.dot(last.centre, weights))
    else:
        return None

    def of_margin(margin):
        prob = 1.0 / (1.0 + np.exp(-slope * margin))
        return prob, prob >= 0.5 if inclusive else prob > 0.5

    def score(rows):
        return of_margin(rows @ weights + intercept)

    # A changed band moves the margin by its weight times the change.
    score.weights, score.intercept, score.of_margin = weights, intercept, of_margin
    return score


def score_models(df, models):
    """Long scored relation over several fitted models; nothing is shared or switched."""
    parts = [with_scores(m, df, name) for name, m in models.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def tree_importance(model, k=None):
    """(band, importance) of a fitted forest, highest first."""
    if isinstance(model, DeepForestModel):
        out = model.importances().orderBy(F.desc("importance"), "band")
        return out.limit(k) if k else out
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    rows = [(i + 1, float(v)) for i, v in enumerate(last.featureImportances.toArray())]
    out = _spark().createDataFrame(rows, "band int, importance double").orderBy(F.desc("importance"), "band")
    return out.limit(k) if k else out
