"""Cross-validation, grid search, learning curves and the compare-and-pick job."""

from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from bandlore.operators import evaluate as E
from bandlore.operators import models as M
from bandlore.operators.forests import with_minimum_to_split
from bandlore.operators.neighbors import KnnClassifier, nearest_neighbors, vote_all
from bandlore.operators.sampling import class_counts, learning_prefixes

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def _fit(make, rows):
    """``make`` is an estimator, or a function from the number of rows to one."""
    estimator = make(rows.count()) if callable(make) else make
    return estimator.fit(rows)


def out_of_fold(make, folded, name):
    """Scores of every row from the model fitted without the row's fold."""
    parts = None
    for f in class_counts(folded, "fold"):
        model = _fit(make, folded.where(F.col("fold") != f))
        part = M.with_scores(model, folded.where(F.col("fold") == f), name)
        parts = part if parts is None else parts.unionByName(part)
    return parts


def fold_metrics(oof, metrics=METRICS):
    """Long (model, fold, metric, value), all folds in one pass over the scored rows."""
    by = ["model", "fold"]
    wide = E.classification_metrics(oof, by).join(E.roc_auc(oof, by), by)
    return E.long_metrics(wide, by, metrics)


def cross_validate(makers, folded):
    """Mean and population sd of five metrics per model over the folds present."""
    parts = None
    for name, make in makers.items():
        oof = out_of_fold(make, folded, name)
        parts = oof if parts is None else parts.unionByName(oof)
    return E.fold_summary(fold_metrics(parts))


def grids(size="coarse"):
    """Parameter values searched per model.

    ``full`` is the whole search: 30 SVM, 128 forest, 60 neighbour and 16 logistic settings
    (one solver stands for both names of the logistic solver, so 8 distinct fits; 64 grown forests serve the 128).
    """
    if size == "full":
        return {
            M.SVM: {"c": [0.5, 1.0, 2.0, 5.0, 10.0], "gamma": ["scale", "auto", "0.01", "0.02", "0.05", "0.1"]},
            M.FOREST: {
                "trees": [50, 100, 150, 200], "depth": [None, 5, 10, 15], "min_split": [2, 5],
                "min_leaf": [1, 2], "subset": ["sqrt", "log2"],
            },
            M.NEIGHBORS: {
                "k": list(range(1, 16)), "weights": ["uniform", "distance"],
                "metric": ["euclidean", "manhattan"],
            },
            M.LOGISTIC: {
                "c": [0.01, 0.05, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0], "solver": ["lbfgs", "liblinear"],
            },
        }
    if size != "coarse":
        raise ValueError("size must be 'coarse' or 'full'")
    return {
        M.SVM: {"c": [1.0, 5.0], "gamma": ["scale"]},
        M.FOREST: {"trees": [50], "depth": [5, 10], "min_split": [2], "min_leaf": [1], "subset": ["sqrt"]},
        M.NEIGHBORS: {"k": [3, 5, 9], "weights": ["uniform", "distance"], "metric": ["euclidean"]},
        M.LOGISTIC: {"c": [0.05, 1.0], "solver": ["lbfgs"]},
    }


def maker(name, best, seed=42):
    """An estimator of a model with the settings that a search found."""
    best = dict(best)
    if name == M.LOGISTIC:
        return lambda n: M.logistic(n, best["c"])
    if name == M.SVM:
        return M.KernelSvm(**best)
    return KnnClassifier(features="scaled_array", **best) if name == M.NEIGHBORS else M.forest(seed=seed, **best)


def settings(grid):
    names = list(grid)
    return [dict(zip(names, values)) for values in product(*grid.values())]


def fits(name, grid):
    """The settings that are fitted: those of the grid, both names of the logistic solver as one."""
    out = []
    for s in settings(grid):
        key = {k: ("lbfgs" if k == "solver" else v) for k, v in s.items()}
        if key not in out:
            out.append(key)
    return out


def search(train, name, grid, k=5, parallelism=2, seed=42):
    """Grid search on F1 over the ``fold`` column: (best settings, best F1, refitted model).

    The first best setting wins. Settings that give the same fit here are fitted once.
    """
    if name == M.NEIGHBORS:
        return _search_neighbors(train, grid, k)
    if name == M.SVM:
        return _search_svm(train, grid)
    if name == M.FOREST:
        return _search_forest(train, grid, parallelism, seed)
    n = train.count()
    estimator = M.logistic(n)
    chosen = fits(name, grid)
    # folds hold n (k-1)/k rows; the penalty follows the rows of the fit
    share = (k - 1) / k
    params = ParamGridBuilder().addGrid(estimator.regParam, [1.0 / (s["c"] * n * share) for s in chosen]).build()
    f1 = MulticlassClassificationEvaluator(labelCol="y", metricName="fMeasureByLabel", metricLabel=1.0)
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=params, evaluator=f1, numFolds=k, foldCol="fold",
        parallelism=parallelism, collectSubModels=False,
    ).fit(train)
    best = max(range(len(chosen)), key=lambda i: (cv.avgMetrics[i], -i))
    return chosen[best], float(cv.avgMetrics[best]), M.logistic(n, chosen[best]["c"]).fit(train)


def _best(rows):
    return max(rows, key=lambda r: (r[1], -r[2]))


def _mean_fold_f1(oof):
    per_fold = E.classification_metrics(oof, ["model", "fold"])
    return {r["model"]: r["f1"] for r in per_fold.groupBy("model").agg(F.avg("f1").alias("f1")).collect()}


def _search_svm(train, grid):
    listed = settings(grid)
    rows = []
    for i, s in enumerate(listed):
        # hard labels decide, so the probability curve is left out of the search
        oof = out_of_fold(M.KernelSvm(folds=0, **s), train, "svm")
        rows.append((s, _mean_fold_f1(oof)["svm"], i))
    best = _best(rows)
    return best[0], best[1], M.KernelSvm(**best[0]).fit(train)


def _search_forest(train, grid, parallelism, seed):
    """A forest per fold serves every minimum to split: its trees are cut, and all cuts are judged together."""
    listed = settings(grid)
    grown = {}
    for i, s in enumerate(listed):
        grown.setdefault(tuple((k, v) for k, v in s.items() if k != "min_split"), []).append(i)
    spark, folds = train.sparkSession, list(class_counts(train, "fold"))

    def judge(key):
        parts = None
        for f in folds:
            whole = M.forest(seed=seed, **dict(key)).fit(train.where(F.col("fold") != f))
            held = train.where(F.col("fold") == f)
            for i in grown[key]:
                cut = with_minimum_to_split(spark, whole, listed[i].get("min_split", 2))
                part = M.with_scores(cut, held, str(i))
                parts = part if parts is None else parts.unionByName(part)
        return _mean_fold_f1(parts)

    with ThreadPool(parallelism) as pool:
        found = pool.map(inheritable_thread_target(spark)(judge), list(grown))
    scores = {int(i): f1 for r in found for i, f1 in r.items()}
    best = _best([(s, scores[i], i) for i, s in enumerate(listed)])
    return best[0], best[1], M.forest(seed=seed, **best[0]).fit(train)


def _search_neighbors(train, grid, k):
    """One neighbour join per (metric, fold), and one pass over it, serve every k and both votes."""
    largest, counts = max(grid["k"]), None
    for metric in grid["metric"]:
        for f in range(k):
            held = train.where(F.col("fold") == f)
            rest = train.where(F.col("fold") != f)
            near = nearest_neighbors(
                held.select("id", F.col("scaled_array").alias("features")),
                rest.select("id", F.col("scaled_array").alias("features"), "y"), largest, metric,
            )
            votes = held.select("id", "y", "fold").join(vote_all(near, grid["k"], grid["weights"]), "id").select(
                "y", "fold", (F.col("prob") > 0.5).cast("int").alias("pred_label"),
                F.concat_ws("/", "k", "weights", F.lit(metric)).alias("model"),
            )
            part = E.confusion(votes, ["model", "fold"])
            counts = part if counts is None else counts.unionByName(part)
    per_model = E.with_metrics(counts).groupBy("model").agg(F.avg("f1").alias("f1")).collect()
    scores = {r["model"]: r["f1"] for r in per_model}
    rows = [
        (s, scores[f"{s['k']}/{s['weights']}/{s['metric']}"], i) for i, s in enumerate(settings(grid))
    ]
    best = _best(rows)
    return best[0], best[1], KnnClassifier(features="scaled_array", **best[0]).fit(train)


def learning_curve(make, folded, fractions=(0.2, 0.4, 0.6, 0.8, 1.0), k=5):
    """Accuracy on the training prefix and on the held-out fold, mean and population sd per step."""
    nested = learning_prefixes(folded, fractions, k).persist()
    parts = None
    try:
        for step in range(len(fractions)):
            for f in range(k):
                rows = nested.where((F.col("held") == f) & (F.col("step") <= step))
                model = _fit(make, rows)
                slim = [c for c in folded.columns]
                for side, data in (("train", rows.select(*slim)), ("cv", folded.where(F.col("fold") == f))):
                    right = M.with_scores(model, data).agg(
                        F.avg((F.col("pred_label") == F.col("y")).cast("double")).alias("accuracy"),
                        F.count(F.lit(1)).alias("rows"),
                    ).select(F.lit(step).alias("step"), F.lit(f).alias("held"), F.lit(side).alias("side"), "*")
                    parts = right if parts is None else parts.unionByName(right)
        # 2 x folds x steps rows
        table = parts.collect()
    finally:
        nested.unpersist()
    spark = folded.sparkSession
    flat = spark.createDataFrame(table, parts.schema)
    return flat.groupBy("step", "side").agg(
        F.max(F.when(F.col("side") == "train", F.col("rows"))).alias("train_size"),
        F.avg("accuracy").alias("mean"), F.stddev_pop("accuracy").alias("std"),
    )


def learning_curve_sizes(folded, fractions=(0.2, 0.4, 0.6, 0.8, 1.0), k=5):
    """Rows per (held-out fold, step) of the nested training prefixes."""
    nested = learning_prefixes(folded, fractions, k)
    reached = nested.where(F.col("step") < len(fractions)).withColumn(
        "upto", F.explode(F.sequence("step", F.lit(len(fractions) - 1)))
    )
    return reached.groupBy("held", F.col("upto").alias("step")).agg(F.count(F.lit(1)).alias("rows"))


def train_and_compare(train, test, makers):
    """Fit every model on ``train``; CV summary, test metrics and the champion.

    ``test`` is whatever rows the choice is to be made on; a validation fold keeps the real
    test rows out of the choice. Returns (fitted models, metrics table, champion name).
    """
    fitted = {name: _fit(make, train) for name, make in makers.items()}
    scored = M.score_models(test, fitted)
    by = ["model"]
    test_metrics = E.classification_metrics(scored, by).join(E.roc_auc(scored, by), by)
    cv = cross_validate(makers, train)
    cv_f1 = cv.where("metric = 'f1'").select("model", F.col("mean").alias("cv_f1"))
    names = list(makers)
    listing = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("model"))
    table = test_metrics.join(cv_f1, "model").withColumn("listing", listing)
    best = E.champion(table, ["f1", "cv_f1"]).head()["model"]
    return fitted, table.withColumn("is_champion", F.col("model") == best), best
