"""Fitted models: quality floors, saving, tuning, ensembles, attribution."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from bandlore.operators import ensemble as EN
from bandlore.operators import evaluate as E
from bandlore.operators import explain as X
from bandlore.operators import forests as FO
from bandlore.operators import models as M
from bandlore.operators import neighbors as N
from bandlore.operators import training as T
from bandlore.plans import modelling as J
from bandlore.plans.preprocess import SignalPreprocessor
from bandlore.session import scratch_path


@pytest.fixture(scope="module")
def prepared(signals):
    return SignalPreprocessor().fit(signals).cache()


@pytest.fixture(scope="module")
def sides(prepared):
    folded, test = J.folds_of(prepared)
    return folded.cache(), test.cache()


def _auc(model, test):
    return E.roc_auc(M.with_scores(model, test, "m")).head()["roc_auc"]


def test_logistic_follows_the_penalty(sides):
    folded, test = sides
    weak, strong = (M.logistic(folded.count(), c).fit(folded) for c in (10.0, 0.01))
    assert strong.coefficients.norm(2) < weak.coefficients.norm(2)
    assert _auc(weak, test) > 0.85


def test_logistic_matches_its_objective(sides):
    """The fitted weights zero the gradient of C * loss + |w|^2 / 2."""
    import numpy as np

    folded, _ = sides
    model = M.logistic(folded.count(), 1.0).fit(folded)
    pdf = folded.select("scaled_array", "y").toPandas()
    x, y = np.stack(pdf["scaled_array"]), pdf["y"].to_numpy()
    w = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    assert np.abs(x.T @ (p - y) + w).max() < 0.05


def test_forest(sides):
    folded, test = sides
    model = M.forest(trees=50, depth=10).fit(folded)
    assert _auc(model, test) > 0.8
    imp = M.tree_importance(model).collect()
    assert sum(r.importance for r in imp) == pytest.approx(1.0)
    assert [r.importance for r in imp] == sorted((r.importance for r in imp), reverse=True)


def test_unlimited_depth_is_accepted(sides):
    assert M.forest(trees=2).fit(sides[0]).getNumTrees == 2


def test_perceptron_and_loss(sides):
    folded, test = sides
    model = M.perceptron(iterations=60).fit(folded)
    assert _auc(model, test) > 0.8
    loss = [r.loss for r in M.training_loss(model).orderBy("iteration").collect()]
    assert loss[-1] < loss[0]


def test_kernel_svm_saves_and_loads(sides, tmp_path):
    folded, test = sides
    model = M.KernelSvm(folds=3, iterations=40).fit(folded)
    assert _auc(model, test) > 0.8
    path = str(tmp_path / "svm")
    model.write().overwrite().save(path)
    again = M.with_scores(PipelineModel.load(path), test).select("id", F.col("prob").alias("p"))
    first = M.with_scores(model, test).select("id", "prob")
    assert first.join(again, "id").where(F.abs(F.col("p") - F.col("prob")) > 1e-12).count() == 0


@pytest.mark.parametrize("folds", [0, 2])
def test_kernel_svm_maps_a_row_once_in_dealt_tasks(sides, folds, monkeypatch):
    """All fits read the same mapped rows; a table of one piece is mapped in several, and nothing stays in the folder."""
    import os

    from pyspark import TaskContext
    from pyspark.accumulators import AccumulatorParam
    from pyspark.ml.linalg import VectorUDT

    from bandlore.session import shared_dir

    class Union(AccumulatorParam):
        def zero(self, value):
            return []

        def addInPlace(self, a, b):
            return a + b

    folded = sides[0].coalesce(1)
    spark = folded.sparkSession
    seen = spark.sparkContext.accumulator([], Union())

    @F.udf(VectorUDT())
    def noted(v):
        seen.add([TaskContext.get().partitionId()])
        return v

    whole = M.KernelMap._transform
    monkeypatch.setattr(M.KernelMap, "_transform", lambda self, df: whole(self, df.withColumn("scaled", noted("scaled"))))
    monkeypatch.setattr(M, "MAPPED_ROWS", 100, raising=False)
    M.KernelSvm(folds=folds, landmarks=50, iterations=3).fit(folded)
    assert len(seen.value) == folded.count() and len(set(seen.value)) == 4
    assert not [name for name in os.listdir(shared_dir(spark)) if name.startswith("kernel-")]


def test_kernel_map_is_exact_on_its_landmarks(spark):
    import numpy as np
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 60)) / 8
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, f array<double>").withColumn(
        "scaled", array_to_vector("f"))
    z = np.stack(M.KernelMap(M.landmark_rows(df, 100, 1), 0.5).transform(df).orderBy("id").select(
        vector_to_array("kernel").alias("k")).toPandas()["k"])
    true = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - true).max() < 1e-8


def test_neighbors_model_saves_and_loads(spark, sides, tmp_path):
    folded, test = sides
    model = N.KnnClassifier(k=9, features="scaled_array").fit(folded)
    assert _auc(model, test) > 0.7
    from bandlore.sources import sinks

    saved = sinks.save_models({M.NEIGHBORS: model}, str(tmp_path), champion=M.NEIGHBORS)
    again = sinks.load_model(spark, saved["best"])
    a = model.transform(test).select("id", "prob", "pred_label")
    assert a.exceptAll(again.transform(test).select("id", "prob", "pred_label")).count() == 0


def test_cross_validation_covers_every_row(sides):
    folded, _ = sides
    oof = T.out_of_fold(M.logistic, folded, "lr")
    assert oof.select("id").distinct().count() == folded.count() == oof.count()
    cv = {r.metric: r for r in E.fold_summary(T.fold_metrics(oof)).collect()}
    assert set(cv) == set(T.METRICS)
    assert cv["roc_auc"]["mean"] > 0.85 and cv["roc_auc"]["std"] < 0.1


def test_grid_sizes():
    sizes = {n: len(T.settings(g)) for n, g in T.grids("full").items()}
    assert sizes == {M.SVM: 30, M.FOREST: 128, M.NEIGHBORS: 60, M.LOGISTIC: 16}


def test_search(sides):
    folded, test = sides
    best, f1, model = T.search(folded, M.NEIGHBORS, {"k": [1, 9], "weights": ["uniform", "distance"], "metric": ["euclidean"]}, 5)
    assert best["k"] == 9 and 0.5 < f1 < 1
    best, f1, model = T.search(folded, M.SVM, {"c": [1.0], "gamma": ["scale"]}, 5)
    assert best == {"c": 1.0, "gamma": "scale"} and f1 > 0.6
    best, f1, model = T.search(folded, M.FOREST, {"trees": [10], "depth": [3], "min_split": [2, 5], "min_leaf": [1], "subset": ["sqrt"]}, 5)
    assert best["min_split"] in (2, 5) and _auc(model, test) > 0.6
    assert len(T.fits(M.FOREST, T.grids("full")[M.FOREST])) == 128


def _leaf(nodes, x, bound):
    """The first node on the way of ``x`` that has no split or fewer rows than ``bound``."""
    at = 0
    while nodes[at].leftChild >= 0 and nodes[at].rawCount >= bound:
        goes = x[nodes[at].split.featureIndex] <= nodes[at].split.leftCategoriesOrThreshold[0]
        at = nodes[at].leftChild if goes else nodes[at].rightChild
    return nodes[at]


def test_minimum_to_split_walks_the_whole_forest(sides):
    """A row's probability in the cut forest is that of the walks down the whole forest which stop at small nodes."""
    folded, test = sides
    spark = folded.sparkSession
    whole = M.forest(trees=7).fit(folded)
    path = scratch_path(spark, "whole")
    whole.write().save(path)
    trees = {}
    for r in FO.node_table(spark, path).collect():
        trees.setdefault(r.treeID, {})[r.id] = r
    for bound in (5, 60, 10_000):
        cut = FO.with_minimum_to_split(spark, whole, bound)
        assert cut.totalNumNodes < whole.totalNumNodes and cut.getNumTrees == 7
        for r in M.with_scores(cut, test).select("scaled", "prob").limit(60).collect():
            shares = [s[1] / sum(s) for s in (_leaf(t, r.scaled, bound).impurityStats for t in trees.values())]
            assert r.prob == pytest.approx(sum(shares) / 7, abs=1e-9)
    fitted = M.forest(trees=7, min_split=60).fit(folded)
    assert fitted.totalNumNodes == FO.with_minimum_to_split(spark, whole, 60).totalNumNodes


def _grown(rows, bound):
    """Label by (x0, x1) of the greedy Gini tree over ``rows`` (x0, x1, y); None where the best split is not unique."""
    def gini(part):
        p = sum(y for *_, y in part) / len(part)
        return 2 * p * (1 - p) * len(part)

    tried = []
    for axis in (0, 1):
        for value in sorted({r[axis] for r in rows})[:-1]:
            sides = [r for r in rows if r[axis] <= value], [r for r in rows if r[axis] > value]
            tried.append((round(gini(rows) - sum(map(gini, sides)), 9), sides))
    tried.sort(key=lambda x: -x[0])
    if len(rows) < bound or not tried or tried[0][0] <= 0:
        label = float(2 * sum(y for *_, y in rows) > len(rows))
        return {r[:2]: label for r in rows}
    if len(tried) > 1 and tried[0][0] == tried[1][0]:
        return {r[:2]: None for r in rows}
    return _grown(tried[0][1][0], bound) | _grown(tried[0][1][1], bound)


@pytest.mark.parametrize("bound", [2, 6, 15, 31])
def test_small_trees_agree_with_a_brute_force_split(spark, bound):
    import random

    rng = random.Random(5)
    rows = [(rng.randrange(12), rng.randrange(12)) for _ in range(60)]
    rows = [(a, b, int((a > 5) != (b > 7) if rng.random() < 0.8 else rng.random() < 0.5)) for a, b in rows]
    table = spark.createDataFrame([([float(a), float(b)], float(y)) for a, b, y in rows], "v array<double>, y double")
    table = M.ArrayToVector("v", "scaled").transform(table)
    model = M.forest(trees=1, subset="all", bootstrap=False, min_split=bound).fit(table)
    got = {tuple(map(int, r.v)): r.prediction for r in model.transform(table).collect()}
    want = _grown(rows, bound)
    known = {x: label for x, label in want.items() if label is not None}
    assert len(known) >= 0.6 * len(want) and {x: got[x] for x in known} == known


def test_learning_curve(sides):
    folded, _ = sides
    rows = {(r.step, r.side): r for r in T.learning_curve(M.logistic, folded, (0.2, 1.0)).collect()}
    assert rows[(0, "train")].train_size == 64 and rows[(1, "train")].train_size == 320
    assert rows[(1, "cv")]["mean"] > rows[(0, "cv")]["mean"] - 0.05


def test_training_job(prepared, tmp_path):
    makers = {M.LOGISTIC: M.logistic, M.FOREST: M.forest(trees=10, depth=5), M.NEIGHBORS: N.KnnClassifier(features="scaled_array")}
    out = J.run_training(prepared, makers, path=str(tmp_path), k=3)
    assert out["champion"] in makers
    assert out["metrics"].where("is_champion").count() == 1
    spark = prepared.sparkSession
    assert spark.read.option("header", True).csv(str(tmp_path / "model_metrics")).count() == 3
    assert out["test"].count() == 6


def test_tuning_job(prepared, tmp_path):
    out = J.run_tuning(prepared, names=[M.LOGISTIC], path=str(tmp_path))
    assert out["champion"] == M.LOGISTIC and out["sweep"].count() == 99 and out["operating_points"].count() == 4
    assert [tuple(r)[3:] for r in out["gain"].collect()] == [(0.0, 0.0)]


def test_voting_weights_and_stacking(sides):
    folded, test = sides
    members = {M.LOGISTIC: M.logistic, M.FOREST: M.forest(trees=10, depth=5)}
    vote = EN.VotingModel(members).fit(folded)
    blend = vote.transform(test).select("id", "prob")
    mean = M.score_models(test, vote.members).groupBy("id").agg(F.avg("prob").alias("m"))
    assert blend.join(mean, "id").where(F.abs(F.col("prob") - F.col("m")) > 1e-12).count() == 0
    assert E.voting_weights(["a", "b", "c", "d"]) == {"a": 2.0, "b": 1.0, "c": 1.0, "d": 1.0}
    assert _auc(EN.StackingModel(members).fit(folded), test) > 0.8


def test_sampled_shapley_adds_up(sides):
    folded, test = sides
    model = M.logistic(folded.count()).fit(folded)
    rows = test.select("id", "y", F.col("scaled_array").alias("features"))
    back = X.background_rows(folded.select("id", F.col("scaled_array").alias("features")), 6)
    attr = X.shapley_sampling(model, rows, back, 2)
    assert attr.groupBy("id").count().where("count <> 60").count() == 0
    assert X.shapley_gap(model, rows, back, attr).agg(F.max(F.abs("gap"))).head()[0] < 1e-9


def test_shapley_plan_does_not_grow_with_draws(sides):
    """Orders are permutations in reversed pairs, and the plan is the same for 4 and 4,000 draws."""
    folded, test = sides
    model = M.logistic(folded.count()).fit(folded)
    rows = test.select("id", "y", F.col("scaled_array").alias("features"))
    held = folded.select("id", F.col("scaled_array").alias("features"))
    draws = X.shapley_draws(X.background_rows(held, 3), 4).collect()
    assert len(draws) == 12 and abs(sum(d.weight for d in draws) - 1) < 1e-12
    assert all(sorted(d.order) == list(range(1, 61)) and d.order[d.place[7]] == 8 for d in draws)
    orders = [d.order for d in draws]
    assert all(order[::-1] in orders for order in orders) and len(set(map(tuple, orders))) == 12
    forest = M.forest(trees=2, depth=2).fit(folded)
    sizes = [len(X.shapley_sampling(forest, rows, X.background_rows(held, n), p)._jdf.queryExecution().analyzed().toString())
             for n, p in ((2, 2), (40, 100))]
    assert abs(sizes[0] - sizes[1]) < 500


def test_batch_scorers_give_what_rows_give(sides, monkeypatch):
    """Shapley values and importances inside tasks, and by scored rows."""
    folded, test = sides
    model = M.logistic(folded.count()).fit(folded)
    rows = test.select("id", "y", F.col("scaled_array").alias("features"))
    back = X.background_rows(folded.select("id", F.col("scaled_array").alias("features")), 3)

    def both():
        phi = {(r.id, r.band): r.phi for r in X.shapley_sampling(model, rows, back, 2).collect()}
        drop = {r.band: (r.mean_importance, r.std_importance) for r in X.permutation_importance(model, rows, 3).collect()}
        return phi, drop

    inside = both()
    monkeypatch.setattr(M, "batch_scorer", lambda model: None)
    outside = both()
    for a, b in zip(inside, outside):
        assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)


def test_linear_models_score_no_changed_rows(sides, monkeypatch):
    """Margins of linear models move by one band at a time; no step is scored as a whole row."""
    folded, test = sides
    model = M.logistic(folded.count()).fit(folded)
    rows = test.select("id", "y", F.col("scaled_array").alias("features"))
    back = X.background_rows(folded.select("id", F.col("scaled_array").alias("features")), 3)
    linear = M.batch_scorer(model)

    def whole(rows):
        raise AssertionError("rows are made for every step")

    whole.weights, whole.intercept, whole.of_margin = linear.weights, linear.intercept, linear.of_margin
    monkeypatch.setattr(M, "batch_scorer", lambda model: whole)
    attr = X.shapley_sampling(model, rows, back, 2)
    assert attr.count() == 60 * rows.count()
    assert X.shapley_gap(model, rows, back, attr).agg(F.max(F.abs("gap"))).head()[0] < 1e-9
    assert X.permutation_importance(model, rows, 2).count() == 60


def test_model_permutation_finds_the_label_bands(sides):
    folded, test = sides
    model = M.logistic(folded.count()).fit(folded)
    rows = test.select("id", "y", F.col("scaled_array").alias("features"))
    top = X.top_bands(X.permutation_importance(model, rows, 5), "mean_importance", 4).collect()
    assert {11, 12} <= {r.band for r in top}


def test_explanation_job(sides, tmp_path):
    folded, test = sides
    model = M.logistic(folded.count()).fit(folded)
    both = folded.drop("fold").unionByName(test)
    out = J.run_explanation(both, model, repeats=2, background=2, permutations=1, path=str(tmp_path))
    assert out["permutation"].count() == 15 == out["shapley"].count()
    audit = out["audit"].head()
    assert audit.zero_missed == (audit.missed == 0)


def test_ensemble_job(prepared):
    out = J.run_ensemble(prepared, k=2, mlp_iterations=15, trees=5, svm=M.KernelSvm(landmarks=50, folds=2, iterations=5))
    assert out["metrics"].count() == 10
    assert out["loss"].count() > 1
