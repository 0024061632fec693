"""Training, tuning, ensemble and explanation jobs over prepared rows.

``prepared`` comes from :class:`SignalPreprocessor` (id, y, split, features, scaled,
scaled_array). Choices are made on a validation fold of the training rows, so the test
rows only ever report.
"""

from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.operators import ensemble as EN
from bandlore.operators import evaluate as E
from bandlore.operators import explain as X
from bandlore.operators import models as M
from bandlore.operators import training as T
from bandlore.operators.sampling import stratified_folds
from bandlore.session import stable
from bandlore.sources import records, sinks


def folds_of(prepared, k=5, seed=42):
    train = prepared.where("split = 'train'")
    return stratified_folds(train, k, seed), prepared.where("split = 'test'")


def baseline_makers(seed=42):
    return {
        M.LOGISTIC: M.logistic,
        M.NEIGHBORS: lambda n: M.baseline_models(n, seed)[M.NEIGHBORS],
        M.SVM: M.KernelSvm(seed=seed),
        M.FOREST: M.forest(seed=seed),
    }


def run_training(prepared, makers=None, k=5, path=None, choose_on="validation"):
    """Baseline models: CV summary, metrics, champion; models and tables written to ``path``."""
    folded, test = folds_of(prepared, k)
    makers = makers or baseline_makers()
    if choose_on == "validation":
        rows, judge = folded.where("fold <> 0"), folded.where("fold = 0")
    else:
        rows, judge = folded, test
    chosen_from, table, best = T.train_and_compare(rows, judge, makers)
    fitted = {name: T._fit(make, folded) for name, make in makers.items()}
    if path:
        sinks.write_table_csv(sinks.rounded(table), f"{path}/model_metrics")
        sinks.save_models(fitted, f"{path}/models", best)
        judged = M.score_models(judge, chosen_from)
        records.write_records(E.operating_points(E.threshold_sweep(judged)), f"{path}/records", best)
    return {"models": fitted, "metrics": table, "champion": best,
            "test": E.model_benchmark(M.score_models(test, fitted))}


def run_tuning(prepared, baseline=None, size="full", k=5, names=None, path=None):
    """Grid search per model, gain over the baseline, champion, sweep and operating points.

    Champion and operating points are chosen on out-of-fold scores of the training rows, so the test rows only report.
    Without ``baseline`` metrics the untuned models of the same names are fitted and compared with on the test rows.
    """
    folded, test = folds_of(prepared, k)
    space = T.grids(size)
    found = {n: T.search(folded, n, space[n], k) for n in (names or list(space))}
    fitted = {n: f[2] for n, f in found.items()}
    scored = M.score_models(test, fitted)
    metrics = E.classification_metrics(scored)
    if baseline is None:
        plain = {n: T._fit(make, folded) for n, make in baseline_makers().items() if n in fitted}
        baseline = E.classification_metrics(M.score_models(test, plain))
    spark = prepared.sparkSession
    unseen = None
    for n, f in found.items():
        part = T.out_of_fold(T.maker(n, f[0]), folded, n).select("model", "id", "y", "prob", "pred_label")
        unseen = part if unseen is None else unseen.unionByName(part)
    unseen = stable(unseen)
    cv = spark.createDataFrame(
        [(n, str(f[0]), float(f[1]), i) for i, (n, f) in enumerate(found.items())],
        "model string, best_params string, cv_best_f1 double, listing int",
    )
    table = metrics.join(cv, "model")
    gain = E.compare_to_baseline(metrics, baseline)
    judged = E.classification_metrics(unseen).join(cv.select("model", "listing"), "model")
    best = E.champion(judged, ["recall", "f1", "accuracy"]).head()["model"]
    every = E.threshold_sweep(unseen)
    all_points = E.operating_points(every)
    sweep, points = (table.where(F.col("model") == best) for table in (every, all_points))
    if path:
        sinks.write_table_csv(sinks.rounded(table), f"{path}/tuning_metrics")
        sinks.write_table_csv(sweep, f"{path}/threshold_analysis")
        sinks.write_table_csv(points, f"{path}/operating_points")
        sinks.write_threshold(points, f"{path}/threshold")
        records.write_records(all_points, f"{path}/records", best)
        sinks.save_models(fitted, f"{path}/models", best)
    return {"models": fitted, "metrics": table, "gain": gain, "champion": best, "sweep": sweep,
            "operating_points": points, "calibration": E.calibration_curve(scored), "brier": E.brier(scored)}


def run_ensemble(prepared, k=5, path=None, mlp_iterations=600, trees=200, svm=None):
    """Perceptron, soft voting and stacking beside the tuned SVM and forest."""
    folded, test = folds_of(prepared, k)
    svm = svm or M.KernelSvm()
    rf = M.forest(trees=trees, min_leaf=2, subset="log2")
    mlp = M.perceptron(iterations=mlp_iterations)
    members = {M.SVM: svm, M.FOREST: rf, M.MLP: mlp, M.LOGISTIC: lambda n: M.logistic(n, 0.05)}
    fitted = {
        M.SVM: svm.fit(folded), M.FOREST: rf.fit(folded), M.MLP: mlp.fit(folded),
        EN.VOTING: EN.VotingModel(members).fit(folded),
        EN.STACKING: EN.StackingModel({n: members[n] for n in (M.SVM, M.FOREST, M.MLP)}, k).fit(folded),
    }
    scored = M.score_models(test, fitted)
    table = E.model_benchmark(scored)
    if path:
        sinks.write_table_csv(sinks.rounded(table), f"{path}/ensemble_metrics")
        sinks.save_models(fitted, f"{path}/models")
    return {"models": fitted, "scored": scored, "metrics": table, "loss": M.training_loss(fitted[M.MLP])}


def run_explanation(prepared, model, tau=K.SAFE_TAU, repeats=15, background=40, permutations=100, path=None):
    """Permutation importance, Shapley ranking and error list of a fitted model on the test rows."""
    test = prepared.where("split = 'test'")
    train = prepared.where("split = 'train'")
    inputs = test.select("id", "y", F.col("scaled_array").alias("features"))
    held = train.select("id", F.col("scaled_array").alias("features"))
    importance = X.permutation_importance(model, inputs, repeats)
    attr = X.phi_arrays(X.shapley_sampling(
        model, inputs, X.background_rows(held, background), permutations))
    scored = M.with_scores(model, test, "model")
    errors = E.misclassified(scored, tau)
    out = {
        "permutation": X.top_bands(importance, "mean_importance"),
        "shapley": X.top_bands(X.global_attribution(attr), "mean_abs_phi"),
        "errors": errors, "audit": E.safety_audit(scored, tau=tau), "attribution": attr,
    }
    if path:
        audit = E.with_metrics(E.confusion(E.apply_tau(scored, tau))).withColumn("threshold", F.lit(tau))
        sinks.write_report_json(audit, f"{path}/report")
        sinks.write_table_csv(out["permutation"], f"{path}/permutation")
        sinks.write_table_csv(out["shapley"], f"{path}/shapley")
        sinks.write_scored(errors, f"{path}/errors")
    return out
