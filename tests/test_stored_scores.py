"""Metric operators against published figures, from the stored scores."""

import pytest
import stored_scores as G

from bandlore.operators import evaluate as E
from bandlore.operators import sampling as SA


@pytest.fixture(scope="module")
def scored(spark):
    rows = [("svm", i, y, p, h) for i, (y, p, h) in enumerate(zip(G.Y, G.SVM, G.SVM_HARD))]
    rows += [("forest", i, y, p, h) for i, (y, p, h) in enumerate(zip(G.Y, G.FOREST, G.FOREST_HARD))]
    return spark.createDataFrame(rows, "model string, id bigint, y int, prob double, pred_label int").cache()


def _one(df, **where):
    for k, v in where.items():
        df = df.where(df[k] == v)
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_hard_label_counts(scored):
    counts = E.confusion(scored)
    assert tuple(_one(counts, model="svm"))[1:] == G.SVM_HARD_COUNTS
    assert tuple(_one(counts, model="forest"))[1:] == G.FOREST_HARD_COUNTS


def test_hard_label_and_threshold_rule_differ(scored):
    # one stored score is exactly 0.5: class 0 by the hard label, class 1 under >= 0.5
    assert _one(E.confusion(E.apply_tau(scored, 0.5)), model="forest")["fp"] == 6


@pytest.mark.parametrize("tau", sorted(G.SVM_AT))
def test_benchmark(scored, tau):
    row = _one(E.model_benchmark(scored), model="svm", tau=tau)
    want = G.SVM_AT[tau]
    assert (row.tp, row.fp, row.tn, row.fn) == want[:4]
    assert (row.accuracy, row.precision, row.recall, row.f1) == pytest.approx(want[4:])
    assert row.roc_auc == pytest.approx(G.SVM_AUC)
    assert row.brier == pytest.approx(G.SVM_BRIER)


def test_auc_with_ties(scored):
    assert _one(E.roc_auc(scored), model="forest")["roc_auc"] == pytest.approx(G.FOREST_AUC)


@pytest.mark.parametrize("ranges", [None, 9])
def test_roc_curve(scored, ranges):
    curve = E.roc_curve(scored, ranges=ranges)
    got = sorted((r.fpr, r.tpr) for r in curve.where("model = 'svm'").collect())
    assert got == [pytest.approx(p) for p in G.SVM_ROC]
    assert curve.where("model = 'forest'").count() == G.FOREST_ROC_POINTS


def test_sweep_and_operating_points(scored):
    sweep = E.threshold_sweep(scored.where("model = 'svm'"))
    rows = {r.threshold: r for r in sweep.collect()}
    assert len(rows) == 99
    for tau, want in G.SVM_SWEEP.items():
        r = rows[tau]
        assert (r.accuracy, r.precision, r.recall, r.f1, r.tp, r.fp, r.tn, r.fn, r.total_cost) == want
    for tau, r in rows.items():
        tp = sum(y and p >= tau for y, p in zip(G.Y, G.SVM))
        fp = sum((not y) and p >= tau for y, p in zip(G.Y, G.SVM))
        assert (r.tp, r.fp, r.fn, r.tn) == (tp, fp, 22 - tp, 20 - fp)
    assert {r.point: r.threshold for r in E.operating_points(sweep).collect()} == G.SVM_POINTS


def test_classification_report(scored):
    got = {r["class"]: r for r in E.classification_report(scored).where("model = 'forest'").collect()}
    for name, want in G.FOREST_REPORT.items():
        r = got[name]
        assert (r.precision, r.recall, r.f1, r.support) == pytest.approx(want)


def test_errors_and_safety(scored):
    svm = scored.where("model = 'svm'")
    assert {r.id: r.margin for r in E.misclassified(svm, 0.43).collect()} == pytest.approx(G.SVM_ERRORS)
    audit = _one(E.safety_audit(scored), model="svm")
    assert (audit.positives, audit.missed, audit.zero_missed) == (22, 0, True)


def test_gain_over_baseline_and_champion(spark):
    base = spark.createDataFrame([(m, v[0], v[1]) for m, v in G.TUNING.items()], "model string, f1 double, accuracy double")
    tuned = spark.createDataFrame(
        [(m, v[2], v[3], G.TUNED_RECALL[m], i) for i, (m, v) in enumerate(G.TUNING.items())],
        "model string, f1 double, accuracy double, recall double, listing int")
    for r in E.compare_to_baseline(tuned, base).collect():
        # the published gains come from unrounded figures
        assert (r.delta_f1, r.delta_accuracy) == pytest.approx(G.TUNING[r.model][4:], abs=1.01e-4)
    assert E.champion(tuned, ["recall", "f1", "accuracy"]).head()["model"] == "Support Vector Machine"


def test_split_sizes(spark):
    n = sum(G.CLASS_SIZES.values())
    rows = spark.createDataFrame([(i, 1 if i < G.CLASS_SIZES[1] else 0) for i in range(n)], "id bigint, y int")
    for seed in (42, 7):
        got = {}
        for r in SA.split_rows(rows, seed=seed, label="y").groupBy("split", "y").count().collect():
            got.setdefault(r["split"], {})[r["y"]] = r["count"]
        assert got == G.SPLIT_SIZES
