"""Evaluation queries over the scored relation."""

from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.functions import scalar as S
from bandlore.operators import evaluate as E
from bandlore.operators import linear as L
from bandlore.plans.registry import METRICS, SCORED, ZONES, query, rounded

_COUNTS = """count(*) FILTER (WHERE y = 1 AND {p}) AS tp, count(*) FILTER (WHERE y = 0 AND {p}) AS fp,
count(*) FILTER (WHERE y = 0 AND NOT ({p})) AS tn, count(*) FILTER (WHERE y = 1 AND NOT ({p})) AS fn"""
_CELLS = f"""cf AS (SELECT model, {_COUNTS.format(p="pred_label = 1")} FROM scored GROUP BY model)"""
_ROUND4 = 'round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1'
_AUC = """auc AS (SELECT model, sum(CASE WHEN y = 1 THEN rk END)/max(p)/max(n) - (max(p) + 1)/2/max(n) AS roc_auc FROM
(SELECT model, y, rank() OVER (PARTITION BY model ORDER BY prob) + (count(*) OVER (PARTITION BY model, prob) - 1)/2.0::DOUBLE AS rk,
(sum(y) OVER (PARTITION BY model))::DOUBLE AS p, (sum(1 - y) OVER (PARTITION BY model))::DOUBLE AS n FROM scored) GROUP BY model)"""


@query("scored_relation", f"WITH {SCORED} SELECT model, id, y, round(prob, 6) AS prob, pred_label FROM scored")
def _(t):
    return rounded(t.scored_wide().select("model", "id", "y", "prob", "pred_label"))


@query("a17_confusion", f"WITH {ZONES}, {_CELLS} SELECT * FROM cf")
def _(t):
    return E.confusion(t.zones())


@query("a17_confusion_labels", f"""WITH s AS (SELECT quality AS y, toxic FROM labels)
SELECT {_COUNTS.format(p="toxic = 1")} FROM s""")
def _(t):
    return E.confusion(t.table("labels"), by=(), y="quality", pred="toxic")


@query("a18_classification_metrics", f"WITH {ZONES}, {_CELLS}, m AS (SELECT *, {METRICS} FROM cf) SELECT model, tp, fp, tn, fn, {_ROUND4} FROM m")
def _(t):
    return rounded(E.classification_metrics(t.zones()))


@query("a18_metrics_lineitem", f"""WITH s AS (SELECT l_linestatus AS model, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS pred_label FROM lineitem),
cf AS (SELECT model, {_COUNTS.format(p="pred_label = 1")} FROM s GROUP BY model), m AS (SELECT *, {METRICS} FROM cf)
SELECT model, tp, fp, tn, fn, {_ROUND4} FROM m""")
def _(t):
    rows = t.table("lineitem").select(
        F.col("l_linestatus").alias("model"), (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_quantity") > 25).cast("int").alias("pred_label"))
    return rounded(E.classification_metrics(rows))


_REPORT = f"""WITH {ZONES}, {_CELLS},
k AS (SELECT model, 'Rock (0)' AS class, tn AS hit, tn + fn AS called, tn + fp AS support FROM cf
UNION ALL SELECT model, 'Mine (1)', tp, tp + fp, tp + fn FROM cf),
pr AS (SELECT model, class, support, coalesce(hit/nullif(called, 0)::DOUBLE, 0) AS p, coalesce(hit/nullif(support, 0)::DOUBLE, 0) AS r,
coalesce(2*hit/nullif(called + support, 0)::DOUBLE, 0) AS f FROM k),
a AS (SELECT model, sum(hit)/sum(support)::DOUBLE AS acc, sum(support) AS n FROM k GROUP BY model),
o AS (SELECT model, class, p, r, f, support FROM pr
UNION ALL SELECT model, 'accuracy', acc, acc, acc, n FROM a
UNION ALL SELECT model, 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM pr GROUP BY model
UNION ALL SELECT model, 'weighted avg', sum(p*support)/sum(support), sum(r*support)/sum(support), sum(f*support)/sum(support), sum(support)
FROM pr GROUP BY model)
SELECT model, class, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1, support::BIGINT AS support FROM o"""


@query("a19_classification_report", _REPORT)
def _(t):
    return rounded(E.classification_report(t.zones()))


@query("a20_brier", f"WITH {ZONES} SELECT model, round(avg((prob - y)*(prob - y)), 6) AS brier FROM scored GROUP BY model")
def _(t):
    return rounded(E.brier(t.zones()))


@query("a21_calibration", f"""WITH {ZONES} SELECT model, greatest(ceil(prob*6) - 1, 0)::BIGINT AS bin, count(*) AS rows,
round(avg(y), 6) AS fraction_of_positives, round(avg(prob), 6) AS mean_predicted FROM scored GROUP BY 1, 2""")
def _(t):
    return rounded(E.calibration_curve(t.zones()))


_FOLD = f"""WITH {ZONES}, fs AS (SELECT model || '' AS model, id % 5 AS fold, y, pred_label, prob FROM scored),
cf AS (SELECT model, fold, {_COUNTS.format(p="pred_label = 1")} FROM fs GROUP BY model, fold),
m AS (SELECT *, {METRICS} FROM cf),
l AS (SELECT model, 'accuracy' AS metric, accuracy AS v FROM m UNION ALL SELECT model, 'precision', "precision" FROM m
UNION ALL SELECT model, 'recall', recall FROM m UNION ALL SELECT model, 'f1', f1 FROM m)
SELECT model, metric, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM l GROUP BY model, metric"""


@query("a22_fold_summary", _FOLD)
def _(t):
    folded = t.zones().withColumn("fold", F.col("id") % 5)
    wide = E.classification_metrics(folded, ["model", "fold"])
    long = E.long_metrics(wide, ["model", "fold"], ("accuracy", "precision", "recall", "f1"))
    return rounded(E.fold_summary(long))


@query("a23_batch_summary", f"""WITH {SCORED} SELECT count(*) AS total_signals, count(*) FILTER (WHERE prob >= 0.43) AS threats_detected,
count(*) FILTER (WHERE prob < 0.43) AS benign_detected, round(coalesce(count(*) FILTER (WHERE prob >= 0.43)*100.0::DOUBLE/nullif(count(*), 0), 0), 6) AS threat_rate_pct FROM scored""")
def _(t):
    return rounded(E.batch_summary(t.scored(), K.SAFE_TAU))


@query("a24_empty_batch", f"""WITH {SCORED} SELECT 0 AS total_signals, 0 AS threats_detected, 0 AS benign_detected, 0.0 AS threat_rate_pct
FROM scored WHERE prob > 2 HAVING count(*) = 0""")
def _(t):
    return rounded(E.batch_summary(t.scored().where("prob > 2"), K.SAFE_TAU))


_KIND = "CASE WHEN y = 1 AND prob >= 0.43 THEN 'TP' WHEN y = 0 AND prob < 0.43 THEN 'TN' WHEN y = 0 THEN 'FP' ELSE 'FN' END"


@query("a25_outcome_profile", f"""WITH {SCORED}, o AS (SELECT id, {_KIND} AS outcome FROM scored)
SELECT outcome, band, count(*) AS rows, round(avg(x), 6) AS mean FROM o JOIN slong USING (id)
WHERE outcome IN ('TP', 'TN') GROUP BY outcome, band""")
def _(t):
    return rounded(E.outcome_profile(t.scored_wide()))


@query("a25_error_signals", f"""WITH {SCORED}, o AS (SELECT id, {_KIND} AS outcome FROM scored)
SELECT id, round(sum(x), 6) AS total, round(max(x), 6) AS peak FROM slong WHERE id IN (SELECT id FROM o WHERE outcome IN ('FP', 'FN')) GROUP BY id""")
def _(t):
    rows = E.error_features(t.parts()[1], E.misclassified(t.scored()))
    return rounded(rows.select("id", F.aggregate("features", F.lit(0.0), lambda a, v: a + v).alias("total"),
                               F.array_max("features").alias("peak")))


@query("a26_safety_audit", f"""WITH {ZONES} SELECT model, count(*) FILTER (WHERE y = 1) AS positives,
count(*) FILTER (WHERE y = 1 AND prob < 0.43) AS missed, count(*) FILTER (WHERE y = 1 AND prob < 0.43) = 0 AS zero_missed FROM scored GROUP BY model""")
def _(t):
    return E.safety_audit(t.zones())


_ROC = f"""WITH {{base}},
g AS (SELECT model, prob, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY model, prob),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, row_number() OVER w AS rn,
lead(pos) OVER w AS np, lead(neg) OVER w AS nn FROM g WINDOW w AS (PARTITION BY model ORDER BY prob DESC)),
t AS (SELECT model, sum(y)::DOUBLE AS p, sum(1 - y)::DOUBLE AS n FROM scored GROUP BY model),
o AS (SELECT model, tp, fp FROM c WHERE rn = 1 OR np IS NULL OR np <> pos OR nn <> neg UNION ALL SELECT model, 0, 0 FROM t)
SELECT model, round(fp/n, 6) AS fpr, round(tp/p, 6) AS tpr FROM o JOIN t USING (model)"""


@query("w1_roc_curve", _ROC.format(base=ZONES))
def _(t):
    return rounded(E.roc_curve(t.zones()).select("model", "fpr", "tpr"))


_LINE_SCORES = """scored AS (SELECT l_linestatus AS model, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
l_extendedprice/200000 AS prob FROM lineitem)"""


def _line_scores(t):
    return t.table("lineitem").select(
        F.col("l_linestatus").alias("model"), (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_extendedprice") / 200000).alias("prob"))


@query("w1_roc_curve_lineitem", _ROC.format(base=_LINE_SCORES))
def _(t):
    return rounded(E.roc_curve(_line_scores(t)).select("model", "fpr", "tpr"))


@query("w1_roc_curve_ranges", _ROC.format(base=_LINE_SCORES))
def _(t):
    # the path for more scores than one task can order, forced by a low bound
    return rounded(E.roc_curve(_line_scores(t), ranges=7).select("model", "fpr", "tpr"))


@query("w2_roc_auc", f"WITH {ZONES}, {_AUC} SELECT model, round(roc_auc, 6) AS roc_auc FROM auc")
def _(t):
    return rounded(E.roc_auc(t.zones()))


@query("w2_roc_auc_lineitem", f"WITH {_LINE_SCORES}, {_AUC} SELECT model, round(roc_auc, 6) AS roc_auc FROM auc")
def _(t):
    return rounded(E.roc_auc(_line_scores(t)))


@query("w2_roc_auc_ranges", f"WITH {_LINE_SCORES}, {_AUC} SELECT model, round(roc_auc, 6) AS roc_auc FROM auc")
def _(t):
    return rounded(E.roc_auc(_line_scores(t), ranges=7))


def _sweep(source):
    return f"""{source}, cf AS (SELECT model, k AS step, {_COUNTS.format(p="prob >= k::DOUBLE/100")}
FROM scored, (SELECT unnest(range(1, 100)) AS k) GROUP BY model, k),
sw AS (SELECT model, step, round(step::DOUBLE/100, 6) AS threshold, round((tp + tn)/(tp + fp + tn + fn)::DOUBLE, 4) AS accuracy,
round(coalesce(tp/nullif(tp + fp, 0)::DOUBLE, 0), 4) AS "precision", round(coalesce(tp/nullif(tp + fn, 0)::DOUBLE, 0), 4) AS recall,
round(coalesce(2*tp/nullif(2*tp + fp + fn, 0)::DOUBLE, 0), 4) AS f1, tp, fp, tn, fn, round(5.0::DOUBLE*fn + fp, 2) AS total_cost FROM cf)"""


@query("m8_threshold_sweep", f"WITH {_sweep(ZONES)} SELECT * FROM sw")
def _(t):
    return rounded(E.threshold_sweep(t.zones()))


@query("m8_threshold_sweep_lineitem", f"WITH {_sweep(_LINE_SCORES)} SELECT * FROM sw")
def _(t):
    return rounded(E.threshold_sweep(_line_scores(t)))


_POINTS = """pt AS (SELECT 'default' AS point, * FROM sw QUALIFY row_number() OVER (PARTITION BY model ORDER BY abs(step - 50), step) = 1
UNION ALL SELECT 'max_f1', * FROM sw QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1 DESC, step) = 1
UNION ALL SELECT 'high_recall_safe', * FROM sw QUALIFY row_number() OVER (PARTITION BY model
ORDER BY recall < 0.999, CASE WHEN recall >= 0.999 THEN "precision" ELSE recall END DESC, step) = 1
UNION ALL SELECT 'cost_optimal', * FROM sw QUALIFY row_number() OVER (PARTITION BY model ORDER BY total_cost, step) = 1)"""


@query("w8_operating_points", f"WITH {_sweep(ZONES)}, {_POINTS} SELECT * FROM pt")
def _(t):
    return rounded(E.operating_points(E.threshold_sweep(t.zones())))


_BENCH = f"""bc AS (SELECT model, 0.5::DOUBLE AS tau, {_COUNTS.format(p="prob >= 0.5")} FROM scored GROUP BY model
UNION ALL SELECT model, 0.43::DOUBLE, {_COUNTS.format(p="prob >= 0.43")} FROM scored GROUP BY model),
br AS (SELECT model, avg((prob - y)*(prob - y)) AS brier FROM scored GROUP BY model),
bm AS (SELECT *, {METRICS} FROM bc)"""
_BENCH_OUT = f"""SELECT model, tau, tp, fp, tn, fn, round(brier, 6) AS brier, {_ROUND4}, round(roc_auc, 6) AS roc_auc
FROM bm JOIN br USING (model) JOIN auc USING (model)"""


@query("m18_model_benchmark", f"WITH {ZONES}, {_AUC}, {_BENCH} {_BENCH_OUT}")
def _(t):
    return rounded(E.model_benchmark(t.zones()))


@query("model_benchmark", f"WITH {SCORED}, {_AUC}, {_BENCH} {_BENCH_OUT}")
def _(t):
    return rounded(E.model_benchmark(t.scored()))


@query("w6_most_confident", f"""WITH {ZONES}, o AS (
SELECT model, 'positive' AS side, id, y, prob FROM scored QUALIFY row_number() OVER (PARTITION BY model ORDER BY prob DESC, id) = 1
UNION ALL SELECT model, 'negative', id, y, prob FROM scored QUALIFY row_number() OVER (PARTITION BY model ORDER BY prob, id) = 1)
SELECT model, side, id, y, round(prob, 6) AS prob FROM o""")
def _(t):
    return rounded(E.most_confident(t.zones()))


@query("w7_probability_order", f"""WITH {ZONES} SELECT model, id, y, round(prob, 6) AS prob,
row_number() OVER (PARTITION BY model ORDER BY prob, id) - 1 AS position, (prob >= 0.43) <> (y = 1) AS is_error FROM scored""")
def _(t):
    return rounded(E.probability_order(t.zones()))


_TIES = """SELECT quality AS model, doc_id AS id, toxic AS y, 0.5::DOUBLE AS prob,
row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS position, toxic = 0 AS is_error FROM labels"""


@query("w7_probability_order_ties", _TIES)
def _(t):
    # one score for every row, ordered in ranges cut by id
    rows = t.table("labels").select(
        F.col("quality").alias("model"), F.col("doc_id").alias("id"), F.col("toxic").alias("y"), F.lit(0.5).alias("prob"))
    return E.probability_order(rows, ranges=5)


@query("w11_exemplars", f"""WITH {ZONES}, o AS (
SELECT model, y, 'confident' AS k, id, prob FROM scored QUALIFY row_number() OVER (PARTITION BY model, y ORDER BY CASE WHEN y = 1 THEN -prob ELSE prob END, id) = 1
UNION ALL SELECT model, y, 'borderline', id, prob FROM scored QUALIFY row_number() OVER (PARTITION BY model, y ORDER BY abs(prob - 0.43), id) = 1)
SELECT model, k || '_' || CASE WHEN y = 1 THEN 'mine' ELSE 'rock' END AS sample, y, id, round(prob, 6) AS prob FROM o""")
def _(t):
    return rounded(E.exemplars(t.zones()))


_LIST = "CASE model WHEN 'all' THEN 1 WHEN 'low' THEN 2 WHEN 'mid' THEN 3 ELSE 4 END"


@query("w9_champion", f"""WITH {ZONES}, {_CELLS}, m AS (SELECT *, {METRICS} FROM cf)
SELECT model, round(recall, 6) AS recall, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy FROM m
ORDER BY m.recall DESC, m.f1 DESC, m.accuracy DESC, {_LIST} LIMIT 1""")
def _(t):
    listing = F.array_position(F.array(*[F.lit(m) for m in ("all", "low", "mid", "high")]), F.col("model"))
    table = E.classification_metrics(t.zones()).withColumn("listing", listing)
    return rounded(E.champion(table, ["recall", "f1", "accuracy"]).select("model", "recall", "f1", "accuracy"))


@query("j2_compare_to_baseline", f"""WITH {ZONES}, {_CELLS}, m AS (SELECT *, {METRICS} FROM cf),
cb AS (SELECT model, {_COUNTS.format(p="prob >= 0.3")} FROM scored WHERE model <> 'mid' GROUP BY model),
b AS (SELECT model, f1 AS bf, accuracy AS ba FROM (SELECT *, {METRICS} FROM cb))
SELECT model, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy, round(f1 - coalesce(bf, f1), 6) AS delta_f1,
round(accuracy - coalesce(ba, accuracy), 6) AS delta_accuracy FROM m LEFT JOIN b USING (model)""")
def _(t):
    rows = t.zones()
    baseline = E.classification_metrics(E.apply_tau(rows.where("model <> 'mid'"), 0.3))
    return rounded(E.compare_to_baseline(E.classification_metrics(rows), baseline))


@query("j1_aligned_labels", f"""WITH {SCORED} SELECT id, label, y, round(prob, 6) AS prob FROM scored JOIN sp USING (id, y)""")
def _(t):
    return rounded(t.parts()[1].select("id", "label").join(t.scored(), "id").select("id", "label", "y", "prob"))


@query("x5_misclassified", f"""WITH {SCORED}, o AS (SELECT *, {_KIND} AS k FROM scored)
SELECT id, CASE WHEN y = 1 THEN 'Mine' ELSE 'Rock' END AS actual, CASE WHEN k = 'FP' THEN 'Mine' ELSE 'Rock' END AS predicted,
CASE k WHEN 'FP' THEN 'False Positive (False Alarm)' ELSE 'False Negative (LETHAL MISSED MINE)' END AS error_type,
round(prob, 6) AS prob, round(CASE k WHEN 'FP' THEN prob - 0.43 ELSE 0.43 - prob END, 6) AS margin,
CASE k WHEN 'FP' THEN 0 ELSE 1 END AS listing FROM o WHERE k IN ('FP', 'FN')""")
def _(t):
    return rounded(E.misclassified(t.scored()))


@query("f6_outcomes", f"WITH {ZONES} SELECT model, {_KIND} AS outcome, count(*) AS rows FROM scored GROUP BY 1, 2")
def _(t):
    kind = S.outcome("y", S.is_threat("prob", K.SAFE_TAU).cast("int"))
    return t.zones().groupBy("model", kind.alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))


@query("f11_rescaled_margins", f"""WITH {SCORED} SELECT id, round((m - min(m) OVER ())/(max(m) OVER () - min(m) OVER () + 1e-9::DOUBLE), 6) AS prob FROM scored""")
def _(t):
    test = t.parts()[1].select("id", "features")
    return rounded(E.rescale_margins(L.margin(test, t.fitted())).select("id", "prob"))


@query("f15_weighted_cost", f"WITH {ZONES}, {_CELLS} SELECT model, (5*fn + fp)::DOUBLE AS cost FROM cf")
def _(t):
    return E.confusion(t.zones()).select("model", S.weighted_cost("fn", "fp").alias("cost"))


@query("m10_soft_vote", f"""WITH {ZONES} SELECT id, y, round(sum(CASE model WHEN 'all' THEN 2 ELSE 1 END*prob)/5, 6) AS prob, 'soft_vote' AS model
FROM scored GROUP BY id, y""")
def _(t):
    return rounded(E.soft_vote(t.zones(), E.voting_weights(["all", "low", "mid", "high"])))


@query("m10_plain_vote", f"""WITH {ZONES} SELECT id, y, round(avg(prob), 6) AS prob, 'soft_vote' AS model FROM scored WHERE model <> 'high' GROUP BY id, y""")
def _(t):
    return rounded(E.soft_vote(t.zones().where("model <> 'high'"), E.voting_weights(["all", "low", "mid"])))


@query("u3_stacked_metrics", f"""WITH {ZONES}, {_CELLS}, m AS (SELECT *, {METRICS} FROM cf),
v AS (SELECT 'vote' AS model, y, CASE WHEN sum(CASE model WHEN 'all' THEN 2 ELSE 1 END*prob)/5 >= 0.5 THEN 1 ELSE 0 END AS pred_label FROM scored GROUP BY id, y),
vc AS (SELECT model, {_COUNTS.format(p="pred_label = 1")} FROM v GROUP BY model), vm AS (SELECT *, {METRICS} FROM vc)
SELECT model, tp, fp, tn, fn, {_ROUND4} FROM m UNION ALL SELECT model, tp, fp, tn, fn, {_ROUND4} FROM vm""")
def _(t):
    vote = E.soft_vote(t.zones(), E.voting_weights(["all", "low", "mid", "high"])).withColumn("model", F.lit("vote"))
    return rounded(E.classification_metrics(t.zones()).unionByName(E.classification_metrics(E.apply_tau(vote))))
