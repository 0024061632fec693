"""Evaluation over the scored relation (id, model, y, prob, pred_label).

Counts are reduced to a handful of cells per model before any metric is computed, so all
metrics of all models come from one pass with map-side combining.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.functions import scalar as S
from bandlore.operators.ordered import Ranged


def apply_tau(scored, tau=K.DEFAULT_TAU):
    """Replace the scorer's hard label by the threshold rule (inclusive)."""
    return scored.withColumn("pred_label", S.is_threat("prob", tau).cast("int"))


def _cells(y, pred):
    positive, called = F.col(y) == 1, pred == 1
    return [
        F.count_if(positive & called).alias("tp"), F.count_if(~positive & called).alias("fp"),
        F.count_if(~positive & ~called).alias("tn"), F.count_if(positive & ~called).alias("fn"),
    ]


def confusion(scored, by=("model",), y="y", pred="pred_label"):
    """TP, FP, TN, FN; all four cells exist even if a class is absent."""
    return scored.groupBy(*by).agg(*_cells(y, F.col(pred)))


def with_metrics(counts):
    """Accuracy, precision, recall and F1 from the four cells; 0 where undefined."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.select(
        "*", S.ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        S.ratio(tp, tp + fp).alias("precision"), S.ratio(tp, tp + fn).alias("recall"),
        S.ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def classification_metrics(scored, by=("model",)):
    return with_metrics(confusion(scored, by))


def classification_report(scored, by=("model",)):
    """Per class, accuracy, macro and support-weighted rows, all from the four cells."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn

    def line(name, p, r, f, support):
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
            support.cast("bigint").alias("support"),
        )

    p0, r0, f0 = S.ratio(tn, tn + fn), S.ratio(tn, tn + fp), S.ratio(2 * tn, 2 * tn + fn + fp)
    p1, r1, f1 = S.ratio(tp, tp + fp), S.ratio(tp, tp + fn), S.ratio(2 * tp, 2 * tp + fp + fn)
    s0, s1 = tn + fp, tp + fn
    accuracy = S.ratio(tp + tn, n)

    def weighted(a, b):
        return S.ratio(a * s0 + b * s1, n)

    lines = F.array(
        line("Rock (0)", p0, r0, f0, s0), line("Mine (1)", p1, r1, f1, s1),
        line("accuracy", accuracy, accuracy, accuracy, n),
        line("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        line("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), n),
    )
    return confusion(scored, by).select(*by, F.explode(lines).alias("l")).select(*by, "l.*")


def brier(scored, by=("model",)):
    return scored.groupBy(*by).agg(F.avg(F.pow(F.col("prob") - F.col("y"), F.lit(2))).alias("brier"))


def calibration_curve(scored, by=("model",), bins=K.CALIBRATION_BINS):
    """Share of positives and mean score per right-closed uniform bin; empty bins are absent."""
    inner = [i / bins for i in range(1, bins)]
    slot = sum((F.when(F.col("prob") > e, 1).otherwise(0) for e in inner), F.lit(0))
    return scored.groupBy(*by, slot.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg("y").alias("fraction_of_positives"),
        F.avg("prob").alias("mean_predicted"),
    )


def _score_groups(scored, by, ranges):
    """Distinct scores from high to low with their positives and negatives."""
    groups = scored.groupBy(*by, "prob").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg")
    )
    return Ranged(groups, by, [F.desc("prob")], ranges)


def roc_auc(scored, by=("model",), ranges=None):
    """Exact area under the ROC curve, ties count half; 0.5 if a class is absent."""
    run = _score_groups(scored, by, ranges).running({"pos_upto": "pos"})
    won = F.col("neg") * (F.col("pos_upto") - F.col("pos") + 0.5 * F.col("pos"))
    sums = run.groupBy(*by).agg(F.sum(won).alias("w"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return sums.select(
        *by, F.coalesce(F.try_divide(F.col("w"), F.col("p").cast("double") * F.col("n")), F.lit(0.5)).alias("roc_auc")
    )


def roc_curve(scored, by=("model",), ranges=None):
    """Curve points in order of falling score, corners only, with the origin first.

    A point is dropped if both counts of the next score equal its own: it then lies on the
    straight line between its neighbours. First and last score always stay.
    """
    by = list(by)
    run = _score_groups(scored, by, ranges).add_next(["pos", "neg"]).running({"tp": "pos", "fp": "neg"})
    totals = run.groupBy(*by).agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    last = F.col("next_pos").isNull()
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    bends = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    corners = run.where(last | first | bends).select(*by, F.col("prob").alias("threshold"), "tp", "fp")
    origin = totals.select(
        *by, F.lit(float("inf")).alias("threshold"),
        F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("fp"),
    )
    points = origin.unionByName(corners).join(totals, by)
    return points.select(
        *by, "threshold", S.ratio("fp", "n").alias("fpr"), S.ratio("tp", "p").alias("tpr")
    )


def _tau_steps(prob):
    """How many of the thresholds 0.01, 0.02, .. 0.99 a score reaches.

    floor(100 p) can be off by one against the threshold values, so the two neighbours
    are compared exactly.
    """
    guess = F.floor(prob * 100.0)
    up = F.when(prob >= (guess + 1) / F.lit(100.0), 1).otherwise(0)
    down = F.when(prob < guess / F.lit(100.0), 1).otherwise(0)
    return F.greatest(F.least(guess + up - down, F.lit(K.N_TAUS)), F.lit(0))


def threshold_sweep(scored, by=("model",), fn_cost=K.FN_COST, fp_cost=K.FP_COST):
    """Metrics and cost at 99 thresholds.

    Rows are counted once into 100 score buckets per model; the thresholds are suffix sums
    over those buckets, so the cost does not depend on their number.
    """
    by = list(by)
    buckets = scored.groupBy(*by, _tau_steps(F.col("prob")).alias("k")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg")
    )
    steps = F.sequence(F.lit(0).cast("bigint"), F.lit(K.N_TAUS).cast("bigint"))
    frame = buckets.select(*by).distinct().select(
        *by, F.explode(steps).alias("k"), F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("neg")
    )
    full = buckets.unionByName(frame).groupBy(*by, "k").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    above = Window.partitionBy(*by).orderBy(F.desc("k"))  # 100 rows per model
    whole = Window.partitionBy(*by)
    cells = full.select(
        *by, "k", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(whole).alias("p"), F.sum("neg").over(whole).alias("n"),
    ).where("k > 0").select(
        *by, F.col("k").alias("step"), (F.col("k") / F.lit(100.0)).alias("threshold"), "tp", "fp",
        (F.col("n") - F.col("fp")).alias("tn"), (F.col("p") - F.col("tp")).alias("fn"),
    )
    out = with_metrics(cells)
    return out.select(
        *by, "step", "threshold",
        *[F.round(c, 4).alias(c) for c in ("accuracy", "precision", "recall", "f1")],
        "tp", "fp", "tn", "fn",
        F.round(S.weighted_cost("fn", "fp", fn_cost, fp_cost), 2).alias("total_cost"),
    )


def operating_points(sweep, by=("model",)):
    """Four rows per model: default, max_f1, high_recall_safe, cost_optimal.

    Chosen from the rounded sweep; the lowest threshold wins ties. The safe point has the
    best precision among full-recall steps, else the best recall.
    """
    by = list(by)
    step = F.col("step")
    row = F.struct(*[c for c in sweep.columns if c not in by])
    full = F.col("recall") >= K.FULL_RECALL
    rules = {
        "default": F.struct(F.abs(step - 50), step),
        "max_f1": F.struct(-F.col("f1"), step),
        "high_recall_safe": F.struct(
            F.when(full, 0).otherwise(1), F.when(full, -F.col("precision")).otherwise(-F.col("recall")), step
        ),
        "cost_optimal": F.struct(F.col("total_cost"), step),
    }
    picked = sweep.groupBy(*by).agg(*[F.min_by(row, rule).alias(name) for name, rule in rules.items()])
    listed = F.array(*[F.struct(F.lit(n).alias("point"), F.col(n).alias("r")) for n in rules])
    return picked.select(*by, F.explode(listed).alias("s")).select(*by, "s.point", "s.r.*")


def model_benchmark(scored, by=("model",), taus=(K.DEFAULT_TAU, K.SAFE_TAU), ranges=None):
    """One row per model and threshold: counts, metrics, AUC and Brier score."""
    by = list(by)
    # every threshold is counted in the same pass over the scores
    cells = [
        c.alias(f"{name}_{i}") for i, t in enumerate(taus)
        for c, name in zip(_cells("y", S.is_threat("prob", t).cast("int")), ("tp", "fp", "tn", "fn"))
    ]
    counted = scored.groupBy(*by).agg(
        *cells, F.avg(F.pow(F.col("prob") - F.col("y"), F.lit(2))).alias("brier")
    )
    listed = F.array(*[
        F.struct(F.lit(float(t)).alias("tau"), *[F.col(f"{c}_{i}").alias(c) for c in ("tp", "fp", "tn", "fn")])
        for i, t in enumerate(taus)
    ])
    per_tau = counted.select(*by, "brier", F.explode(listed).alias("s")).select(*by, "s.*", "brier")
    return with_metrics(per_tau).join(roc_auc(scored, by, ranges), by)


def fold_summary(per_fold, by=("model", "metric")):
    """Mean and population sd over folds of a long (model, fold, metric, value) table."""
    return per_fold.groupBy(*by).agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def long_metrics(wide, by, metrics=("accuracy", "precision", "recall", "f1", "roc_auc")):
    """One row per metric."""
    listed = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])
    return wide.select(*by, F.explode(listed).alias("s")).select(*by, "s.metric", "s.value")


def batch_summary(scored, tau):
    """Totals of a batch; an empty batch gives zeros."""
    hit = S.is_threat("prob", tau)
    return scored.agg(
        F.count(F.lit(1)).alias("total_signals"), F.count_if(hit).alias("threats_detected"),
        F.count_if(~hit).alias("benign_detected"),
    ).withColumn("threat_rate_pct", S.ratio("threats_detected", "total_signals") * 100.0)


def safety_audit(scored, by=("model",), tau=K.SAFE_TAU):
    """Positives, positives missed at the threshold, and whether none is missed."""
    return scored.groupBy(*by).agg(
        F.count_if(F.col("y") == 1).alias("positives"),
        F.count_if((F.col("y") == 1) & ~S.is_threat("prob", tau)).alias("missed"),
    ).withColumn("zero_missed", F.col("missed") == 0)


def misclassified(scored, tau=K.SAFE_TAU):
    """Error rows with text and margin; false positives sort before false negatives."""
    kind = scored.withColumn("outcome", S.outcome("y", S.is_threat("prob", tau).cast("int")))
    return kind.where(F.col("outcome").isin("FP", "FN")).select(
        "id", F.when(F.col("y") == 1, "Mine").otherwise("Rock").alias("actual"),
        F.when(F.col("outcome") == "FP", "Mine").otherwise("Rock").alias("predicted"),
        S.error_text("outcome").alias("error_type"), "prob",
        S.error_margin("outcome", "prob", tau).alias("margin"),
        F.when(F.col("outcome") == "FP", 0).otherwise(1).alias("listing"),
    )


def outcome_profile(scored, tau=K.SAFE_TAU):
    """Mean spectrum of the correct rows, per outcome and band."""
    kind = scored.select("features", S.outcome("y", S.is_threat("prob", tau).cast("int")).alias("outcome"))
    right = kind.where(F.col("outcome").isin("TP", "TN"))
    long = right.select("outcome", F.posexplode("features").alias("pos", "x"))
    return long.groupBy("outcome", (F.col("pos") + 1).alias("band")).agg(
        F.count("x").alias("rows"), F.avg("x").alias("mean")
    )


def error_features(signals, errors):
    """Features of the error rows, looked up by id."""
    return signals.join(errors.select("id"), "id", "left_semi")


def probability_order(scored, tau=K.SAFE_TAU, by=("model",), ranges=None):
    """Rows by rising score with their 0-based position; errors are marked."""
    slim = scored.select(*by, "id", "y", "prob")
    placed = Ranged(slim, by, [F.col("prob"), F.col("id")], ranges).positions()
    return placed.withColumn("is_error", S.is_threat("prob", tau).cast("int") != F.col("y"))


def _extreme_rows(rows, by, values):
    """For each name in ``values`` the row of the highest value per group, lowest id on ties.

    One pass finds all maxima, one pass over the rows finds the lowest id at each; plain maxima and minima aggregate by
    hash, where a maximum over whole rows would sort them all.
    """
    by = list(by)
    named = list(values)
    valued = rows.select("*", *[v.alias(f"_v{i}") for i, v in enumerate(values.values())])
    best = valued.groupBy(*by).agg(*[F.max(f"_v{i}").alias(f"_m{i}") for i in range(len(named))])
    kept = [c for c in rows.columns if c not in by]
    hits = F.array(*[F.when(F.col(f"_v{i}") == F.col(f"_m{i}"), F.lit(n)) for i, n in enumerate(named)])
    ties = valued.join(best, by).select(*by, *kept, F.explode(F.array_compact(hits)).alias("_name"))
    first = ties.groupBy(*by, "_name").agg(F.min_by(F.struct(*kept), "id").alias("_row"))
    return first.select(*by, "_name", "_row.*")


def most_confident(scored, by=("model",)):
    """Highest and lowest score; the lowest id wins ties."""
    slim = scored.select(*by, "id", "y", "prob")
    both = _extreme_rows(slim, by, {"positive": F.col("prob"), "negative": -F.col("prob")})
    return both.select(*by, F.col("_name").alias("side"), "id", "y", "prob")


def exemplars(scored, tau=K.SAFE_TAU, by=("model",)):
    """Per model and class, the surest row and the one closest to the threshold."""
    by = [*by, "y"]
    toward = F.when(F.col("y") == 1, F.col("prob")).otherwise(-F.col("prob"))
    slim = scored.select(*by, "id", "prob")
    both = _extreme_rows(slim, by, {"confident": toward, "borderline": -F.abs(S.signed_margin("prob", tau))})
    side = F.when(F.col("y") == 1, "mine").otherwise("rock")
    return both.select(*by, F.concat_ws("_", "_name", side).alias("sample"), "id", "prob")


def champion(metrics, order, listing="listing"):
    """The first model by falling metric values; the earlier listed one wins ties."""
    return metrics.orderBy(*[F.desc(c) for c in order], listing).limit(1)


def compare_to_baseline(tuned, baseline):
    """Change of F1 and accuracy against the baseline of the same model; 0 if there is none."""
    base = baseline.select("model", F.col("f1").alias("b_f1"), F.col("accuracy").alias("b_accuracy"))
    return tuned.join(base, "model", "left").select(
        "model", "f1", "accuracy",
        (F.col("f1") - F.coalesce("b_f1", "f1")).alias("delta_f1"),
        (F.col("accuracy") - F.coalesce("b_accuracy", "accuracy")).alias("delta_accuracy"),
    )


def rescale_margins(df, margin="margin", out="prob"):
    """Margins mapped to 0..1 by the range over the whole table."""
    span = df.agg(F.struct(F.min(margin).alias("lo"), F.max(margin).alias("hi")).alias("r"))
    return df.withColumn("_r", span.scalar()).withColumn(out, S.rescale(margin, "_r.lo", "_r.hi")).drop("_r")


def soft_vote(scored, weights=None):
    """Weighted mean probability per row over the members of a long scored relation.

    ``weights`` maps model to weight; without it all members count alike. Rows of one id
    leave the scorer side by side, so they combine before the shuffle.
    """
    if weights:
        table = F.create_map(*[F.lit(v) for pair in weights.items() for v in pair])
        w = F.try_element_at(table, F.col("model"))
    else:
        w = F.lit(1.0)
    blended = scored.groupBy("id", "y").agg((F.sum(w * F.col("prob")) / F.sum(w)).alias("prob"))
    return blended.withColumn("model", F.lit("soft_vote"))


def voting_weights(members):
    """2,1,1,1 for a full team of four in listing order, else equal weights."""
    if len(members) != len(K.VOTING_WEIGHTS):
        return None
    return dict(zip(members, K.VOTING_WEIGHTS))
