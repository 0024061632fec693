"""Edge inputs: bad rows, unknown labels, constant bands, empty tables, thresholds, ties."""

import math

import pytest
from pyspark.sql import functions as F

from bandlore.functions import scalar as S
from bandlore.operators import evaluate as E
from bandlore.operators import profile as P
from bandlore.operators import sampling as SA
from bandlore.operators import scaling as SC
from bandlore.operators import score as SCO
from bandlore.plans.preprocess import SignalPreprocessor
from bandlore.sources import signals as G
from bandlore.streaming import score_stream as ST

SCORED = "model string, id bigint, y int, prob double, pred_label int"


def test_unknown_label(spark):
    df = spark.createDataFrame([("M",), ("X",), (None,)], "label string")
    with pytest.raises(Exception, match="unexpected class label"):
        df.select(S.encode_label("label")).collect()
    assert [r[0] for r in df.select(S.encode_label("label", on_unknown="null")).collect()] == [1, None, None]
    assert P.unknown_labels(df).count() == 2
    check = P.label_domain_check(df).head()
    assert (check.absent, check.unexpected, check.equal) == (1, 2, False)


def test_missing_target(spark):
    with pytest.raises(KeyError):
        G.features_and_target(spark.range(3), "label")
    with pytest.raises(KeyError):
        P.class_distribution(spark.range(3))


def test_missing_path(spark):
    with pytest.raises(FileNotFoundError):
        G.read_signal_csv(spark, "/nonexistent/table.csv")


@pytest.mark.parametrize("tau", [0.0, 1.0, -0.1, 1.5])
def test_rejected_thresholds(tau):
    with pytest.raises(ValueError):
        S.check_tau(tau)


def test_validation(spark):
    good = ["0.5"] * 60
    rows = [(1, good), (2, good[:59]), (3, good + ["1"]), (4, good[:59] + ["abc"]), (5, good[:59] + ["NaN"]),
            (6, None), (7, good[:59] + [None])]
    df = spark.createDataFrame(rows, "id int, features array<string>")
    reasons = {r.id: r.reason for r in G.validate(df).collect()}
    assert reasons[1] is None
    assert reasons[2].endswith("59") and reasons[3].endswith("61") and reasons[6] == "no features"
    assert reasons[4] == reasons[5] == reasons[7] == "non-numeric feature"


def test_parse_text(spark):
    sixty = [str(i / 100) for i in range(60)]
    texts = [" ".join(sixty), ", ".join(sixty), ",".join(sixty[:59]), "x " + ",".join(sixty), "", ",".join(sixty) + ",NaN"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    rows = {r.id: r for r in df.select("id", S.parse_signal("t").alias("a"), S.parse_signal_strict("t").alias("b")).collect()}
    assert [rows[i].a is not None for i in range(6)] == [True, True, False, True, False, True]
    assert [rows[i].b is not None for i in range(6)] == [False, True, False, False, False, False]
    assert rows[0].a == [i / 100 for i in range(60)]


def test_threat_level_order_and_confidence(spark):
    df = spark.createDataFrame([(0.8, 0.9), (0.43, 0.43), (0.3, 0.43), (0.1, 0.43), (1.0, 0.5), (0.25, 0.2)], "prob double, tau double")
    rows = df.select(S.threat_level("prob", F.col("tau")).code, S.classification("prob", F.col("tau")),
                     S.confidence_percent("prob", F.col("tau"))).collect()
    # a threshold above 0.75 still gives the top level, with the benign class
    assert tuple(rows[0][:2]) == ("DEFCON-1", "Rock (Benign Object)")
    assert [r[0] for r in rows[1:]] == ["DEFCON-2", "DEFCON-3", "DEFCON-4", "DEFCON-1", "DEFCON-2"]
    assert rows[1][2] == 0.0 and rows[4][2] == 100.0
    assert rows[3][2] == pytest.approx((0.43 - 0.1) / 0.43 * 100)


def test_one_class_set(spark):
    df = spark.createDataFrame([("m", i, 1, 0.1 * i, int(i > 4)) for i in range(8)], SCORED)
    row = E.model_benchmark(df).where("tau = 0.5").head()
    assert (row.fp, row.tn, row.roc_auc) == (0, 0, 0.5)
    assert E.roc_curve(df).count() > 0


def test_no_predicted_positive(spark):
    df = spark.createDataFrame([("m", 1, 1, 0.1, 0), ("m", 2, 0, 0.2, 0)], SCORED)
    row = E.classification_metrics(df).head()
    assert (row.precision, row.recall, row.f1, row.accuracy) == (0.0, 0.0, 0.0, 0.5)


def test_empty_batch(spark):
    df = spark.createDataFrame([], SCORED)
    assert tuple(E.batch_summary(df, 0.5).head()) == (0, 0, 0, 0.0)
    assert E.roc_auc(df).count() == 0
    assert E.threshold_sweep(df).count() == 0


def test_sweep_at_exact_thresholds(spark):
    df = spark.createDataFrame([("m", k, k % 2, k / 100, 0) for k in range(101)], SCORED)
    for r in E.threshold_sweep(df).collect():
        assert r.tp + r.fp == 101 - r.step
    out = spark.createDataFrame([("m", 1, 1, math.nextafter(0.29, 0), 0), ("m", 2, 0, 0.29, 0)], SCORED)
    at = {r.step: (r.tp, r.fp) for r in E.threshold_sweep(out).collect()}
    assert at[29] == (0, 1) and at[28] == (1, 1) and at[30] == (0, 0)


def test_calibration_edges(spark):
    probs = [0.0, 1 / 6, math.nextafter(1 / 6, 1), 0.5, 1.0]
    df = spark.createDataFrame([("m", i, 1, p, 1) for i, p in enumerate(probs)], SCORED)
    assert {r.bin: r.rows for r in E.calibration_curve(df).collect()} == {0: 2, 1: 1, 2: 1, 5: 1}


def test_ties_go_to_the_lowest_id(spark):
    df = spark.createDataFrame([("m", i, i % 2, 0.5, 1) for i in range(6)], SCORED)
    assert {r.side: r.id for r in E.most_confident(df).collect()} == {"positive": 0, "negative": 0}
    assert E.operating_points(E.threshold_sweep(df)).where("point = 'max_f1'").head()["step"] == 1


def test_constant_band(spark):
    rows = [(i, [3.0, float(i), 0.1], "M" if i % 2 else "R") for i in range(10)]
    df = spark.createDataFrame(rows, "id bigint, features array<double>, label string")
    for kind in ("standard", "minmax", "ZScore", " MinMaxScaler "):
        z = SC.scale_features(df, SC.band_scales(df, kind)).select("scaled").collect()
        # the computed mean of equal values may be off by a rounding step
        assert all(abs(r[0][0]) < 1e-12 and abs(r[0][2]) < 1e-12 for r in z)
    with pytest.raises(ValueError):
        SC.band_scales(df, "robust")
    hist = P.class_histogram(df, [1])
    assert {(r.label, r.bin, r.density) for r in hist.collect()} == {("M", 0, None), ("R", 0, None)}


def test_describe_skips_missing(spark):
    rows = [(1, [1.0, None], "M"), (2, [float("nan"), 2.0], "R"), (3, [3.0, 4.0], "M")]
    df = spark.createDataFrame(rows, "id bigint, features array<double>, label string")
    got = {r.band: r for r in P.describe_bands(df).collect()}
    assert (got[1]["count"], got[1]["mean"], got[2]["count"], got[2]["mean"]) == (2, 2.0, 2, 3.0)
    audit = {r.column_name: r.missing for r in P.missing_audit(df).collect()}
    assert audit == {"freq_1": 1, "freq_2": 1, "label": 0}


def test_split_keeps_null_labels_apart(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else "MR"[i % 2]) for i in range(100)], "id bigint, label string")
    got = {r["split"]: r["count"] for r in SA.split_rows(df).groupBy("split").count().collect()}
    assert got == {None: 10, "train": 72, "test": 18}


def test_tiny_split(spark):
    df = spark.createDataFrame([(1, "M"), (2, "R"), (3, "R")], "id bigint, label string")
    got = SA.split_rows(df, test_size=0.5).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 1, "test": 2}


def test_unfitted_preprocessor(signals):
    with pytest.raises(RuntimeError):
        SignalPreprocessor().transform_new(signals)


def test_preprocessor_artifacts(spark, signals, tmp_path):
    job = SignalPreprocessor(scaler="minmax")
    prepared = job.fit(signals)
    path = job.save(prepared, str(tmp_path / "out"))
    train = spark.read.parquet(f"{path}/splits").where("split = 'train'")
    assert train.count() == 400
    low, high = train.agg(F.min(F.array_min("scaled_array")), F.max(F.array_max("scaled_array"))).head()
    assert low == 0.0 and high == pytest.approx(1.0)
    meta = G.read_json_report(spark, f"{path}/metadata").head()
    assert (meta.train_samples, meta.test_samples, meta.scaler_type) == (400, 100, "MinMaxScaler")
    splits, scaling = job.audit(prepared)
    assert splits.where("NOT within_tolerance").count() == 0 and scaling.count() == 2


def test_batch_width(spark, tmp_path):
    path = str(tmp_path / "narrow")
    full = ",".join(["0.5"] * 60)
    lines = ["1.0,2.0", full, full + ",M", full + ",1" * 15, full[:-4], full.replace("0.5", "x", 1)]
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(path)
    rows = G.read_batch_csv(spark, path).collect()
    assert sorted(str(r.reason) for r in rows) == sorted([
        "expected 60 features, got 2", "None", "None", "expected 60 features, got 75", "expected 60 features, got 59",
        "non-numeric feature"])
    assert all(len(r.features) == 60 and r.raw is None for r in rows if r.reason is None)


def test_checked_json(spark, tmp_path):
    path = str(tmp_path / "json")
    good = "[" + ",".join(["0.5"] * 60) + "]"
    docs = [f'{{"signals": [{good}, [1, 2], null]}}', f'{{"signals": [{good.replace("0.5", chr(34) + "x" + chr(34), 1)}]}}',
            "{broken", '{"other": 1}']
    spark.createDataFrame([(v,) for v in docs], "value string").coalesce(1).write.text(path)
    reasons = sorted(str(r.reason) for r in G.read_checked_json(spark, path).collect())
    assert reasons == sorted(["None", "expected 60 features, got 2", "no features", "non-numeric feature", "malformed document",
                              "no features"])


def test_summary_counts_rows_without_values(spark):
    rows = [(1, None, "M"), (2, [1.0] * 10, "R"), (3, [2.0] * 60, None)]
    df = spark.createDataFrame(rows, "id bigint, features array<double>, label string")
    got = P.dataset_summary(df).head()
    assert (got.num_rows, got.num_features, got.num_cols, got.global_max) == (3, 60, 61, 2.0)
    missing = {r.column_name: r.missing for r in P.missing_audit(df).collect()}
    assert (missing["freq_10"], missing["freq_11"], missing["freq_60"], missing["label"]) == (1, 2, 2, 1)
    assert P.dataset_summary(df.where("false")).head().num_rows == 0


def test_batch_preview_and_columns(spark):
    df = spark.createDataFrame([(i, i / 100) for i in range(80)], "id bigint, prob double")
    top = SCO.batch_preview(df, 0.43).collect()
    assert [r.signal_index for r in top] == list(range(1, 51))
    assert [r.is_threat for r in top] == [i >= 43 for i in range(50)]


def test_stream_equals_batch_and_resumes(spark, signals, tmp_path):
    from bandlore.operators import linear as L

    fitted = L.fit_mean_difference(signals)
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = signals.select("id", "features")
    rows.where("id < 300").repartition(3).write.parquet(src)
    scorer = ST.linear_scorer(fitted, L.SLOPE)

    def run():
        stream = ST.read_vector_stream(spark, src, "id bigint, features array<double>", 1)
        return ST.run_available(stream, scorer, 0.43, out)

    done, _, read = run()
    assert spark.read.parquet(done).count() == 300 == read
    rows.where("id >= 300").write.mode("append").parquet(src)
    assert run()[2] == signals.count() - 300 and run()[2] == 0
    batch = SCO.decide(scorer(rows), 0.43).select("id", "prob", "is_threat", "threat")
    streamed = spark.read.parquet(done).select("id", "prob", "is_threat", "threat")
    assert streamed.count() == signals.count()
    assert batch.exceptAll(streamed).count() == 0 == streamed.exceptAll(batch).count()


def test_replayed_batch_changes_nothing(spark, signals, tmp_path):
    from bandlore.operators import linear as L

    out = str(tmp_path / "out")
    rows = signals.select("id", F.when(F.col("id") % 10 != 0, F.col("features")).alias("features"))
    write = ST.batch_writer(ST.linear_scorer(L.fit_mean_difference(signals), L.SLOPE), 0.43, out)
    for number, part in ((0, "id < 200"), (1, "id >= 200"), (1, "id >= 200"), (0, "id < 200")):
        write(rows.where(part), number)
    good, bad = (spark.read.parquet(f"{out}/{name}") for name in ("scored", "quarantine"))
    assert good.select("id").distinct().count() == good.count() and bad.count() == signals.where("id % 10 = 0").count()
    assert good.count() == signals.count() - bad.count() and sorted(r.batch for r in bad.select("batch").distinct().collect()) == [0, 1]


def test_checked_csv(spark, tmp_path):
    path = str(tmp_path / "lines")
    good = ",".join(["0.5"] * 60)
    lines = [good + ",M", good + ",R", "x" + good[3:] + ",M", good, good + ",0.5,M"]
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(path)
    got = G.read_checked_csv(spark, path).select("reason").collect()
    assert sorted(str(r.reason) for r in got) == sorted([
        "None", "None", "non-numeric feature", "expected 61 columns, got 60", "expected 61 columns, got 62"])
