"""The command line jobs one after the other, over files."""

from pyspark.sql import functions as F

from bandlore import jobs
from bandlore.operators import ensemble as EN
from bandlore.operators import models as M
from bandlore.plans import modelling
from bandlore.sources import records, sinks
from bandlore.sources import signals as G


def test_jobs_in_order(spark, signals, tmp_path):
    source, batch, out = (str(tmp_path / n) for n in ("in", "batch", "out"))
    wide = G.to_columns(signals, keep=("label",))
    values = [c for c in wide.columns if c != "label"]
    wide.select(*values, "label").write.csv(source)
    wide.limit(40).select(*values).write.option("header", True).csv(batch)

    assert jobs.ingest(spark, source, out).count() == signals.count()
    assert "correlation" in jobs.profile(spark, out)
    assert spark.read.parquet(f"{out}/profile/describe").count() == 60
    jobs.preprocess(spark, out)
    rows = jobs.prepared(spark, out)
    assert rows.where("split = 'train'").count() == 400
    made = modelling.run_training(rows, {M.LOGISTIC: M.logistic}, path=f"{out}/trained")
    assert made["champion"] == M.LOGISTIC
    summary = jobs.predict(spark, out, batch, header=True)
    assert summary.total_signals == 40 == summary.threats_detected + summary.benign_detected
    scored = spark.read.option("header", True).csv(f"{out}/predictions")
    assert scored.count() == 40 and {"Probability_Mine", "Probability_Rock", "Prediction", "freq_60"} <= set(scored.columns)
    tau = records.resolve(spark, f"{out}/trained/records", "best")
    assert scored.where((F.col("Probability_Mine") >= tau) != (F.col("Prediction") == "Mine")).count() == 0
    assert records.resolve(spark, f"{out}/trained/records", "never-saved") == 0.43

    modelling.run_tuning(rows, size="coarse", names=[M.LOGISTIC], path=f"{out}/tuned")
    voting = EN.VotingModel({"a": M.logistic, "b": lambda n: M.logistic(n, 0.1)}).fit(rows.where("split = 'train'"))
    stacked = EN.StackingModel({"a": M.logistic}, 2).fit(modelling.folds_of(rows, 2)[0])
    sinks.save_models({EN.VOTING: voting, EN.STACKING: stacked}, f"{out}/ensemble/models")
    test = rows.where("split = 'test'")
    for model in (voting, stacked):
        name = EN.VOTING if model is voting else EN.STACKING
        again = sinks.load_model(spark, f"{out}/ensemble/models/{sinks.slug(name)}")
        a, b = (M.with_scores(m, test).select("id", F.round("prob", 9)) for m in (model, again))
        assert type(again) is type(model) and a.exceptAll(b).count() == 0
    for name in ("tuned/best", "tuned/logistic-regression", "ensemble/soft-voting-ensemble"):
        assert jobs.predict(spark, out, batch, header=True, model=name).total_signals == 40
    hits = []
    for tau in (0.05, 0.95):  # a new version of the model's record decides, that of another model does not
        point = spark.createDataFrame([("m", "high_recall_safe", tau)], "model string, point string, threshold double")
        records.write_records(point, f"{out}/trained/records", champion="m")
        records.write_records(point.withColumn("threshold", F.lit(0.5)), f"{out}/trained/records")
        hits.append(jobs.predict(spark, out, batch, header=True).threats_detected)
    assert hits[0] > hits[1]
    assert jobs.predict(spark, out, batch, header=True, tau=0.95).threats_detected == hits[1]
    tuned = records.newest(records.read_records(spark, f"{out}/tuned/records"))
    assert tuned.count() == 8 and tuned.where("size(features) <> 60").count() == 0
    jobs.predict(spark, out, batch, header=True, model="tuned/best")
    tau = tuned.where("model = 'best' and point = 'high_recall_safe'").head().threshold
    scored = spark.read.option("header", True).csv(f"{out}/predictions")
    assert scored.where((F.col("Probability_Mine") >= tau) != (F.col("Prediction") == "Mine")).count() == 0
    made = jobs.explain(spark, out, 2, 3, 2)
    assert made["shapley"].count() == 15
    assert spark.read.json(f"{out}/explained/report").head().threshold == tau


def test_command_line(spark, signals, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    wide = G.to_columns(signals, keep=("label",))
    wide.select(*[c for c in wide.columns if c != "label"], "label").write.csv(source)
    jobs.main(["ingest", "--input", source, "--out", out])
    jobs.main(["preprocess", "--out", out, "--scaler", "minmax"])
    assert jobs.prepared(spark, out).count() == signals.count()
