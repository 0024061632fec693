"""Command line jobs, for spark-submit or a local run.

python -m bandlore.jobs ingest     --input signals.csv --out work
python -m bandlore.jobs profile    --out work
python -m bandlore.jobs preprocess --out work [--scaler minmax]
python -m bandlore.jobs train      --out work
python -m bandlore.jobs tune       --out work [--grid coarse]
python -m bandlore.jobs ensemble   --out work
python -m bandlore.jobs explain    --out work
python -m bandlore.jobs predict    --out work --input batch.csv [--header] [--tau 0.43] [--model tuned/best]
"""

import argparse

from pyspark.ml.functions import vector_to_array
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from bandlore.operators import evaluate as E
from bandlore.operators.scaling import BandScalerModel
from bandlore.operators.score import score_batch
from bandlore.plans import modelling
from bandlore.plans.preprocess import SignalPreprocessor
from bandlore.plans.profiling import run_profiling
from bandlore.sources import records, sinks
from bandlore.sources import signals as G


def ingest(spark, source, out, header=False):
    """Labelled CSV to a table with stored ids; bad rows land in their own folder."""
    rows = G.read_checked_csv(spark, source, header).withColumn("id", F.monotonically_increasing_id())
    state = F.when(F.col("reason").isNull(), "good").otherwise("quarantine")
    rows.withColumn("state", state).write.mode("overwrite").partitionBy("state").parquet(f"{out}/signals")
    return signals(spark, out)


def signals(spark, out):
    return spark.read.parquet(f"{out}/signals").where("state = 'good'").select("id", "features", "label")


def profile(spark, out):
    tables = run_profiling(signals(spark, out))
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{out}/profile/{name}")
    return list(tables)


def preprocess(spark, out, scaler="standard"):
    job = SignalPreprocessor(scaler=scaler)
    return job.save(job.fit(signals(spark, out)), f"{out}/prepared")


def prepared(spark, out):
    """The written splits, scaled by the saved scaler."""
    rows = spark.read.parquet(f"{out}/prepared/splits").drop("scaled_array")
    scaler = BandScalerModel.load(f"{out}/prepared/scaler")
    return scaler.transform(rows).withColumn("scaled_array", vector_to_array("scaled"))


def predict(spark, out, source, header=False, tau=None, model="trained/best"):
    """Score an unlabelled batch with a saved model; returns the summary row.

    ``model`` is a job's folder and a model's, as in ``tuned/best`` or ``ensemble/soft-voting-ensemble``. Without
    ``tau`` the threshold of the model's own record is used, else the safe default. The batch is scored once: the summary
    counts what was written.
    """
    job, name = model.split("/", 1)
    tau = records.resolve(spark, f"{out}/{job}/records", name, tau)
    rows = G.read_batch_csv(spark, source, header).withColumn("id", F.monotonically_increasing_id())
    # Ids are fixed by writing them; files are read and checked once.
    rows.write.mode("overwrite").parquet(f"{out}/predictions_input")
    good, bad = G.split_quarantine(spark.read.schema(rows.schema).parquet(f"{out}/predictions_input"))
    scaled = BandScalerModel.load(f"{out}/prepared/scaler").transform(good)
    scaled = scaled.withColumn("scaled_array", vector_to_array("scaled"))
    scored, _ = score_batch(sinks.load_model(spark, f"{out}/{job}/models/{name}"), scaled, tau)
    output = G.to_columns(scored, keep=("id", "Probability_Mine", "Probability_Rock", "Prediction"))
    sinks.write_scored(output, f"{out}/predictions")
    bad.select("id", "raw", "reason").write.mode("overwrite").parquet(f"{out}/predictions_quarantine")
    stored = spark.read.schema(output.schema).option("header", True).csv(f"{out}/predictions")
    return E.batch_summary(stored.select(F.col("Probability_Mine").alias("prob")), tau).head()


def explain(spark, out, repeats=15, background=40, permutations=100):
    """Explain the tuned champion at its own threshold; the trained champion if nothing was tuned."""
    job = "tuned" if records.read_records(spark, f"{out}/tuned/records").head() else "trained"
    model = sinks.load_model(spark, f"{out}/{job}/models/best")
    tau = records.resolve(spark, f"{out}/{job}/records", "best")
    return modelling.run_explanation(prepared(spark, out), model, tau, repeats, background, permutations, f"{out}/explained")


def main(argv=None):
    parser = argparse.ArgumentParser(prog="bandlore.jobs")
    parser.add_argument("job", choices=["ingest", "profile", "preprocess", "train", "tune", "ensemble", "explain", "predict"])
    parser.add_argument("--out", required=True)
    parser.add_argument("--input")
    parser.add_argument("--header", action="store_true")
    parser.add_argument("--scaler", default="standard")
    parser.add_argument("--grid", default="full", choices=["coarse", "full"])
    parser.add_argument("--tau", type=float)
    parser.add_argument("--model", default="trained/best")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"bandlore-{args.job}").getOrCreate()
    out = args.out.rstrip("/")
    if args.job == "ingest":
        ingest(spark, args.input, out, args.header)
    elif args.job == "profile":
        profile(spark, out)
    elif args.job == "preprocess":
        preprocess(spark, out, args.scaler)
    elif args.job == "train":
        modelling.run_training(prepared(spark, out), path=f"{out}/trained")
    elif args.job == "tune":
        modelling.run_tuning(prepared(spark, out), size=args.grid, path=f"{out}/tuned")
    elif args.job == "ensemble":
        modelling.run_ensemble(prepared(spark, out), path=f"{out}/ensemble")
    elif args.job == "explain":
        explain(spark, out)
    else:
        print(predict(spark, out, args.input, args.header, args.tau, args.model).asDict())


if __name__ == "__main__":
    main()
