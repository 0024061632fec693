"""Continuous scoring: validate, set bad rows aside, score, decide. Stateless; one stream for both sides."""

from pyspark.sql import functions as F

from bandlore.functions import scalar as S
from bandlore.functions import vectors as V
from bandlore.operators.models import with_scores
from bandlore.operators.score import decide
from bandlore.sources.signals import split_quarantine, validate


def read_vector_stream(spark, path, schema, files_per_trigger=None):
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def linear_scorer(fitted, slope):
    """The mean-difference scorer with its parameters as constants, usable on a stream."""
    p = fitted.head()["p"]  # two values per band
    centre, weight = V.literal_array(p["centre"]), V.literal_array(p["weight"])
    margin = V.dot(V.subtract("features", centre), weight)
    return lambda df: df.withColumn("prob", V.sigmoid(F.lit(slope) * margin))


def model_scorer(model, keep=("id", "features")):
    """Any fitted pipeline that reads ``features``."""
    return lambda df: with_scores(model, df.select(*keep))


def score_stream(source, scorer, tau):
    """(decided rows, quarantined rows) of a stream or a batch with (id, features)."""
    tau = S.check_tau(tau)
    good, bad = split_quarantine(validate(source))
    return decide(scorer(good), tau), bad.select("id", "reason")


def batch_writer(scorer, tau, out):
    """A function that splits, scores and writes a batch of (id, features) under its number.

    Both sides come from one reading of the batch. A batch that is played again, after a failure between writing and
    logging, replaces what it wrote before.
    """

    def write(batch, number):
        held = batch.persist()
        try:
            for name, frame in zip(("scored", "quarantine"), score_stream(held, scorer, tau)):
                frame.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        finally:
            held.unpersist()

    return write


def run_available(source, scorer, tau, out):
    """Process everything that has arrived by one stream, then stop: the folders of scored and quarantined rows (with the
    column ``batch``) and the number of rows read. Run again with the same ``out`` it goes on from its own log, which lies
    beside the output on the shared storage."""
    query = source.writeStream.foreachBatch(batch_writer(scorer, tau, out)).option(
        "checkpointLocation", f"{out}/log").trigger(availableNow=True).start()
    query.awaitTermination()
    read = sum(p["numInputRows"] for p in query.recentProgress)
    return f"{out}/scored", f"{out}/quarantine", read
