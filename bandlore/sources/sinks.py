"""Writers: splits, metric tables, reports, scored rows, fitted models."""

import re

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.functions import scalar as S
from bandlore.operators.neighbors import KnnModel


def write_splits(df, path):
    """One folder per split, so that reading a split prunes the other."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def read_split(spark, path, split):
    return spark.read.parquet(path).where(F.col("split") == split)


def write_table_csv(df, path):
    """A metric table (one row per model, sweep step or curve point) as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def rounded(df, digits=4):
    """Every fractional column rounded for output."""
    return df.select(*[
        F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c)
        for c, t in df.dtypes
    ])


def report_text(df, name="report"):
    """The one row of ``df`` as a JSON document, stamped with the time of writing."""
    stamped = df.withColumn("timestamp", F.current_timestamp())
    return stamped.select(F.to_json(F.struct(*stamped.columns)).alias(name))


def write_report_json(df, path):
    report_text(df, "value").coalesce(1).write.mode("overwrite").text(path)
    return path


def write_scored(df, path, fmt="csv"):
    """Batch predictions; one file per task, no gathering."""
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)
    return path


def save_model(model, path):
    """Any fitted model: an ML model by its writer, the neighbour model and the ensembles by their own."""
    model.write().overwrite().save(path) if hasattr(model, "write") else model.save(path)
    return path


def slug(name):
    """A folder name for a model name."""
    return re.sub("[^a-z0-9]+", "-", name.casefold()).strip("-")


def save_models(models, path, champion=None):
    """Every fitted model in its own folder, and the champion a second time as ``best``."""
    saved = {name: save_model(m, f"{path}/{slug(name)}") for name, m in models.items()}
    if champion is not None:
        saved["best"] = save_model(models[champion], f"{path}/best")
    return saved


def load_model(spark, path):
    """Any saved model. Saved metadata names an ML model's class, a table of names marks an ensemble, one of weights the
    closed-form scorer; the neighbour model is a plain table."""
    def there(name):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)

    if there("metadata"):
        return DefaultParamsReader.loadParamsInstance(path, spark)
    if there("ensemble"):
        from bandlore.operators.ensemble import load_ensemble

        return load_ensemble(spark, path)
    if there("linear"):
        from bandlore.operators.linear import MeanDifferenceModel

        return MeanDifferenceModel.load(spark, path)
    return KnnModel.load(spark, path)


def write_threshold(points, path, point="high_recall_safe"):
    """The threshold of one operating point as a JSON document {"point": .., "threshold": ..}."""
    chosen = points.where(F.col("point") == point).select("model", "point", "threshold")
    return write_report_json(chosen, path)


def stored_threshold(spark, path, explicit=None):
    """The explicit threshold, else the one stored at ``path``, else the safe default."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if explicit is None and at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        text = spark.read.text(path, wholetext=True).where(F.length(F.trim("value")) > 0)
        stored = text.select(S.json_number("value", "$.threshold", K.SAFE_TAU).alias("t")).head()
        explicit = stored["t"] if stored else None
    return S.check_tau(K.SAFE_TAU if explicit is None else explicit)
