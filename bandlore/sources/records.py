"""Model records: what scoring needs to know of a saved model, by version.

A record is a row of a table beside the models: the model's folder name, the version of the write, the threshold of an
operating point, the scaler it was fitted behind and the features it reads. Scoring resolves model and threshold together,
so a model is never judged by another's threshold.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.functions import scalar as S
from bandlore.sources.sinks import slug

RECORD = "model string, version int, point string, threshold double, scaler string, features array<string>"
#: The operating point that scoring uses unless told otherwise.
POINT = "high_recall_safe"


def _there(spark, path):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_records(spark, path):
    """All records; no rows if none were written."""
    return spark.read.schema(RECORD).parquet(path) if _there(spark, path) else spark.createDataFrame([], RECORD)


def newest(records):
    """The records of each model's last version."""
    last = F.max("version").over(Window.partitionBy("model"))  # models x points x versions rows
    return records.withColumn("last", last).where("version = last").drop("last")


def write_records(points, path, champion=None, scaler=None, features=None):
    """Append the operating points (model, point, threshold) of saved models as a new version; the champion's also as
    ``best``."""
    spark = points.sparkSession
    before = read_records(spark, path).agg(F.max("version")).head()[0] or 0
    found = [(slug(r["model"]), r["point"], r["threshold"], r["model"] == champion)
             for r in points.select("model", "point", "threshold").collect()]  # four points per model
    found += [("best", point, tau, False) for _, point, tau, best in found if best]
    names = list(K.FEATURE_COLUMNS if features is None else features)
    rows = [(model, before + 1, point, tau, scaler, names) for model, point, tau, _ in found]
    spark.createDataFrame(rows, RECORD).coalesce(1).write.mode("append").parquet(path)
    return before + 1


def resolve(spark, path, model, explicit=None, point=POINT):
    """The threshold for a model: the explicit one, else that of its newest record, else the safe default."""
    if explicit is None:
        row = newest(read_records(spark, path)).where((F.col("model") == model) & (F.col("point") == point)).head()
        explicit = row["threshold"] if row else None
    return S.check_tau(K.SAFE_TAU if explicit is None else explicit)
