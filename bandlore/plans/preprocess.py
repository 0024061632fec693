"""Preprocessing job: encode, split, scale on training rows, write the splits."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bandlore.functions import scalar as S
from bandlore.operators.sampling import split_audit, split_metadata, split_rows
from bandlore.operators.scaling import CLASS_NAMES, BandScaler, scaler_kind, scaling_audit
from bandlore.sources.sinks import write_report_json, write_splits


class SignalPreprocessor:
    """Fits on a labelled signal table (id, features, label) and serves new signals."""

    def __init__(self, test_size=0.2, seed=42, stratify=True, scaler="standard"):
        self.test_size, self.seed, self.stratify = test_size, seed, stratify
        self.kind = scaler_kind(scaler)
        self.scaler = None

    def fit(self, df, mapping=None):
        """Rows with y, split, ``scaled`` (vector) and ``scaled_array``."""
        encoded = df.withColumn("y", S.encode_label("label", mapping))
        split = split_rows(encoded, self.test_size, self.seed, self.stratify, "y")
        self.scaler = BandScaler(kind=self.kind).fit(split.where("split = 'train'"))
        return self.transform_new(split)

    def transform_new(self, df):
        if self.scaler is None:
            raise RuntimeError("the preprocessor is not fitted")
        scaled = self.scaler.transform(df)
        return scaled.withColumn("scaled_array", vector_to_array("scaled"))

    def audit(self, prepared):
        plain = prepared.select("id", "y", "split", F.col("scaled_array").alias("scaled"))
        return split_audit(plain, "y"), scaling_audit(plain)

    def save(self, prepared, path):
        """Splits as partitioned parquet, the fitted scaler and the metadata record."""
        keep = prepared.drop("scaled")
        write_splits(keep, f"{path}/splits")
        self.scaler.write().overwrite().save(f"{path}/scaler")
        write_report_json(split_metadata(keep, CLASS_NAMES[self.kind]), f"{path}/metadata")
        return path


def run_preprocessing(df, path=None, **options):
    job = SignalPreprocessor(**options)
    prepared = job.fit(df)
    splits, scaling = job.audit(prepared)
    if path:
        job.save(prepared, path)
    return {"prepared": prepared, "preprocessor": job, "split_audit": splits, "scaling_audit": scaling}
