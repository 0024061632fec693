"""Scalers fitted on training rows only, as pipeline stages without Python in the row path."""

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from bandlore.functions import vectors as V
from bandlore.sources.signals import bands, present_values

SCALERS = {
    "standard": "standard", "standardscaler": "standard", "zscore": "standard",
    "minmax": "minmax", "minmaxscaler": "minmax",
}
CLASS_NAMES = {"standard": "StandardScaler", "minmax": "MinMaxScaler"}


def scaler_kind(name):
    kind = SCALERS.get(name.strip().lower())
    if kind is None:
        raise ValueError(f"unsupported scaler {name!r}; use 'standard' or 'minmax'")
    return kind


def band_scales(train, kind="standard"):
    """(band, shift, scale) from the training rows; a band without spread keeps scale 1.

    standard: mean and population sd. minmax: minimum and range, so a constant band maps to 0.
    """
    kind = scaler_kind(kind)
    long = present_values(bands(train.select("features")))
    if kind == "standard":
        shift, scale = F.avg("x"), F.stddev_pop("x")
    else:
        shift, scale = F.min("x"), F.max("x") - F.min("x")
    # a constant band has min = max exactly, while its computed sd may be a rounding residue
    return long.groupBy("band").agg(
        shift.alias("shift"),
        F.when(F.min("x") < F.max("x"), scale).otherwise(F.lit(1.0)).alias("scale"),
    )


def scales_row(scales):
    """The per-band table as one row of two arrays in band order."""
    s = F.array_sort(F.collect_list(F.struct("band", "shift", "scale")))  # one entry per band
    return scales.agg(s.alias("s")).select(
        F.struct(F.col("s.shift").alias("shift"), F.col("s.scale").alias("scale")).alias("p")
    )


def scale_features(df, scales, out="scaled"):
    """Scale every row by a fitted (band, shift, scale) table, attached as a scalar subquery."""
    return df.withColumn("_p", scales_row(scales).scalar()).withColumn(
        out, V.shift_scale("features", "_p.shift", "_p.scale")
    ).drop("_p")


def unscale_features(df, scales, column="scaled", out="features"):
    return df.withColumn("_p", scales_row(scales).scalar()).withColumn(
        out, V.unscale(column, "_p.shift", "_p.scale")
    ).drop("_p")


def scaling_audit(df):
    """Range over the bands of mean and sample sd of the scaled values, per split."""
    long = df.select("split", F.posexplode("scaled").alias("band", "x"))
    per_band = long.groupBy("split", "band").agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s"))
    return per_band.groupBy("split").agg(
        F.min("m").alias("mean_min"), F.max("m").alias("mean_max"),
        F.min("s").alias("std_min"), F.max("s").alias("std_max"),
    )


class _ScalerParams(Params):
    inputCol = Param(Params._dummy(), "inputCol", "feature array", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "scaled vector", TypeConverters.toString)
    kind = Param(Params._dummy(), "kind", "standard or minmax", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="scaled", kind="standard")


class BandScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="scaled", kind="standard"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, kind=scaler_kind(kind))

    def _fit(self, dataset):
        kind = self.getOrDefault("kind")
        source = dataset.select(F.col(self.getOrDefault("inputCol")).alias("features"))
        rows = sorted(band_scales(source, kind).collect(), key=lambda r: r["band"])  # one row per band
        model = BandScalerModel()
        model._set(
            inputCol=self.getOrDefault("inputCol"), outputCol=self.getOrDefault("outputCol"), kind=kind,
            shift=[r["shift"] for r in rows], scale=[r["scale"] for r in rows],
        )
        return model


class BandScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    shift = Param(Params._dummy(), "shift", "per-band shift", TypeConverters.toListFloat)
    scale = Param(Params._dummy(), "scale", "per-band scale", TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()

    def _scaled(self):
        return V.shift_scale(
            self.getOrDefault("inputCol"),
            V.literal_array(self.getOrDefault("shift")), V.literal_array(self.getOrDefault("scale")),
        )

    def _transform(self, dataset):
        return dataset.withColumn(self.getOrDefault("outputCol"), array_to_vector(self._scaled()))

    def inverse(self, dataset, column="scaled", out="features"):
        return dataset.withColumn(out, V.unscale(
            column, V.literal_array(self.getOrDefault("shift")), V.literal_array(self.getOrDefault("scale"))
        ))
