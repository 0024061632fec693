"""Mean-difference scorer: a closed-form linear classifier with a logistic link.

Weights are the differences of the class means, the centre is their midpoint, both from
the training rows. It has no random part, so its scores can be reproduced in plain SQL.
"""

from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.functions import vectors as V
from bandlore.operators.profile import class_contrast

SLOPE = 40.0


def fit_mean_difference(train):
    """One row holding the struct (centre, weight), arrays in band order."""
    terms = class_contrast(train).select(
        "band", ((F.col("mean_pos") + F.col("mean_neg")) / 2).alias("centre"),
        (F.col("mean_pos") - F.col("mean_neg")).alias("weight"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("band", "centre", "weight")))  # one entry per band
    return terms.agg(ordered.alias("s")).select(
        F.struct(F.col("s.centre").alias("centre"), F.col("s.weight").alias("weight")).alias("p")
    )


def margin(df, fitted, out="margin"):
    return df.withColumn("_p", fitted.scalar()).withColumn(
        out, V.dot(V.subtract("features", "_p.centre"), "_p.weight")
    ).drop("_p")


def score_mean_difference(df, fitted, slope=SLOPE, model="mean_difference"):
    """The scored relation: model, prob, and the scorer's own hard label."""
    out = margin(df, fitted).withColumn("prob", V.sigmoid(F.lit(slope) * F.col("margin")))
    return out.drop("margin").withColumn("model", F.lit(model)).withColumn(
        "pred_label", (F.col("prob") >= K.DEFAULT_TAU).cast("int")
    )


def score_zones(df, fitted, slope=SLOPE):
    """Long scored relation of four scorers: all bands, and each band zone alone."""
    zones = [("all", 1, K.N_BANDS)] + [(z.lower(), a, b) for z, a, b in K.ZONES]
    parts = F.zip_with(V.subtract("features", "_p.centre"), F.col("_p.weight"), lambda d, w: d * w)
    members = F.array(*[
        F.struct(
            F.lit(name).alias("model"),
            V.sigmoid(F.lit(slope) * V.total(F.slice("_t", a, b - a + 1))).alias("prob"),
        )
        for name, a, b in zones
    ])
    return (
        df.withColumn("_p", fitted.scalar()).withColumn("_t", parts)
        .withColumn("_m", F.explode(members)).select(*df.columns, "_m.model", "_m.prob")
        .withColumn("pred_label", (F.col("prob") >= K.DEFAULT_TAU).cast("int"))
    )


class MeanDifference:
    """The closed-form scorer as an estimator like the others; bands outside ``first`` to ``last`` weigh nothing."""

    def __init__(self, first=1, last=K.N_BANDS, slope=SLOPE):
        self.first, self.last, self.slope = first, last, slope

    def fit(self, train):
        p = fit_mean_difference(train).head()["p"]  # two numbers per band
        weight = [w if self.first <= band <= self.last else 0.0 for band, w in enumerate(p["weight"], 1)]
        return MeanDifferenceModel(p["centre"], weight, self.slope)


class MeanDifferenceModel:
    def __init__(self, centre, weight, slope=SLOPE):
        self.centre, self.weight, self.slope = list(centre), list(weight), slope

    def transform(self, df):
        """Adds prob and pred_label; a probability of one half counts as positive, as in ``score_mean_difference``."""
        m = V.dot(V.subtract("features", V.literal_array(self.centre)), V.literal_array(self.weight))
        return df.withColumn("prob", V.sigmoid(F.lit(float(self.slope)) * m)).withColumn(
            "pred_label", (F.col("prob") >= K.DEFAULT_TAU).cast("int"))

    def save(self, path):
        from pyspark.sql import SparkSession

        row = [(self.centre, self.weight, float(self.slope))]
        frame = SparkSession.getActiveSession().createDataFrame(
            row, "centre array<double>, weight array<double>, slope double")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{path}/linear")
        return path

    @staticmethod
    def load(spark, path):
        return MeanDifferenceModel(*spark.read.parquet(f"{path}/linear").head())
