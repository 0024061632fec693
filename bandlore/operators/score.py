"""Scoring of batches and single signals, from a fitted model or stored probabilities."""

from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.functions import scalar as S
from bandlore.operators import evaluate as E
from bandlore.operators.models import with_scores


def decide(df, tau):
    """Per-row decision at a threshold: class, confidence, threat level, margin.

    Works on stored probabilities, so another threshold needs no rescoring.
    """
    level = S.threat_level("prob", tau)
    return df.select(
        "*", S.is_threat("prob", tau).alias("is_threat"), S.classification("prob", tau).alias("classification"),
        F.col("prob").alias("probability_mine"), S.complement("prob").alias("probability_rock"),
        S.tau_column(tau).alias("applied_threshold"),
        S.confidence_percent("prob", tau).alias("confidence_percent"),
        S.signed_margin("prob", tau).alias("margin"), level.alias("threat"),
    )


def batch_columns(df, tau):
    """Batch output columns: both probabilities and the predicted class."""
    return df.withColumn("Probability_Mine", F.col("prob")).withColumn(
        "Probability_Rock", S.complement("prob")
    ).withColumn("Prediction", S.batch_class("prob", tau))


def score_batch(model, df, tau=K.DEFAULT_TAU):
    """(scored rows, summary row) of a batch under a fitted model."""
    tau = S.check_tau(tau)
    scored = with_scores(model, df)
    return batch_columns(scored, tau), E.batch_summary(scored, tau)


def batch_preview(scored, tau, rows=50):
    """The first rows of a batch by id, numbered from 1."""
    top = scored.orderBy("id").limit(rows)
    numbered = top.agg(F.array_sort(F.collect_list(F.struct("id", "prob"))).alias("r")).select(  # ``rows`` entries
        F.posexplode("r").alias("pos", "s")
    )
    p = F.col("s.prob")
    return numbered.select(
        (F.col("pos") + 1).alias("signal_index"), F.round(p, 4).alias("probability_mine"),
        F.round(1.0 - p, 4).alias("probability_rock"), S.batch_class(p, tau).alias("classification"),
        S.is_threat(p, tau).alias("is_threat"),
    )
