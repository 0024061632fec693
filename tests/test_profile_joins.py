"""Joins of rows with one row per band or class never deal the rows by band or class."""

import pytest
from pyspark.sql import functions as F

from bandlore.operators import profile as P
from bandlore.operators.quantiles import exact_quantiles


@pytest.fixture
def unhinted(spark):
    """Spark may not choose a broadcast by size, as on tables whose size it cannot tell."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_histogram_and_density(unhinted, signals):
    assert "SortMergeJoin" not in _plan(P.class_histogram(signals))
    assert "BroadcastHashJoin" in _plan(P.class_density(signals))
    counts = P.class_histogram(signals, [10]).groupBy("band").agg(F.sum("count").alias("n")).head()
    assert counts.n == signals.count()


def test_boxes_and_quantiles(unhinted, signals):
    """Only tables of one row per group are merged: the quantiles with their groups."""
    quantiles = _plan(exact_quantiles(signals.select("label", F.col("features")[0].alias("x")), ["label"], "x", [0.5]))
    boxes, outliers = _plan(P.box_stats(signals)), _plan(P.box_outliers(signals))
    assert quantiles.count("SortMergeJoin") == boxes.count("SortMergeJoin") == outliers.count("SortMergeJoin") == 1
