"""Exact quantiles (linear interpolation) of groups of any size, by one path for every size.

Copies of a value collapse first, before any shuffle. The distinct values are range-partitioned by group and value,
so a hot group is spread over tasks, and counted up; a row whose count passes a wanted rank is that rank's value. The
number of passes depends neither on the rows nor on how the values are spread.
"""

from pyspark.sql import functions as F

from bandlore.operators.ordered import Ranged


def exact_quantiles(df, by, value, probs, extra=(), ranges=None):
    """One row per group: ``by`` columns, ``n``, ``q`` (the quantiles in the order given), ``extra`` aggregates.

    Rows with a missing value must be filtered out beforehand; ``by`` holds no nulls. ``ranges`` only sets the number
    of ranges, see ``Ranged``.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("x"))
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *extra)
    values = rows.groupBy(*by, "x").agg(F.count(F.lit(1)).alias("c"))
    counted = Ranged(values, by, [F.col("x")], ranges).running({"end": "c"})
    # 0-based ranks on both sides of every wanted place
    places = F.array(*[F.lit(float(p)) * (F.col("n") - 1) for p in probs])
    ranks = F.array_distinct(F.flatten(F.transform(places, lambda a: F.array(F.floor(a), F.ceil(a)))))
    wanted = groups.select(*by, ranks.alias("ranks"))
    here = F.filter("ranks", lambda r: (r < F.col("end")) & (r >= F.col("end") - F.col("c")))
    # one row per group; dealt by group, all values of a group would meet in one task
    at = counted.join(F.broadcast(wanted), by).withColumn("here", here).where(F.size("here") > 0)
    found = at.select(*by, "x", F.explode("here").alias("rank")).groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("at"))  # two ranks per quantile

    def between(a):
        low, high = F.try_element_at("at", F.floor(a)), F.try_element_at("at", F.ceil(a))
        return F.when(low == high, low).otherwise(low + (high - low) * (a - F.floor(a)))

    others = [c for c in groups.columns if c not in (*by, "n")]
    return groups.join(found, by).select(*by, "n", F.transform(places, between).alias("q"), *others)
