"""Seeded exact splits, folds and prefixes without sorting or shuffling the table.

Rows are ordered by md5(seed:id). Taking the first q rows of a class needs only the q-th
key, not a full ranking: counts per leading hash digits show which short hash range holds
it, and just that range (1/65536 of the class) is ranked. The cut keys are a few values
per class; they are looked up once, by jobs over narrow columns, and every row is then
labelled by a comparison in its own task. The result is as stable as a written column.
"""

import math
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

DIGITS = 4
MAX_STRATA = 1000


def order_key(seed, id_col="id"):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def class_counts(df, stratum):
    """Rows per class, as a small dictionary in class order."""
    rows = df.where(F.col(stratum).isNotNull()).groupBy(stratum).agg(F.count(F.lit(1)).alias("c"))
    found = rows.limit(MAX_STRATA + 1).collect()
    if len(found) > MAX_STRATA:
        raise ValueError(f"{stratum!r} has more than {MAX_STRATA} values; it is not a class column")
    return {r[stratum]: r["c"] for r in sorted(found, key=lambda r: r[stratum])}


def rank_cuts(df, stratum, key, ends):
    """Keys at given ranks: {class: [(key, id) or None for an empty part, ...]}.

    ``ends`` maps each class to the ranks at which its parts end, in rising order.
    """
    spark = df.sparkSession
    asked = [(c, i, int(e)) for c, upto in ends.items() for i, e in enumerate(upto) if e > 0]
    cuts = {c: [None] * len(upto) for c, upto in ends.items()}
    if not asked:
        return cuts
    kind = dict(df.dtypes)[stratum]
    keyed = df.where(F.col(stratum).isNotNull()).select(F.col(stratum).alias("s"), "id", key.alias("k"))
    keyed = keyed.withColumn("slot", F.substring("k", 1, DIGITS))
    slots = keyed.groupBy("s", "slot").agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy("s").orderBy("slot")  # at most 16^DIGITS rows per class
    spans = slots.select("s", "slot", (F.sum("c").over(upto) - F.col("c")).alias("a"), F.sum("c").over(upto).alias("b"))
    quotas = F.broadcast(spark.createDataFrame(asked, f"s {kind}, part int, e bigint"))  # classes x parts rows
    wanted = spans.join(quotas, "s").where("e > a AND e <= b").select("s", "slot", "part", (F.col("e") - F.col("a")).alias("rn"))
    slot_rows = [tuple(r) for r in wanted.collect()]
    # few rows again, now as constants
    places = F.broadcast(spark.createDataFrame(slot_rows, f"s {kind}, slot string, part int, rn bigint"))
    hit = keyed.join(places.select("s", "slot").distinct(), ["s", "slot"], "left_semi")
    ranked = hit.withColumn("rn", F.row_number().over(Window.partitionBy("s", "slot").orderBy("k", "id")).cast("bigint"))
    for r in ranked.join(places, ["s", "slot", "rn"]).select("s", "part", "k", "id").collect():
        cuts[r["s"]][r["part"]] = (r["k"], r["id"])
    return cuts


def part_of(stratum, key, cuts):
    """Column: how many cuts of its class a row lies beyond; null for a null class."""
    def beyond(cut):
        if cut is None:
            return F.lit(1)
        after = (key > cut[0]) | ((key == cut[0]) & (F.col("id") > F.lit(cut[1])))
        return F.when(after, 1).otherwise(0)

    part = F.lit(None).cast("int")
    for value, listed in cuts.items():
        steps = reduce(lambda a, b: a + b, (beyond(c) for c in listed), F.lit(0))
        part = F.when(F.col(stratum) == F.lit(value), steps).otherwise(part)
    return part


def _train_quotas(counts, test_size):
    """Training rows per class by largest remainder, out of n - ceil(test_size * n)."""
    n = sum(counts.values())
    train = n - math.ceil(test_size * n)
    shares = {c: train * k / n for c, k in counts.items()}
    quotas = {c: math.floor(s) for c, s in shares.items()}
    by_rest = sorted(shares, key=lambda c: -(shares[c] - quotas[c]))  # classes stay in order on ties
    for c in by_rest[: train - sum(quotas.values())]:
        quotas[c] += 1
    return quotas


def split_rows(df, test_size=0.2, seed=42, stratify=True, label="label"):
    """Add ``split`` ('train' / 'test'), exact in size and, if stratified, in class shares."""
    rows = df if stratify else df.withColumn("_all", F.lit(0))
    stratum = label if stratify else "_all"
    quotas = _train_quotas(class_counts(rows, stratum), test_size)
    cuts = rank_cuts(rows, stratum, order_key(seed), {c: [q] for c, q in quotas.items()})
    part = part_of(stratum, F.col("_key"), cuts)
    keyed = rows.withColumn("_key", order_key(seed)).withColumn("_part", part)
    split = F.when(F.col("_part") == 0, "train").when(F.col("_part") == 1, "test")
    return keyed.select(*df.columns, split.alias("split"))


def split_rows_approx(df, test_size=0.2, seed=42):
    """Row-local split: sizes are right in expectation, nothing is counted or moved."""
    u = F.conv(F.substring(order_key(seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return df.withColumn("split", F.when(u < test_size, "test").otherwise("train"))


def _fold_ends(counts, k):
    """Ranks at which the folds of each class end, all but the last.

    Fold i holds as many rows of a class as dealing the class-sorted rows round robin gives it.
    """
    def dealt(x, i):
        return (x + k - 1 - i) // k

    ends, start = {}, 0
    for c, n in counts.items():
        sizes = [dealt(start + n, i) - dealt(start, i) for i in range(k)]
        ends[c] = [sum(sizes[: i + 1]) for i in range(k - 1)]
        start += n
    return ends


def stratified_folds(df, k=5, seed=42, label="y"):
    """Add ``fold`` in 0..k-1, balanced per class and in total."""
    cuts = rank_cuts(df, label, order_key(seed), _fold_ends(class_counts(df, label), k))
    keyed = df.withColumn("_key", order_key(seed)).withColumn("fold", part_of(label, F.col("_key"), cuts))
    return keyed.drop("_key")


def learning_prefixes(df, fractions=(0.2, 0.4, 0.6, 0.8, 1.0), k=5, seed=43):
    """Training rows of every held-out fold with the smallest prefix they belong to.

    Adds ``held`` (the fold left out) and ``step`` (0-based index of the first fraction
    whose prefix holds the row). Sizes are fractions of the first fold's training rows,
    the same for every fold; rows beyond the last prefix get step = len(fractions).
    """
    others = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: f != F.col("fold"))
    sizes = class_counts(df, "fold")
    first = sum(n for f, n in sizes.items() if f != 0)
    ends = {f: [math.floor(x * first) for x in fractions] for f in range(k)}
    copies = df.withColumn("held", F.explode(others))
    cuts = rank_cuts(copies, "held", order_key(seed), ends)
    keyed = copies.withColumn("_key", order_key(seed)).withColumn("step", part_of("held", F.col("_key"), cuts))
    return keyed.drop("_key")


def split_audit(df, label="label", tolerance_pct=1.0):
    """Size and class share per split, drift from the whole table and whether it is in tolerance."""
    cells = df.groupBy("split", label).agg(F.count(F.lit(1)).alias("rows"))
    by_split = Window.partitionBy("split")  # cells only: splits x classes
    by_class, every = Window.partitionBy(label), Window.partitionBy(F.lit(0))
    pct = F.col("rows") * 100.0 / F.sum("rows").over(by_split)
    whole = F.sum("rows").over(by_class) * 100.0 / F.sum("rows").over(every)
    return cells.select(
        "split", label, "rows", F.sum("rows").over(by_split).alias("split_rows"),
        pct.alias("pct"), whole.alias("pct_full"), F.abs(pct - whole).alias("drift"),
        (F.abs(pct - whole) <= tolerance_pct).alias("within_tolerance"),
    )


def split_metadata(df, scaler="StandardScaler", label="y", width=60):
    """One row: sizes, feature names, scaler and class counts per split."""
    def size(split):
        return F.count_if(F.col("split") == split)

    def classes(split):
        return F.struct(*[
            F.count_if((F.col("split") == split) & (F.col(label) == v)).alias(str(v)) for v in (1, 0)
        ])

    return df.agg(
        size("train").alias("train_samples"), size("test").alias("test_samples"),
        F.count(F.lit(1)).alias("total_samples"), F.lit(width).alias("n_features"),
        F.array(*[F.lit(f"freq_{i + 1}") for i in range(width)]).alias("feature_names"),
        F.lit(scaler).alias("scaler_type"),
        F.struct(F.lit(1).alias("M"), F.lit(0).alias("R")).alias("label_mapping"),
        classes("train").alias("train_class_distribution"),
        classes("test").alias("test_class_distribution"),
    )
