"""Profiling of a signal table: audits, per-band statistics, plotted distributions."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.functions import scalar as S
from bandlore.operators.quantiles import exact_quantiles
from bandlore.sources.signals import bands, present_values


def _kinds(df):
    """Numbers of double and of text columns besides the id and the feature array, from the schema."""
    kinds = [kind for name, kind in df.dtypes if name not in ("id", "features")]
    return F.lit(kinds.count("double")), F.lit(kinds.count("string")), F.lit(len(kinds))


def dataset_summary(df, width=None):
    """Shape, column kinds and the global range, mean and population sd of all values.

    Every row counts, with a null or short array too. The number of features is ``width`` or that of the longest row.
    """
    values = F.filter("features", lambda x: ~S.missing(x))
    count, total = F.coalesce(F.size(values), F.lit(0)), F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    rows = df.select(
        F.greatest(F.size("features"), F.lit(0)).alias("w"), F.array_min(values).alias("lo"), F.array_max(values).alias("hi"),
        F.greatest(count, F.lit(0)).alias("n"), total.alias("s"), values.alias("v"))
    centre = rows.agg((F.sum("s") / F.sum("n")).alias("m")).scalar()
    spread = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x - F.col("m")) * (x - F.col("m")))
    features = F.max("w") if width is None else F.lit(width)
    doubles, texts, others = _kinds(df)
    return rows.withColumn("m", centre).agg(
        F.count(F.lit(1)).alias("num_rows"), F.coalesce(features, F.lit(0)).cast("bigint").alias("num_features"),
        F.min("lo").alias("global_min"), F.max("hi").alias("global_max"), F.first("m").alias("global_mean"),
        F.sqrt(F.sum(spread) / F.sum("n")).alias("global_std"),
    ).select(
        "num_rows", (F.col("num_features") + others).cast("bigint").alias("num_cols"), "num_features",
        (F.col("num_features") + doubles).cast("bigint").alias("double_cols"), texts.cast("bigint").alias("string_cols"),
        "global_min", "global_max", "global_mean", "global_std",
    )


def missing_audit(df, width=None):
    """Missing values per column, their total and whether there are any.

    Places that a row lacks against ``width``, or against the longest row, are missing too.
    """
    shape = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.max(F.size("features")), F.lit(0)).alias("longest"))
    places = F.greatest(F.col("longest") if width is None else F.lit(width), F.lit(0))
    every = shape.select("rows", F.explode(F.when(places > 0, F.sequence(F.lit(1), places))).alias("band"))
    # Only values that are there are exploded; a long row adds its own places and none to the others.
    present = present_values(bands(df.select("features"))).groupBy("band").agg(F.count(F.lit(1)).alias("present"))
    per_band = every.join(present, "band", "left").select(
        F.concat(F.lit("freq_"), F.col("band").cast("string")).alias("column_name"),
        (F.col("rows") - F.coalesce("present", F.lit(0))).alias("missing"))
    label = df.agg(F.count_if(F.col("label").isNull()).alias("missing")).select(
        F.lit("label").alias("column_name"), "missing"
    )
    total = F.sum("missing").over(Window.partitionBy(F.lit(0)))  # width + 1 rows
    return per_band.unionByName(label).select(
        "column_name", "missing", total.alias("total_missing"), (total > 0).alias("has_missing")
    )


def _fingerprint():
    """SHA-256 over all values and the label: equal for equal rows, and only for those.

    Doubles print uniquely; adding 0 makes -0 and 0 the same value, as in a comparison.
    """
    values = F.transform("features", lambda x: F.coalesce((x + F.lit(0.0)).cast("string"), F.lit("null")))
    label = F.when(F.col("label").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("label")))
    return F.unhex(F.sha2(F.concat_ws(",", F.concat_ws(",", values), label), 256))


def duplicate_rows(df):
    """Ids of rows that repeat an earlier row (lower id) in every value and the label.

    Rows are compared by a 32-byte fingerprint, so the wide arrays are never shuffled. Copies
    collapse on the map side, and the only join is on the unique id: no key is ever hot.
    """
    keyed = df.select("id", _fingerprint().alias("f"))
    kept = keyed.groupBy("f").agg(F.min("id").alias("id")).select("id")
    return df.select("id").join(kept, "id", "left_anti")


def duplicate_audit(df):
    """Rows less distinct rows: one aggregation over fingerprints, no join."""
    copies = df.select(_fingerprint().alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("num_duplicates")).select(
        "num_duplicates", (F.col("num_duplicates") > 0).alias("has_duplicates")
    )


def class_distribution(df, label="label"):
    """Count, share, majority/minority ratio and balance flag; null labels are not a class."""
    if label not in df.columns:
        raise KeyError(f"target column {label!r} not found")
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("count")
    )
    every = Window.partitionBy(F.lit(0))  # one row per class
    ratio = F.round(F.max("count").over(every) / F.min("count").over(every), 2)
    return counts.select(
        "label", "count",
        F.round(F.col("count") * 100.0 / F.sum("count").over(every), 2).alias("pct"),
        F.sum("count").over(every).alias("total_records"),
        ratio.alias("imbalance_ratio"), (ratio < K.BALANCED_BELOW).alias("is_balanced"),
        S.class_category("label").alias("category"),
    )


def describe_bands(df, ranges=None):
    """Count, mean, sample sd, min, quartiles and max per band."""
    long = present_values(bands(df.select("features")))
    moments = [
        F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"),
    ]
    return exact_quantiles(long, ["band"], "x", [0.25, 0.5, 0.75], moments, ranges).select(
        "band", F.col("n").alias("count"), "mean", "std", "min",
        F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max",
    )


def band_variance(df):
    return present_values(bands(df.select("features"))).groupBy("band").agg(
        F.var_samp("x").alias("variance")
    )


def variance_extremes(df, k=5):
    """The k most and the k least variable bands, both listed from high to low."""
    var = band_variance(df)
    place = F.row_number()
    high = place.over(Window.partitionBy(F.lit(0)).orderBy(F.desc("variance"), "band"))
    low = place.over(Window.partitionBy(F.lit(0)).orderBy("variance", F.desc("band")))
    ranked = var.select("band", "variance", high.alias("rank"), low.alias("low"))  # one row per band
    return ranked.where((F.col("rank") <= k) | (F.col("low") <= k)).select(
        F.when(F.col("rank") <= k, "top").otherwise("lowest").alias("side"),
        "rank", "band", "variance",
    )


def class_stats(df):
    """Mean and sample sd per (band, class)."""
    return present_values(bands(df.select("features", "label"))).groupBy("band", "label").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std")
    )


def class_contrast(df, positive=K.POSITIVE, negative=K.NEGATIVE):
    """Class means side by side and their absolute difference, per band."""
    long = present_values(bands(df.select("features", "label")))
    return long.groupBy("band").agg(
        F.avg(F.when(F.col("label") == positive, F.col("x"))).alias("mean_pos"),
        F.avg(F.when(F.col("label") == negative, F.col("x"))).alias("mean_neg"),
    ).withColumn("diff", F.abs(F.col("mean_pos") - F.col("mean_neg")))


def top_contrast(df, k=5, positive=K.POSITIVE, negative=K.NEGATIVE):
    return class_contrast(df, positive, negative).orderBy(F.desc("diff"), "band").limit(k)


def mean_signature(df, width=0.5):
    """Class mean per band with an envelope of ``width`` sample sds."""
    return class_stats(df).select(
        "band", "label", "mean",
        (F.col("mean") - width * F.col("std")).alias("lower"),
        (F.col("mean") + width * F.col("std")).alias("upper"),
    )


def reference_profiles(df, digits=4):
    """One row per class: the mean spectrum in band order, rounded."""
    ordered = F.array_sort(F.collect_list(F.struct("band", F.round("mean", digits).alias("m"))))
    return class_stats(df).groupBy("label").agg(  # one value per band
        F.transform(ordered, lambda s: s["m"]).alias("profile")
    )


def _chosen(df, wanted):
    """Long rows of the listed bands only, picked from the array before the explode."""
    pick = F.array(*[
        F.struct(F.lit(b).alias("band"), F.get("features", F.lit(b - 1)).alias("x")) for b in wanted
    ])
    return present_values(df.select("label", F.explode(pick).alias("s")).select("label", "s.*"))


def class_histogram(df, wanted=None, bins=K.HISTOGRAM_BINS):
    """Density per class on shared equal-width bins; every class integrates to 1 by itself."""
    wanted = wanted or K.HISTOGRAM_BANDS
    long = _chosen(df, wanted)
    ranges = long.groupBy("band").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).select(
        "band", "lo", ((F.col("hi") - F.col("lo")) / bins).alias("w")
    )
    binned = long.join(F.broadcast(ranges), "band").select(  # one row per band
        "band", "label", "lo", "w",
        F.when(F.col("w") > 0, F.least(F.floor((F.col("x") - F.col("lo")) / F.col("w")), F.lit(bins - 1)))
        .otherwise(F.lit(0)).alias("bin"),
    )
    counts = binned.groupBy("band", "label", "lo", "w", "bin").agg(F.count(F.lit(1)).alias("count"))
    in_class = F.sum("count").over(Window.partitionBy("band", "label"))  # at most ``bins`` rows
    return counts.select(
        "band", "label", F.col("bin").cast("bigint").alias("bin"),
        (F.col("lo") + F.col("bin") * F.col("w")).alias("left_edge"), "count",
        F.try_divide(F.col("count"), in_class * F.col("w")).alias("density"),
    )


#: Terms of the expansion of a kernel around the middle of its cell, cells per bandwidth, and bandwidths beyond which a
#: kernel adds nothing. Offsets are a quarter of a bandwidth at most, so what is left out is below 1e-11 of a kernel.
KERNEL_TERMS, CELLS, REACH = 12, 2, 8.5


def _hermite(terms):
    """Coefficients of the polynomials He_0, He_1, .. by rising power."""
    out = [[1.0], [0.0, 1.0]]
    for j in range(1, terms - 1):
        up, back = [0.0, *out[j]], [*out[j - 1], 0.0, 0.0]
        out.append([u - j * b for u, b in zip(up, back)])
    return out[:terms]


def class_density(df, wanted=None, points=K.KDE_GRID):
    """Gaussian kernel density per class on a shared grid over the range of the data.

    Bandwidth is sample sd times n^(-1/5); a class without spread has no curve. A fast Gauss transform (Greengard and
    Strain 1991): rows are summed once into the moments of small cells, and each cell adds a polynomial times its kernel to
    the grid points near it. So the work on a row does not depend on the number of points.
    """
    wanted = wanted or K.HISTOGRAM_BANDS
    long = _chosen(df, wanted).where(F.col("label").isNotNull())
    by = ["band", "label"]
    stats = long.groupBy(*by).agg(
        F.count("x").alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    span = stats.groupBy("band").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    scale = stats.where("sd > 0").select(
        *by, "n", (F.col("sd") * F.pow(F.col("n"), F.lit(-0.2))).alias("h")).join(span, "band").withColumn(
        "step", (F.col("hi") - F.col("lo")) / (points - 1))
    middle = F.col("lo") + (F.col("cell") + 0.5) * F.col("h") / CELLS
    placed = long.join(F.broadcast(scale), by).withColumn("cell", F.floor((F.col("x") - F.col("lo")) / F.col("h") * CELLS))
    offset = placed.select(*by, "cell", ((F.col("x") - middle) / F.col("h")).alias("z"))
    power, moments = F.lit(1.0), []
    for j in range(KERNEL_TERMS):
        moments.append(F.sum(power).alias(f"m{j}"))
        power = power * F.col("z") / (j + 1)
    cells = offset.groupBy(*by, "cell").agg(*moments).join(scale, by).withColumn("c", middle)
    rows = _hermite(KERNEL_TERMS)
    factors = [sum((F.col(f"m{j}") * row[k] for j, row in enumerate(rows) if k < len(row) and row[k]), F.lit(0.0))
               for k in range(KERNEL_TERMS)]
    first, last = (F.greatest(F.lit(0), F.least(F.lit(points - 1), f((F.col("c") + side * REACH * F.col("h") - F.col("lo"))
                                                                   / F.col("step")))).cast("bigint")
                   for f, side in ((F.floor, -1), (F.ceil, 1)))
    near = cells.select(*by, "lo", "step", "h", "c", F.array(*factors).alias("a"), F.explode(F.sequence(first, last)).alias("point"))
    near = near.withColumn("u", (F.col("lo") + F.col("point") * F.col("step") - F.col("c")) / F.col("h"))
    total = F.lit(0.0)
    for k in reversed(range(KERNEL_TERMS)):
        total = total * F.col("u") + F.get("a", F.lit(k))
    value = total * F.exp(-0.5 * F.col("u") * F.col("u"))
    sums = near.groupBy(*by, "point").agg(F.sum(value).alias("s"))
    grid = scale.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)).cast("array<bigint>")))
    found = grid.join(sums, [*by, "point"], "left")
    return found.select(
        *by, "point", (F.col("lo") + F.col("point") * F.col("step")).alias("value"),
        (F.greatest(F.coalesce("s", F.lit(0.0)), F.lit(0.0)) / (F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"),
    )


def _fences(long, ranges):
    boxes = exact_quantiles(long, ["band", "label"], "x", [0.25, 0.5, 0.75], (), ranges)
    iqr = F.col("q")[2] - F.col("q")[0]
    return boxes.select(
        "band", "label", F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q75"),
        (F.col("q")[0] - 1.5 * iqr).alias("fence_lo"), (F.col("q")[2] + 1.5 * iqr).alias("fence_hi"),
    )


def box_stats(df, wanted=None, ranges=None):
    """Quartiles, whiskers at the last datum within 1.5 IQR and the number of outliers."""
    long = _chosen(df, wanted or K.BOX_BANDS)
    fences = _fences(long, ranges)  # one row per (band, class)
    inside = F.col("x").between(F.col("fence_lo"), F.col("fence_hi"))
    return long.join(F.broadcast(fences), ["band", "label"]).groupBy(
        "band", "label", "q25", "median", "q75"
    ).agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_hi"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(df, wanted=None, ranges=None):
    """The values outside the fences, with the fence they cross."""
    long = _chosen(df, wanted or K.BOX_BANDS)
    fences = _fences(long, ranges)
    return long.join(F.broadcast(fences), ["band", "label"]).where(
        ~F.col("x").between(F.col("fence_lo"), F.col("fence_hi"))
    ).select("band", "label", "x", F.when(F.col("x") > F.col("median"), "high").otherwise("low").alias("side"))


def correlation_matrix(df, wanted=None):
    """Pearson correlation of the listed bands, long form.

    Each pair uses the rows that hold both: every task adds up masked products of its row blocks as small matrices
    (bands x bands), and only those are shuffled.
    """
    wanted = wanted or K.CORRELATION_BANDS
    chosen = df.select(F.array(*[F.get("features", F.lit(b - 1)) for b in wanted]).alias("v"))
    centre = {r["pos"]: r["m"] for r in chosen.select(F.posexplode("v").alias("pos", "x")).where(
        ~S.missing("x")).groupBy("pos").agg(F.avg("x").alias("m")).collect()}  # one value per band
    shift = np.array([centre.get(i, 0.0) for i in range(len(wanted))])
    a, b = (m.ravel() for m in np.meshgrid(wanted, wanted, indexing="ij"))

    def products(batches):
        sums = None
        for pdf in batches:
            x = np.stack(pdf["v"].to_numpy()).astype(float) - shift
            held = ~np.isnan(x)
            x, mask = np.where(held, x, 0.0), held.astype(float)
            part = np.stack([mask.T @ mask, x.T @ mask, mask.T @ x, (x * x).T @ mask, mask.T @ (x * x), x.T @ x])
            sums = part if sums is None else sums + part
        if sums is not None:
            n, sa, sb, saa, sbb, sab = (m.ravel() for m in sums)
            yield pd.DataFrame({"band_a": a, "band_b": b, "n": n, "sa": sa, "sb": sb, "saa": saa, "sbb": sbb, "sab": sab})

    parts = chosen.mapInPandas(
        products, "band_a int, band_b int, n double, sa double, sb double, saa double, sbb double, sab double")
    c = parts.groupBy("band_a", "band_b").agg(*[F.sum(k).alias(k) for k in ("n", "sa", "sb", "saa", "sbb", "sab")])
    cov = F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")
    spread_a = F.col("saa") - F.col("sa") * F.col("sa") / F.col("n")
    spread_b = F.col("sbb") - F.col("sb") * F.col("sb") / F.col("n")
    return c.where("n > 0").select(
        "band_a", "band_b", F.try_divide(cov, F.sqrt(spread_a * spread_b)).alias("corr"))


def first_of_class(df):
    """The row with the lowest id of every class; only ids are aggregated."""
    first = df.groupBy("label").agg(F.min("id").alias("id"))
    return df.join(first, ["label", "id"]).select("label", "features", "id")


def head_preview(df, rows=5, lead=5, tail=3, width=K.N_BANDS):
    """First rows by id with the first and last few columns."""
    shown = [*range(lead), *range(width + 1 - tail, width)]
    return df.orderBy("id").limit(rows).select(
        "id", *[F.col("features")[i].alias(f"freq_{i + 1}") for i in shown], "label"
    )


def unknown_labels(df, known=None):
    """Observed labels that the mapping does not know."""
    known = list(known or K.LABEL_MAPPING)
    return df.select("label").distinct().where(F.col("label").isNull() | ~F.col("label").isin(known))


def label_domain_check(df, known=None):
    """Whether the observed label set equals the known one."""
    known = sorted(known or K.LABEL_MAPPING)
    seen = df.select("label").distinct()
    flags = seen.agg(
        F.count_if(F.col("label").isin(known)).alias("matched"),
        F.count_if(F.col("label").isNull() | ~F.col("label").isin(known)).alias("unexpected"),
    )
    return flags.select(
        (F.lit(len(known)) - F.col("matched")).cast("bigint").alias("absent"), "unexpected",
        ((F.col("matched") == len(known)) & (F.col("unexpected") == 0)).alias("equal"),
    )


def raw_table_check(df, width=K.N_BANDS):
    """Rows, columns, malformed rows and class counts in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("num_rows"),
        (F.coalesce(F.max(F.size("features")), F.lit(0)) + _kinds(df)[2]).cast("bigint").alias("num_cols"),
        F.count_if(F.coalesce(F.size("features"), F.lit(-1)) != width).alias("bad_width"),
        F.count_if(F.col("label") == K.POSITIVE).alias("positives"),
        F.count_if(F.col("label") == K.NEGATIVE).alias("negatives"),
    )
