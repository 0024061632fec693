"""Permutation importance, Shapley attribution, and the reports drawn from them."""

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.functions import scalar as S
from bandlore.functions import vectors as V
from bandlore.operators import evaluate as E
from bandlore.operators import models as M
from bandlore.operators.ordered import Ranged
from bandlore.operators.sampling import order_key
from bandlore.session import stable

#: Rows that one task permutes together. The permutation itself spans the table; this only cuts the work.
BLOCK_ROWS = 4_096


def shift_of(repeat, rows):
    """Cyclic shift of the hash order of a table by a repeat (1-based).

    Never the identity for two rows or more, and no shift comes twice while the rows allow it.
    """
    return 1 + (repeat - 1) % (rows - 1) if rows > 1 else 0


def _in_blocks(df, seed, repeats, block_rows=BLOCK_ROWS):
    """The rows in hash order, dealt to blocks: ``_block``, ``_pos`` (place in the whole table), and the number of rows.

    The donor of a row is the one ``shift`` places further on. So each block also gets the first rows of the next one,
    the last block those of the first, marked ``_lent``.
    """
    block_rows = max(block_rows, repeats)
    keyed = df.withColumn("_key", order_key(seed))
    placed = Ranged(keyed, [], [F.col("_key"), F.col("id")]).positions("_pos").drop("_key")
    rows = placed.count()
    blocks = max(1, rows // block_rows)
    size = max(1, rows // blocks)
    block = F.least(F.floor(F.col("_pos") / size), F.lit(blocks - 1))
    own = placed.withColumn("_block", block.cast("bigint")).withColumn("_lent", F.lit(False))
    if blocks == 1:
        return own, rows
    lent = own.where(F.col("_pos") - F.col("_block") * size < repeats).withColumn("_lent", F.lit(True)).withColumn(
        "_pos", F.when(F.col("_block") == 0, F.col("_pos") + rows).otherwise(F.col("_pos"))).withColumn(
        "_block", F.pmod(F.col("_block") - 1, F.lit(blocks)))
    return own.unionByName(lent), rows


def _donor(pdf, repeat, rows):
    """For the own rows of a block in order the index of the donor among all its rows."""
    own = int((~pdf["_lent"]).sum())
    at = np.arange(own) + shift_of(repeat, rows)
    return at % rows if own == rows else at


def linear_permutation_importance(df, fitted, n_repeats=15, seed=42, block_rows=BLOCK_ROWS, cut=0.0):
    """F1 drop of the mean-difference scorer when one band takes another row's value.

    Rows stand in random (hash) order and a repeat shifts that order, which is a bijection of the whole table. Only
    one term of the margin changes per band, so each block updates its margins in place and hands on four counts per
    (band, repeat).
    """
    from bandlore.operators.linear import margin

    scored = margin(df.select("id", "features", "y"), fitted)
    weights = fitted.select(F.col("p.weight").alias("w")).head()["w"]  # one value per band
    w = np.array(weights, dtype=float)
    blocked, rows = _in_blocks(scored, seed, n_repeats, block_rows)

    def counts(pdf):
        pdf = pdf.sort_values("_pos").reset_index(drop=True)
        every = np.stack(pdf["features"].to_numpy()).astype(float)
        own = ~pdf["_lent"].to_numpy()
        x, base, y = every[own], pdf["margin"].to_numpy()[own], pdf["y"].to_numpy()[own] == 1
        out = []
        for r in range(0, n_repeats + 1):
            donor = every[_donor(pdf, r, rows)] if r else x
            hit = (base[:, None] + (donor - x) * w) >= cut
            out.append(pd.DataFrame({
                "repeat": r, "band": np.arange(1, x.shape[1] + 1),
                "tp": (hit & y[:, None]).sum(0), "fp": (hit & ~y[:, None]).sum(0),
                "tn": (~hit & ~y[:, None]).sum(0), "fn": (~hit & y[:, None]).sum(0),
            }))
        return pd.concat(out)

    cells = blocked.groupBy("_block").applyInPandas(
        counts, "repeat int, band int, tp bigint, fp bigint, tn bigint, fn bigint"
    )
    return _drops(cells)


def _drops(cells):
    """Mean and population sd of the F1 drop per band; repeat 0 is the unchanged table."""
    whole = cells.groupBy("band", "repeat").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "tn", "fn")])
    f1 = E.with_metrics(whole).select("band", "repeat", "f1")
    base = F.max(F.when(F.col("repeat") == 0, F.col("f1")))
    drops = f1.groupBy("band").agg(
        base.alias("base"), F.avg(F.when(F.col("repeat") > 0, F.col("f1"))).alias("m"),
        F.stddev_pop(F.when(F.col("repeat") > 0, F.col("f1"))).alias("std_importance"),
    )
    return drops.select("band", (F.col("base") - F.col("m")).alias("mean_importance"), "std_importance")


def permuted_pairs(df, n_repeats=15, seed=42, block_rows=BLOCK_ROWS):
    """Every row with its donor row per repeat: (id, y, repeat, features, donor)."""
    blocked, rows = _in_blocks(df.select("id", "y", "features"), seed, n_repeats, block_rows)

    def pairs(pdf):
        pdf = pdf.sort_values("_pos").reset_index(drop=True)
        own, parts = pdf[~pdf["_lent"]][["id", "y", "features"]], []
        for r in range(1, n_repeats + 1):
            parts.append(own.assign(repeat=r, donor=pdf["features"].to_numpy()[_donor(pdf, r, rows)]))
        return pd.concat(parts)

    return blocked.groupBy("_block").applyInPandas(
        pairs, "id bigint, y int, features array<double>, repeat int, donor array<double>"
    )


def _block_cells(score, df, n_repeats, seed, block_rows, width):
    """Counts per (band, repeat) of a batch scorer; repeat 0 is the unchanged table."""
    blocked, rows = _in_blocks(df.select("id", "y", "features"), seed, n_repeats, block_rows)

    def counts(pdf):
        pdf = pdf.sort_values("_pos").reset_index(drop=True)
        every = np.stack(pdf["features"].to_numpy()).astype(float)
        own = ~pdf["_lent"].to_numpy()
        x, y, out = every[own], pdf["y"].to_numpy()[own] == 1, []
        margin = x @ score.weights + score.intercept
        for r in range(n_repeats + 1):
            donor = every[_donor(pdf, r, rows)] if r else x
            hit = score.of_margin(margin[:, None] + (donor - x) * score.weights)[1]
            out.append(pd.DataFrame({
                "repeat": r, "band": np.arange(1, width + 1),
                "tp": (hit & y[:, None]).sum(0), "fp": (hit & ~y[:, None]).sum(0),
                "tn": (~hit & ~y[:, None]).sum(0), "fn": (~hit & y[:, None]).sum(0)}))
        return pd.concat(out)

    return blocked.groupBy("_block").applyInPandas(
        counts, "repeat int, band int, tp bigint, fp bigint, tn bigint, fn bigint")


def permutation_importance(model, df, n_repeats=15, seed=42, block_rows=BLOCK_ROWS, width=K.N_BANDS):
    """F1 drop of any fitted model. ``features`` must hold the model's scaled input.

    A model with a batch scorer is applied inside the blocks, which hand on four counts per (band, repeat). Any other
    scores rows x bands x repeats vectors as one stream; only counts are shuffled.
    """
    score = M.batch_scorer(model)
    if score:
        return _drops(_block_cells(score, df, n_repeats, seed, block_rows, width))
    pairs = permuted_pairs(df, n_repeats, seed, block_rows)
    swapped = pairs.withColumn("band", F.explode(F.sequence(F.lit(1), F.lit(width)))).select(
        "id", "y", "repeat", "band",
        F.zip_with(
            F.zip_with("features", "donor", lambda x, d: F.struct(x.alias("x"), d.alias("d"))),
            F.sequence(F.lit(1), F.lit(width)),
            lambda p, i: F.when(i == F.col("band"), p["d"]).otherwise(p["x"]),
        ).alias("features"),
    )
    same = df.select("id", "y", F.lit(0).alias("repeat"), F.lit(0).alias("band"), "features")

    def cells(rows):
        vec = rows.withColumn("scaled", array_to_vector("features"))
        return E.confusion(M.with_scores(model, vec), ["band", "repeat"])

    base = cells(same).withColumn("band", F.explode(F.sequence(F.lit(1), F.lit(width))))
    return _drops(cells(swapped).unionByName(base))


def linear_shapley(df, fitted, background):
    """Exact Shapley values of a linear margin: weight x (value - background mean)."""
    means = background.select(F.posexplode("features").alias("pos", "x")).groupBy("pos").agg(
        F.avg("x").alias("m")
    ).agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("s")).select(F.col("s.m").alias("m"))
    phi = F.zip_with(V.subtract("features", "_m"), F.col("_p.weight"), lambda d, w: d * w)
    return df.withColumn("_p", fitted.scalar()).withColumn("_m", means.scalar()).withColumn(
        "phi", phi
    ).drop("_p", "_m")


def background_rows(train, size=40, seed=42):
    """A seeded sample of training rows with equal weights: ``size`` rows (values, weight)."""
    return train.orderBy(order_key(seed), "id").limit(size).select(
        F.col("features").alias("values"), F.lit(1.0).alias("weight"))


def kmeans_background(train, centres=8, seed=42, features="features"):
    """Cluster centres weighted by cluster size: rows (values, weight)."""
    vec = train.select(array_to_vector(features).alias("v"))
    model = KMeans(k=centres, seed=seed, featuresCol="v", maxIter=20).fit(vec)
    rows = [([float(x) for x in c], float(n)) for c, n in zip(model.clusterCenters(), model.summary.clusterSizes) if n]
    return train.sparkSession.createDataFrame(rows, "values array<double>, weight double")


def shapley_draws(background, permutations=4, seed=42, width=K.N_BANDS):
    """A band order for every background row and permutation: (b, place, order, weight); the weights sum to 1.

    Orders come in pairs, one the reverse of the other, which cancels much of the sampling error. They are sorted by a
    hash of seed, row, pair and band, so nothing of them stands in the plan.
    """
    numbered = background.select("values", "weight", F.xxhash64("values", "weight").alias("row"))
    drawn = numbered.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
    every = F.sequence(F.lit(1), F.lit(width))
    keyed = F.array_sort(F.transform(every, lambda band: F.struct(
        F.xxhash64(F.lit(seed), "row", F.floor(F.col("turn") / 2), band).alias("key"), band.alias("band"))))
    order = F.transform(keyed, lambda e: e["band"])
    order = F.when(F.col("turn") % 2 == 1, F.reverse(order)).otherwise(order)
    total = background.agg(F.sum("weight") * permutations).scalar()
    drawn = drawn.select(F.col("values").alias("b"), order.alias("order"), (F.col("weight") / total).alias("weight"))
    return drawn.withColumn("place", F.transform(
        every, lambda band: (F.array_position("order", band) - 1).cast("int")))


def shapley_sampling(model, df, background, permutations=4, seed=42, width=K.N_BANDS):
    """Sampled Shapley values of the probability of any fitted model.

    For each background row and random band order (Strumbelj and Kononenko 2014) bands
    change over from the background to the row one at a time. ``background`` is a table (values, weight) of stated size.
    Its draws are one array that tasks read; all steps of a row are made, scored and summed in the same task, so the
    shuffle carries one value per (row, band). The values of a row add up to its score minus the mean background score.
    """
    draws = stable(shapley_draws(background, permutations, seed, width))
    score = M.batch_scorer(model)
    if score:
        return _scored_in_task(score, df, draws)
    # Background rows x permutations entries.
    draws = draws.agg(F.collect_list(F.struct("b", "place", "order", "weight")).alias("draws"))
    steps = (
        df.select("id", "features", F.explode(draws.scalar()).alias("d"))
        .select("id", "features", "d.*", F.explode(F.sequence(F.lit(0), F.lit(width))).alias("step"))
        .select(
            "id", "order", "weight", "step",
            F.zip_with(
                F.zip_with("features", "b", lambda x, b: F.struct(x.alias("x"), b.alias("b"))), "place",
                lambda p, at: F.when(at < F.col("step"), p["x"]).otherwise(p["b"]),
            ).alias("features"),
        )
    )
    scored = M.with_scores(model, steps.withColumn("scaled", array_to_vector("features")))
    # a score counts for the band that entered last and against the one that enters next
    gain = F.when(F.col("step") > 0, F.struct(
        F.get("order", F.col("step") - 1).alias("band"), (F.col("prob") * F.col("weight")).alias("v")))
    loss = F.when(F.col("step") < width, F.struct(
        F.get("order", F.col("step")).alias("band"), (-F.col("prob") * F.col("weight")).alias("v")))
    signed = scored.select("id", F.explode(F.array_compact(F.array(gain, loss))).alias("s"))
    return signed.groupBy("id", F.col("s.band").alias("band")).agg(F.sum("s.v").alias("phi"))


#: Changed rows that a task scores at once, in numbers.
STEP_NUMBERS = 1 << 16


def _scored_in_task(score, df, draws):
    """Shapley values by a linear batch scorer: a step moves one band, so the margins of a draw are running sums along its
    order, and a task sums the gains of a row band by band."""
    held = draws.collect()  # background rows x permutations: the stated size of the background
    base, weight = np.array([d["b"] for d in held], dtype=float), np.array([d["weight"] for d in held])
    order = np.array([d["order"] for d in held])
    width = base.shape[1]
    shared = df.sparkSession.sparkContext.broadcast((base, order - 1, weight))

    def run(batches):
        base, order, weight = shared.value
        weights, size = score.weights, max(1, STEP_NUMBERS // (width + 1))
        start, entering = base @ weights + score.intercept, np.take_along_axis(base * weights, order, axis=1)
        draws = [(order[i:i + size], start[i:i + size], entering[i:i + size], order[i:i + size].ravel(),
                  weight[i:i + size, None]) for i in range(0, len(weight), size)]
        for pdf in batches:
            rows, phi = np.stack(pdf["features"].to_numpy()).astype(float) if len(pdf) else [], np.zeros((len(pdf), width))
            for out, x in zip(phi, rows):
                change = x * weights
                for part, start, entering, cells, share in draws:
                    margin = np.empty((len(start), width + 1))
                    margin[:, 0] = start
                    np.subtract(change[part], entering, out=margin[:, 1:])
                    prob = score.of_margin(np.cumsum(margin, axis=1, out=margin))[0]
                    gain = prob[:, 1:] - prob[:, :-1]
                    gain *= share
                    out += np.bincount(cells, gain.ravel(), width)
            yield pd.DataFrame({"id": np.repeat(pdf["id"].to_numpy(), width), "phi": phi.ravel(),
                                "band": np.tile(np.arange(1, width + 1, dtype="int32"), len(pdf))})

    return df.select("id", "features").mapInPandas(run, "id bigint, band int, phi double")


def shapley_gap(model, df, background, attr):
    """Per row what its Shapley values miss of score minus weighted mean background score: 0 but for rounding."""
    def scores(rows):
        return M.with_scores(model, rows.withColumn("scaled", array_to_vector("features")))

    mean = scores(background.select("weight", F.col("values").alias("features"))).agg(
        (F.sum(F.col("prob") * F.col("weight")) / F.sum("weight"))).scalar()
    sums = attr.groupBy("id").agg(F.sum("phi").alias("phi"))
    return scores(df).withColumn("mean", mean).join(sums, "id").select(
        "id", (F.col("phi") - F.col("prob") + F.col("mean")).alias("gap"))


def phi_arrays(attr):
    """Long (id, band, phi) to one array per row."""
    ordered = F.array_sort(F.collect_list(F.struct("band", "phi")))  # one entry per band
    return attr.groupBy("id").agg(F.transform(ordered, lambda s: s["phi"]).alias("phi"))


def differential_attribution(df, profile, factor=0.1):
    """Fallback attribution: deviation from the benign mean spectrum times a constant.

    ``profile`` is a one-row frame with the array ``profile``.
    """
    return df.withColumn("_b", profile.select("profile").scalar()).withColumn(
        "phi", F.transform(V.subtract("features", "_b"), lambda d: d * F.lit(factor))
    ).drop("_b")


def global_attribution(attr):
    """Mean absolute attribution per band of wide rows (id, phi array)."""
    return attr.select(F.posexplode("phi").alias("pos", "v")).groupBy((F.col("pos") + 1).alias("band")).agg(
        F.avg(F.abs("v")).alias("mean_abs_phi")
    )


def top_bands(table, value, k=15):
    """The k highest bands with their display name."""
    return table.orderBy(F.desc(value), "band").limit(k).withColumn("feature", S.band_name("band"))


def _strongest_first():
    """The row's (strength, band, phi, x) entries, sorted within the row: no shuffle is needed."""
    keyed = F.arrays_zip(
        F.transform("phi", lambda p: -F.abs(p)).alias("s"), F.sequence(F.lit(1), F.size("phi")).alias("band"),
        F.col("phi").alias("phi"), F.col("features").alias("x"),
    )
    return F.array_sort(keyed)


def top_drivers(attr, k=6):
    """Per row, the k strongest bands for and against the positive class; zeros in neither.

    ``attr`` has (id, features, phi), both arrays.
    """
    sorted_ = attr.select("id", _strongest_first().alias("e"))
    sides = F.array(
        F.struct(F.lit("mine").alias("side"), F.slice(F.filter("e", lambda v: v["phi"] > 0), 1, k).alias("top")),
        F.struct(F.lit("rock").alias("side"), F.slice(F.filter("e", lambda v: v["phi"] < 0), 1, k).alias("top")),
    )
    rows = sorted_.select("id", F.explode(sides).alias("s")).select(
        "id", "s.side", F.posexplode("s.top").alias("pos", "t")
    )
    return rows.select(
        "id", "side", (F.col("pos") + 1).alias("rank"), F.col("t.band").alias("band"),
        S.band_name("t.band").alias("feature"), F.round("t.phi", 5).alias("shap_value"),
        F.round("t.x", 4).alias("raw_value"), S.impact_text("t.phi").alias("impact"),
    )


def top_absolute(attr, k=8):
    """Per row, the k bands of largest absolute attribution."""
    return attr.select("id", F.posexplode(F.slice(_strongest_first(), 1, k)).alias("pos", "t")).select(
        "id", (F.col("pos") + 1).alias("rank"), F.col("t.band").alias("band"), F.col("t.phi").alias("phi")
    )


def normalised_drivers(drivers, floor=0.001):
    """Bar length of every driver relative to the row's strongest one.

    ``drivers`` comes from :func:`top_drivers`, so a row holds at most 2k entries.
    """
    from pyspark.sql import Window

    strongest = F.max(F.abs("shap_value")).over(Window.partitionBy("id"))
    return drivers.withColumn(
        "bar_pct", F.abs("shap_value") / F.greatest(strongest, F.lit(floor)) * 100.0
    )
