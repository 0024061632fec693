"""k-nearest-neighbour joins, exact and by buckets, and the vote over them.

The exact join has two phases over blocks of the training rows, each with the centre and radius of its own rows. First
every query is compared with the blocks around it, enough to hold k rows: the distance of the k-th found is a true bound.
Then a block is asked for a query only if the triangle inequality allows a row within that bound. Blocks and their queries
are cut into pieces of bounded size; a training row is sent to as many pieces as its own block's queries fill, whatever
other blocks are asked. A piece hands on k rows per query, never its pairs.

The approximate join compares rows that fall into one bucket of a few random projections, in several tables, and in the
buckets next to the query's own. Distances are exact, so only neighbours can be missed; ``recall`` measures how many. How
coarse the buckets are and how many are probed is chosen by the neighbours of a sample of queries, found against all rows.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Window
from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.functions import scalar as S
from bandlore.operators.sampling import order_key
from bandlore.session import stable

METRICS = ("euclidean", "manhattan")
WEIGHTS = ("uniform", "distance")
#: Fewest and most blocks of the exact join; between, one for TRAIN_BLOCK rows. Every row of a query is sent to each block
#: it asks, so small pieces are merged until no more than MOST_PIECES are made or they have the sizes below.
N_PIVOTS, MOST_PIVOTS, MOST_PIECES = 32, 1_024, 512
TRAIN_BLOCK = 20_000
QUERY_BLOCK = 20_000
#: Pairs screened at once.
SCREENED = 1 << 20
#: Tables of the approximate join, rows of its smallest buckets, rows sampled for the cuts, queries sampled to choose bits
#: and probes, the share of their neighbours to be found, and the pairs that cost as much as a copy of a row.
TABLES, BUCKET, SAMPLE, TUNED, REACHED, COPY = 16, 400, 10_000, 400, 0.95, 500
FOUND = "id bigint, neighbor bigint, y int, distance double"


def _distances(a, b, metric):
    """All distances between two small row blocks; equal rows give exactly 0."""
    out = np.empty((len(a), len(b)))
    step = max(1, 4_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        diff = a[i:i + step, None, :] - b[None, :, :]
        if metric == "euclidean":
            out[i:i + step] = np.sqrt(np.einsum("qtd,qtd->qt", diff, diff))
        else:
            out[i:i + step] = np.abs(diff).sum(axis=2)
    return out


def _city(a, columns, rows=16, width=4_096):
    """City-block distances between rows and a transposed block in its own precision, in pieces that stay in the cache."""
    out = np.empty((len(a), columns.shape[1]), columns.dtype)
    a = a.astype(columns.dtype)
    for j in range(0, out.shape[1], width):
        part = np.ascontiguousarray(columns[:, j:j + width])
        for i in range(0, len(a), rows):
            total = np.zeros((min(rows, len(a) - i), part.shape[1]), columns.dtype)
            diff = np.empty_like(total)
            for x, values in zip(a[i:i + rows].T, part):
                np.subtract(x[:, None], values, out=diff)
                np.abs(diff, out=diff)
                total += diff
            out[i:i + rows, j:j + width] = total
    return out


def _pair_distances(a, b, i, j, metric, step=20_000):
    """Distances of the listed row pairs, in bounded pieces."""
    out = np.empty(len(i))
    for s in range(0, len(i), step):
        diff = a[i[s:s + step]] - b[j[s:s + step]]
        out[s:s + step] = (
            np.sqrt(np.einsum("pd,pd->p", diff, diff)) if metric == "euclidean" else np.abs(diff).sum(axis=1)
        )
    return out


def _block_top_k(q, t, ids, k, metric):
    """(query row, training row, distance) of the k nearest rows of the block per query.

    A matrix product screens the euclidean case, sums in single precision the other. Their rounding error is below the
    slack, so every row that could be among the k nearest is measured again exactly.
    """
    k = min(k, len(t))
    t_sq = np.einsum("td,td->t", t, t)
    found, step = [], max(1, min(256, SCREENED // len(t)))
    size = np.abs(t).sum(axis=1).max()
    light = max(np.abs(q).max(initial=0.0), np.abs(t).max(initial=0.0)) < 1e30
    columns = np.ascontiguousarray(t.T, dtype=np.float32 if light else float)
    for s in range(0, len(q), step):
        part = q[s:s + step]
        if metric == "euclidean":
            q_sq = np.einsum("qd,qd->q", part, part)
            rough = q_sq[:, None] + t_sq[None, :] - 2.0 * (part @ t.T)
            slack = 1e-9 * (q_sq + t_sq.max())
        else:
            rough = _city(part, columns)
            eps = np.finfo(columns.dtype).eps
            slack = 4 * eps * len(columns) * (np.abs(part).sum(axis=1) + size) + 1e-36
        kth = np.partition(rough, k - 1, axis=1)[:, k - 1]
        i, j = np.nonzero(rough <= (kth + slack)[:, None])
        d = _pair_distances(part, t, i, j, metric)
        order = np.lexsort((ids[j], d, i))
        i, j, d = i[order], j[order], d[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = place < k
        found.append((i[keep] + s, j[keep], d[keep]))
    return tuple(np.concatenate(c) for c in zip(*found))


def _matrix(series):
    return np.stack(series.to_numpy()).astype(float)


def _cell_of(pivots, metric):
    schema = "cell int, away double"

    @F.pandas_udf(schema)
    def nearest(features: pd.Series) -> pd.DataFrame:
        d = _distances(_matrix(features), pivots, metric)
        cell = d.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "away": d[np.arange(len(d)), cell]})

    return nearest


class Blocks:
    """Training rows in blocks around sampled pivots, and what the driver knows of each: size, centre, radius, and the
    range of distances to its pivot. Their number is bounded by MOST_PIVOTS."""

    def __init__(self, train, metric, n_pivots=None, train_block=TRAIN_BLOCK):
        if metric not in METRICS:
            raise ValueError(f"unknown metric {metric!r}; use one of {METRICS}")
        if n_pivots is None:
            n_pivots = min(MOST_PIVOTS, max(N_PIVOTS, train.count() // max(train_block, TRAIN_BLOCK)))
        sample = train.select("id", "features").orderBy(order_key(7), "id").limit(n_pivots).collect()
        if not sample:
            raise ValueError("no training rows")
        self.metric, self.train_block = metric, train_block
        self.pivots = np.array([r["features"] for r in sample], dtype=float)
        # New names: both sides may come from one table, and a co-group needs distinct columns.
        self.rows = train.select(
            F.col("id").alias("neighbor"), F.col("features").alias("vector"), F.col("y").cast("int").alias("y"),
            _cell_of(self.pivots, metric)("features").alias("c"),
        ).select("neighbor", "vector", "y", "c.cell", "c.away")
        found = self.rows.groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"), F.min("away").alias("near"), F.max("away").alias("far"),
            Summarizer.mean(array_to_vector("vector")).alias("centre")).orderBy("cell").collect()
        self.cells = np.array([r["cell"] for r in found])
        self.sizes = np.array([r["n"] for r in found])
        self.near, self.far = (np.array([r[c] for r in found]) for c in ("near", "far"))
        self.centres = np.array([r["centre"].toArray() for r in found])
        radii = {r["cell"]: r["radius"] for r in self.rows.groupBy("cell").agg(
            F.max(self._to_own_centre()("vector", "cell")).alias("radius")).collect()}
        self.radii = np.array([radii[c] for c in self.cells.tolist()])

    def _to_own_centre(self):
        centres, cells, metric = self.centres, self.cells, self.metric

        @F.pandas_udf("double")
        def away(vector: pd.Series, cell: pd.Series) -> pd.Series:
            diff = _matrix(vector) - centres[np.searchsorted(cells, cell.to_numpy())]
            return pd.Series(np.sqrt((diff * diff).sum(1)) if metric == "euclidean" else np.abs(diff).sum(1))

        return away

    def home(self, k):
        """The cells nearest to a query, until they hold ``k`` rows."""
        pivots, cells, sizes, metric = self.pivots[self.cells], self.cells, self.sizes, self.metric

        @F.pandas_udf("array<int>")
        def nearest(features: pd.Series) -> pd.Series:
            order = np.argsort(_distances(_matrix(features), pivots, metric), axis=1, kind="stable")
            held = np.cumsum(sizes[order], axis=1)
            return pd.Series([cells[row[:1 + np.searchsorted(n, k)]].tolist() for row, n in zip(order, held)])

        return nearest

    def beyond(self):
        """The cells outside ``home`` that may hold a row within ``bound`` of a query."""
        pivots, cells, metric = self.pivots[self.cells], self.cells, self.metric
        centres, radii, near, far = self.centres, self.radii, self.near, self.far

        @F.pandas_udf("array<int>")
        def within(features: pd.Series, bound: pd.Series, home: pd.Series) -> pd.Series:
            rows = _matrix(features)
            d = _distances(rows, pivots, metric)
            low = np.maximum(np.maximum(d - far, near - d), _distances(rows, centres, metric) - radii)
            reach = bound.to_numpy()[:, None] * (1 + 1e-9) + 1e-12
            for k, own in enumerate(home):
                low[k, np.searchsorted(cells, np.asarray(own))] = np.inf
            return pd.Series([cells[row].tolist() for row in low <= reach])

        return within

    def compared(self, asked, k, query_block):
        """The k nearest rows of every piece of the cells asked: ``asked`` has id, features, cell."""
        wanted = {r["cell"]: r["n"] for r in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        sizes = dict(zip(self.cells.tolist(), self.sizes.tolist()))
        train_block, query_block = _block_sizes(sizes, wanted, self.train_block, query_block)
        pieces = [(c, -(-sizes[c] // train_block), -(-n // query_block)) for c, n in sorted(wanted.items())]
        if not pieces:
            return self.rows.sparkSession.createDataFrame([], FOUND)
        parts, slices = (F.create_map(*[F.lit(v) for row in pieces for v in (row[0], row[i])]) for i in (1, 2))

        def spread(column, salt, pieces):
            return F.pmod(F.xxhash64(column, F.lit(salt)), pieces).cast("int")

        part_count, slice_count = (F.element_at(m, F.col("cell")) for m in (parts, slices))
        left = asked.withColumn("part", F.explode(F.sequence(F.lit(0), part_count - 1))).withColumn(
            "slice", spread("id", 11, slice_count))
        right = self.rows.select("neighbor", "vector", "y", "cell").where(F.col("cell").isin([c for c, _, _ in pieces]))
        right = right.withColumn("part", spread("neighbor", 13, part_count)).withColumn(
            "slice", F.explode(F.sequence(F.lit(0), slice_count - 1)))
        return _compared(left, right, ["cell", "part", "slice"], k, self.metric)


def _block_sizes(sizes, wanted, train_block, query_block):
    """Rows of a piece on both sides, raised where more than MOST_PIECES would be made, but not above the defaults."""
    def count():
        return sum(-(-sizes[c] // train_block) * -(-n // query_block) for c, n in wanted.items())

    while count() > MOST_PIECES and (train_block < TRAIN_BLOCK or query_block < QUERY_BLOCK):
        train_block, query_block = (max(b, min(2 * b, most)) for b, most in (
            (train_block, TRAIN_BLOCK), (query_block, QUERY_BLOCK)))
    return train_block, query_block


def _compared(asked, held, keys, k, metric):
    """Per group of ``keys`` the k nearest of its rows ``held`` for every row ``asked``."""

    names, kinds = ["id", "neighbor", "y", "distance"], [pa.int64(), pa.int64(), pa.int32(), pa.float64()]

    def rows(table, column):
        values = table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return values.astype(float, copy=False).reshape(table.num_rows, -1)

    def block(q, t):
        if not q.num_rows or not t.num_rows:
            return pa.table([pa.array([], kind) for kind in kinds], names)
        ids = t.column("neighbor").to_numpy()
        i, j, d = _block_top_k(rows(q, "features"), rows(t, "vector"), ids, k, metric)
        taken = q.column("id").take(pa.array(i)), pa.array(ids[j]), t.column("y").take(pa.array(j)), pa.array(d)
        return pa.table([c.cast(kind) for c, kind in zip(taken, kinds)], names)

    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(block, FOUND)


def _ranked(found, k):
    order = Window.partitionBy("id").orderBy("distance", "neighbor")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _phases(queries, blocks, k, query_block):
    """(found in the home cells, requests beyond them): the requests are (id, features, cell)."""
    asked = queries.select("id", "features", blocks.home(k)("features").alias("home"))
    near = blocks.compared(asked.select("id", "features", F.explode("home").alias("cell")), k, query_block)
    near = stable(_ranked(near, k).drop("rank"))
    bounds = near.groupBy("id").agg(F.max("distance").alias("bound"), F.count(F.lit(1)).alias("n"))
    bounds = bounds.select("id", F.when(F.col("n") < k, float("inf")).otherwise(F.col("bound")).alias("bound"))
    beyond = asked.join(bounds, "id").select(
        "id", "features", F.explode(blocks.beyond()("features", "bound", "home")).alias("cell"))
    return near, beyond


def nearest_neighbors(queries, train, k, metric="euclidean", n_pivots=None, train_block=TRAIN_BLOCK,
                      query_block=QUERY_BLOCK):
    """The k nearest training rows of every query row, nearest first, lower id on ties.

    ``queries`` has (id, features), ids without repeats; ``train`` has (id, features, y). Returns one row per
    pair: query id, rank from 1, neighbour id, neighbour y, distance.
    """
    blocks = Blocks(train, metric, n_pivots, train_block)
    near, beyond = _phases(queries, blocks, k, query_block)
    beyond = stable(beyond)
    return _ranked(near.unionByName(blocks.compared(beyond, k, query_block)), k)


def visited_share(queries, train, k, metric="euclidean", n_pivots=None, train_block=TRAIN_BLOCK):
    """Mean share of the blocks that a query is compared with: how much the bounds save on these rows."""
    blocks = Blocks(train, metric, n_pivots, train_block)
    _, beyond = _phases(queries, blocks, k, QUERY_BLOCK)
    home = queries.agg(F.sum(F.size(blocks.home(k)("features")))).head()[0]
    return (home + beyond.count()) / (queries.count() * len(blocks.cells))


class Projections:
    """``bits`` random projections in each of ``tables`` tables, every one cut at the median of a bounded sample."""

    def __init__(self, sample, tables, bits, seed=42):
        axes = np.random.default_rng(seed).normal(size=(sample.shape[1], tables * bits))
        self.axes, self.cuts, self.shape = axes, np.median(sample @ axes, axis=0), (tables, bits)

    def keys(self, rows, probes=0):
        """Per row and table the keys of its own bucket and of those across the ``probes`` nearest cuts."""
        margins = (rows @ self.axes - self.cuts).reshape(-1, *self.shape)
        powers = np.int64(1) << np.arange(self.shape[1])
        own = ((margins > 0) * powers).sum(axis=2)[:, :, None]
        nearest = np.argsort(np.abs(margins), axis=2)[:, :, :probes]
        return np.concatenate((own, own ^ powers[nearest]), axis=2)

    def buckets(self, probes=0):
        """The same as an array of (table, key) per row."""
        @F.pandas_udf("array<struct<table:int,key:bigint>>")
        def of(features: pd.Series) -> pd.Series:
            every = self.keys(_matrix(features), probes)
            return pd.Series([[{"table": t, "key": int(key)} for t, keys in enumerate(row) for key in keys] for row in every])

        return of


def _sampled(train, seed):
    rows = train.select("id", "features").orderBy(order_key(seed), "id").limit(SAMPLE).collect()
    if not rows:
        raise ValueError("no training rows")
    return np.array([r["features"] for r in rows], dtype=float)


def _tuned(queries, train, k, metric, sample, tables, bits, probes, seed):
    """The cheapest (tables, bits, probes) by which the sampled queries meet REACHED of their neighbours in a bucket.

    ``bits`` or ``probes`` is kept if given. One bit with one probe meets every row, so there always is a setting.
    """
    rows, asked = train.count(), queries.count()
    chosen = stable(queries.select("id", "features").orderBy(order_key(seed + 2), "id").limit(TUNED))
    exact = nearest_neighbors(chosen, train, k, metric).select("id", "neighbor")
    pairs = exact.join(chosen.select("id", F.col("features").alias("q")), "id").join(
        train.select(F.col("id").alias("neighbor"), F.col("features").alias("t")), "neighbor").collect()  # TUNED x k at most
    most = max(1, math.ceil(math.log2(max(2, rows / BUCKET))))
    if not pairs:
        return tables, bits or most, probes or 0
    q, t = (np.array([r[c] for r in pairs], dtype=float) for c in ("q", "t"))
    found = []
    for b in [bits] if bits else range(1, most + 1):
        cuts = Projections(sample, tables, b, seed)
        held = cuts.keys(t)[:, :, :1]
        for p in [probes] if probes is not None else range(b + 1):
            met = (cuts.keys(q, p) == held).any(axis=2)
            for n in sorted({tables, *(x for x in (1, 2, 4, 8) if x < tables)}):
                share = met[:, :n].any(axis=1).mean()
                cost = asked * n * (1 + p) * (rows / 2 ** b + COPY) + rows * n * COPY
                found.append((max(0.0, REACHED - share), cost, n, b, p))
    return min(found)[2:]


def approximate_neighbors(queries, train, k, metric="euclidean", tables=TABLES, bits=None, probes=None, seed=42,
                          train_block=TRAIN_BLOCK, query_block=QUERY_BLOCK):
    """About the k nearest training rows of every query row, like ``nearest_neighbors``; fewer if its buckets hold fewer.

    ``bits`` and ``probes`` are chosen by ``_tuned`` if left out, and then no more than ``tables`` are used. Hot buckets are
    cut by id on both sides.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; use one of {METRICS}")
    sample = _sampled(train, seed)
    if bits is None or probes is None:
        tables, bits, probes = _tuned(queries, train, k, metric, sample, tables, bits, probes, seed)
    cuts = Projections(sample, tables, bits, seed)
    bucket = ["table", "key"]
    held = train.select(
        F.col("id").alias("neighbor"), F.col("features").alias("vector"), F.col("y").cast("int").alias("y"),
        F.explode(cuts.buckets()("features")).alias("b")).select("neighbor", "vector", "y", "b.*")
    asked = queries.select("id", "features", F.explode(cuts.buckets(probes)("features")).alias("b")).select(
        "id", "features", "b.*")
    sizes = stable(held.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / train_block).alias("parts")).join(
        asked.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / query_block).alias("slices")), bucket))
    left = asked.join(sizes, bucket).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn(
        "slice", F.pmod(F.xxhash64("id"), F.col("slices")))
    right = held.join(sizes, bucket).withColumn("part", F.pmod(F.xxhash64("neighbor"), F.col("parts"))).withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    found = _compared(left.drop("parts", "slices"), right.drop("parts", "slices"), [*bucket, "part", "slice"], k, metric)
    # A neighbour is found in several tables, each time at the same distance.
    return _ranked(found.distinct(), k)


def recall(found, exact):
    """One row: queries, pairs, and the share of the exact pairs that are found."""
    both = exact.select("id", "neighbor").join(found.select("id", "neighbor", F.lit(1).alias("hit")), ["id", "neighbor"], "left")
    return both.agg(F.countDistinct("id").alias("queries"), F.count(F.lit(1)).alias("pairs"),
                    (F.count("hit") / F.count(F.lit(1))).alias("recall"))


def vote_all(neighbors, sizes, kinds=WEIGHTS):
    """Probability of the positive class per query, neighbourhood size and kind of vote, in one pass.

    uniform: share of positives. distance: weights 1/d; if any d is 0 only those rows vote.
    """
    unknown = set(kinds) - set(WEIGHTS)
    if unknown:
        raise ValueError(f"unknown weights {sorted(unknown)}; use {WEIGHTS}")
    exact, positive = F.col("distance") == 0.0, F.col("y") == 1
    w = F.try_divide(F.lit(1.0), F.col("distance"))
    sums, entries = [], []
    for k in sizes:
        near = F.col("rank") <= k
        sums += [
            F.avg(F.when(near, F.col("y"))).alias(f"u{k}"),
            F.count_if(near & exact).alias(f"e{k}"), F.count_if(near & exact & positive).alias(f"f{k}"),
            F.sum(F.when(near, w)).alias(f"w{k}"), F.sum(F.when(near & positive, w)).alias(f"v{k}"),
        ]
        by_distance = F.when(F.col(f"e{k}") > 0, S.ratio(f"f{k}", f"e{k}")).otherwise(
            S.ratio(F.coalesce(f"v{k}", F.lit(0.0)), f"w{k}"))
        probs = {"uniform": F.col(f"u{k}"), "distance": by_distance}
        entries += [F.struct(F.lit(k).alias("k"), F.lit(n).alias("weights"), probs[n].alias("prob")) for n in kinds]
    per_query = neighbors.where(F.col("rank") <= max(sizes)).groupBy("id").agg(*sums)
    return per_query.select("id", F.explode(F.array(*entries)).alias("s")).select("id", "s.*")


def vote(neighbors, k, weights="distance"):
    return vote_all(neighbors, [k], [weights]).select("id", "prob")


class KnnClassifier:
    """k-NN with the reference defaults: 5 neighbours, distance weights, euclidean.

    ``fit`` only keeps the training rows; every ``transform`` is a join against them.
    """

    def __init__(self, k=5, weights="distance", metric="euclidean", features="features"):
        self.k, self.weights, self.metric, self.features = k, weights, metric, features

    def fit(self, train):
        return KnnModel(self, train.select("id", F.col(self.features).alias("features"), "y"))


class KnnModel:
    def __init__(self, settings, train):
        self.settings, self.train = settings, train

    def transform(self, df):
        s = self.settings
        asked = df.select("id", F.col(s.features).alias("features"))
        probs = vote(nearest_neighbors(asked, self.train, s.k, s.metric), s.k, s.weights)
        scored = df.join(probs, "id")
        # half a vote counts for the lower class, unlike the inclusive threshold rule
        return scored.withColumn("pred_label", (F.col("prob") > K.DEFAULT_TAU).cast("int"))

    def save(self, path):
        s = self.settings
        self.train.withColumn("_settings", F.to_json(F.struct(
            F.lit(s.k).alias("k"), F.lit(s.weights).alias("weights"),
            F.lit(s.metric).alias("metric"), F.lit(s.features).alias("features"),
        ))).write.mode("overwrite").parquet(path)
        return path

    @staticmethod
    def load(spark, path):
        import json

        rows = spark.read.parquet(path)
        settings = json.loads(rows.select("_settings").head()[0])
        return KnnModel(KnnClassifier(**settings), rows.drop("_settings"))
