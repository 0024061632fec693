"""Random forests of full depth, grown where the rows are.

Spark's own forest sends a histogram of every node from every partition to the driver's node queue, also for nodes of a few
rows, and keeps all trees in the driver. Here the top of a tree is grown by such histograms only as long as a node has more
than LOCAL_ROWS rows; then the rows of a node are sent to one task, which finishes its subtree level by level. The nodes are
a written table; nothing of them goes through the driver but the splits of the top.

Rows are drawn for a tree by Poisson numbers and a node's bands by hashes of seed, tree and node, so a repeated task grows
the same subtree. Nodes are numbered by their path: 1 is the root, a node's children are 2n and 2n + 1.
"""

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.session import scratch_path

#: Bins of a band, rows of a node that one task finishes, rows scored at once against a tree, levels below the root.
BINS, LOCAL_ROWS, SCORE_ROWS, MAX_DEPTH = 32, 200_000, 200_000, 30
NODES = "tree int, node bigint, band int, bin int, n bigint, positives bigint, gain double"


def _hashed(*parts):
    """Numbers in [0, 1) from integers that broadcast against each other."""
    with np.errstate(over="ignore"):
        x = np.uint64(0)
        for p in parts:
            x = (x ^ np.asarray(p).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(float) / (1 << 53)


_POISSON = np.cumsum(np.exp(-1.0) / np.concatenate(([1.0], np.cumprod(np.arange(1.0, 18.0)))))


def _draws(ids, tree, seed):
    """How often each row is drawn for a tree."""
    return np.searchsorted(_POISSON, _hashed(seed, tree, ids), side="right")


def _bands(tree, nodes, seed, width, subset):
    """The bands tried at each node, rising."""
    u = _hashed(seed + 1, tree, nodes[:, None], np.arange(width)[None, :])
    return np.sort(np.argpartition(u, subset - 1, axis=1)[:, :subset], axis=1)


def _gains(n, p):
    """Best (bin, gain) per row of histograms (nodes x bins) of rows and positives; gain 0 if nothing can be split."""
    all_n, all_p = n.sum(1), p.sum(1)
    ln, lp = np.cumsum(n, 1)[:, :-1], np.cumsum(p, 1)[:, :-1]
    rn, rp = all_n[:, None] - ln, all_p[:, None] - lp
    with np.errstate(divide="ignore", invalid="ignore"):
        kept = (lp * lp + (ln - lp) ** 2) / ln + (rp * rp + (rn - rp) ** 2) / rn
    kept = np.where((ln > 0) & (rn > 0), kept, 0.0)
    at = kept.argmax(1)
    whole = (all_p * all_p + (all_n - all_p) ** 2) / all_n
    gain = (kept[np.arange(len(n)), at] - whole) / all_n
    return at, np.where(gain > 1e-12, gain, 0.0)


def grown(codes, y, draws, tree, root, seed, subset):
    """The subtree below node ``root`` of the given rows: a frame of NODES; leaves have band -1."""
    at, paths, out = np.zeros(len(y), np.int64), np.array([root]), []
    draws, hits = draws.astype(float), draws * y.astype(float)
    while len(paths):
        size = len(paths)
        n, p = np.bincount(at, draws, size), np.bincount(at, hits, size)
        band, cut, gain = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
        live = np.flatnonzero((p > 0) & (p < n) & (paths < 1 << MAX_DEPTH))
        if len(live):
            place = np.full(size, -1)
            place[live] = np.arange(len(live))
            used = place[at] >= 0
            codes, draws, hits, at = codes[used], draws[used], hits[used], at[used]
            row, tried = place[at], _bands(tree, paths[live], seed, codes.shape[1], subset)
            for j in range(subset):
                cell = row * BINS + codes[np.arange(len(row)), tried[row, j]]
                shape = len(live), BINS
                bins, g = _gains(*(np.bincount(cell, x, len(live) * BINS).reshape(shape) for x in (draws, hits)))
                better = g > gain[live]
                which = live[better]
                band[which], cut[which], gain[which] = tried[better, j], bins[better], g[better]
        out.append(pd.DataFrame({"tree": np.int32(tree), "node": paths, "band": band.astype("int32"), "bin": cut.astype("int32"),
                                 "n": n.astype("int64"), "positives": p.astype("int64"), "gain": gain}))
        if not len(live):
            break
        split = band >= 0
        number = np.cumsum(split) - 1
        used = split[at]
        codes, draws, hits, at = codes[used], draws[used], hits[used], at[used]
        right = codes[np.arange(len(at)), band[at]] > cut[at]
        at = 2 * number[at] + right
        paths = (2 * paths[split][:, None] + np.arange(2)).ravel()
    return pd.concat(out)


def _walked(codes, nodes, band, cut):
    """Per row the place of the node that it ends in, among nodes sorted by path."""
    where = np.zeros(len(codes), np.int64)
    going = np.arange(len(codes))
    while len(going):
        going = going[band[where[going]] >= 0]
        here = where[going]
        path = 2 * nodes[here] + (codes[going, band[here]] > cut[here])
        found = np.searchsorted(nodes, path)
        where[going] = found
    return where


def _unpacked(blobs, width):
    return np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, width)


class DeepForest:
    """Gini forest of ``trees`` trees on binned bands, leaves of one row, at most MAX_DEPTH levels."""

    def __init__(self, trees=100, subset=None, seed=42, features="scaled", label="y", local_rows=LOCAL_ROWS):
        self.trees, self.subset, self.seed = trees, subset, seed
        self.features, self.label, self.local_rows = features, label, local_rows

    def fit(self, train):
        """``train`` has a numeric ``id``, the vector of features and the label 0 or 1."""
        spark = train.sparkSession
        values = train.select(F.posexplode(vector_to_array(self.features)).alias("band", "x"))
        cuts = values.groupBy("band").agg(F.percentile_approx(
            "x", [i / BINS for i in range(1, BINS)], 1_000).alias("cuts")).orderBy("band").collect()  # one row per band
        self.edges = [np.unique(r["cuts"]) for r in cuts]
        self.width = len(self.edges)
        self.tried = self.subset or int(np.ceil(np.sqrt(self.width)))
        path = scratch_path(spark, "binned")
        binned(train, self.features, self.edges, F.col(self.label).cast("int").alias("y")).write.parquet(path)
        rows = spark.read.parquet(path)
        top = self._top(rows)
        nodes = scratch_path(spark, "nodes")
        below = self._dealt(rows, top).groupBy("tree", "node").applyInPandas(self._finish(), NODES)
        split = [(t, n, *s) for t, held in top.items() for n, s in held.items()]
        spark.createDataFrame(split, NODES).unionByName(below).write.parquet(nodes)
        return DeepForestModel(spark.read.schema(NODES).parquet(nodes), self.edges, self.features, self.trees)

    def _top(self, rows):
        """Per tree the split nodes of more than ``local_rows`` rows: {node: (band, bin, n, positives, gain)}."""
        top = {t: {} for t in range(self.trees)}
        wanted = {t: [1] for t in top} if rows.count() > self.local_rows else {}
        while wanted:
            found = self._histograms(rows, top, wanted).collect()  # one row per open node
            wanted = {}
            for r in found:
                if r["band"] < 0:
                    continue
                top[r["tree"]][r["node"]] = tuple(r[c] for c in ("band", "bin", "n", "positives", "gain"))
                for child, n in ((2 * r["node"], r["left"]), (2 * r["node"] + 1, r["n"] - r["left"])):
                    if n > self.local_rows and child < 1 << MAX_DEPTH:
                        wanted.setdefault(r["tree"], []).append(child)
        return top

    def _placed(self):
        """For the drawn rows of a tree their index, number of draws and node below the top."""
        seed = self.seed

        def place(ids, codes, tree, held):
            draws = _draws(ids, tree, seed)
            at = np.flatnonzero(draws)
            node = np.ones(len(at), np.int64)
            for path in sorted(held):
                here = np.flatnonzero(node == path)
                node[here] = 2 * path + (codes[at[here], held[path][0]] > held[path][1])
            return at, draws[at], node

        return place

    def _histograms(self, rows, top, wanted):
        """The best split of every wanted node: NODES and ``left``, the rows that go left."""
        seed, width, tried, place = self.seed, self.width, self.tried, self._placed()
        shape = (2, tried, BINS)

        def run(batches):
            sums = {}
            for pdf in batches:
                ids, y, codes = pdf["id"].to_numpy(), pdf["y"].to_numpy(), _unpacked(pdf["codes"], width)
                for tree, open_ in wanted.items():
                    at, draws, node = place(ids, codes, tree, top[tree])
                    for path in open_:
                        here = at[node == path]
                        w = draws[node == path]
                        cells = codes[here][:, _bands(tree, np.array([path]), seed, width, tried)[0]] + np.arange(tried) * BINS
                        held = sums.setdefault((tree, path), np.zeros(shape, np.int64))
                        for k, v in enumerate((w, w * y[here])):
                            held[k] += np.bincount(cells.ravel(), np.repeat(v, tried), tried * BINS).astype(np.int64).reshape(shape[1:])
            if sums:
                yield pd.DataFrame([(t, p, h.tobytes()) for (t, p), h in sums.items()], columns=["tree", "node", "sums"])

        def best(key, pdf):
            n, p = sum(np.frombuffer(b, np.int64).reshape(shape) for b in pdf["sums"])
            cut, gain = _gains(n.astype(float), p.astype(float))
            j = int(gain.argmax())
            band = int(_bands(key[0], np.array([key[1]]), seed, width, tried)[0][j]) if gain[j] > 0 else -1
            return pd.DataFrame([(key[0], key[1], band, cut[j], n[0].sum(), p[0].sum(), gain[j], n[j, :cut[j] + 1].sum())],
                                columns=["tree", "node", "band", "bin", "n", "positives", "gain", "left"])

        return rows.mapInPandas(run, "tree int, node bigint, sums binary").groupBy("tree", "node").applyInPandas(
            best, NODES + ", left bigint")

    def _dealt(self, rows, top):
        """Per batch, tree and node below the top one row that holds the drawn rows' codes, labels and draws."""
        width, place = self.width, self._placed()

        def run(batches):
            for pdf in batches:
                ids, y, codes, out = pdf["id"].to_numpy(), pdf["y"].to_numpy().astype(np.uint8), _unpacked(pdf["codes"], width), []
                for tree, held in top.items():
                    at, draws, node = place(ids, codes, tree, held)
                    for path in np.unique(node):
                        here = at[node == path]
                        out.append((tree, path, codes[here].tobytes(), y[here].tobytes(),
                                    draws[node == path].astype(np.uint8).tobytes()))
                    if len(out) >= 16:
                        yield pd.DataFrame(out, columns=["tree", "node", "codes", "y", "draws"])
                        out = []
                yield pd.DataFrame(out, columns=["tree", "node", "codes", "y", "draws"])

        return rows.mapInPandas(run, "tree int, node bigint, codes binary, y binary, draws binary")

    def _finish(self):
        seed, width, tried = self.seed, self.width, self.tried

        def finish(key, pdf):
            y, draws = (np.frombuffer(b"".join(pdf[c]), np.uint8) for c in ("y", "draws"))
            return grown(_unpacked(pdf["codes"], width), y, draws, key[0], key[1], seed, tried)

        return finish


def binned(df, features, edges, *extra):
    """(id, codes, extra): a row's bin in every band, one byte each; values at an edge fall below it."""
    @F.pandas_udf("binary")
    def codes(values: pd.Series) -> pd.Series:
        x = np.stack(values.to_numpy())
        out = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.uint8)
        return pd.Series([r.tobytes() for r in out])

    return df.select("id", *extra, codes(vector_to_array(features)).alias("codes"))


class DeepForestModel:
    """A written table of nodes. A tree meets the rows to score in blocks, so neither is ever held whole."""

    def __init__(self, nodes, edges, features, trees):
        self.nodes, self.edges, self.features, self.trees = nodes, edges, features, trees

    def importances(self):
        """(band from 1, importance): each tree's gains weighted by rows, normalised, and averaged over the trees."""
        gains = self.nodes.where("band >= 0").groupBy("tree", "band").agg(F.sum(F.col("n") * F.col("gain")).alias("v"))
        whole = gains.groupBy("tree").agg(F.sum("v").alias("whole"))
        shares = gains.join(whole, "tree").groupBy("band").agg(F.sum(F.col("v") / F.col("whole")).alias("v"))
        every = self.nodes.sparkSession.range(len(self.edges)).select(F.col("id").cast("int").alias("band"))
        total = F.sum("v").over(Window.partitionBy(F.lit(0)))  # one row per band
        listed = every.join(shares, "band", "left").select("band", F.coalesce("v", F.lit(0.0)).alias("v"))
        return listed.select((F.col("band") + 1).alias("band"), F.coalesce(F.try_divide("v", total), F.lit(0.0)).alias("importance"))

    def leaves(self, df):
        """(id, tree, node, share): the leaf of every row in every tree and its share of positives."""
        width = len(self.edges)
        blocks = max(1, -(-df.count() // SCORE_ROWS))
        every = F.sequence(F.lit(0), F.lit(self.trees - 1))
        rows = binned(df, self.features, self.edges).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))

        def pack(batches):
            for pdf in batches:
                out = [(b, g["id"].to_numpy().astype(np.int64).tobytes(), b"".join(g["codes"])) for b, g in pdf.groupby("block")]
                yield pd.DataFrame(out, columns=["block", "ids", "codes"])

        packed = rows.mapInPandas(pack, "block int, ids binary, codes binary").withColumn("tree", F.explode(every))
        trees = self.nodes.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

        def walk(key, rows, nodes):
            ids = np.frombuffer(b"".join(rows["ids"]), np.int64)
            if nodes.empty:  # no row was drawn for the tree
                return pd.DataFrame({"id": [], "tree": [], "node": [], "share": []})
            nodes = nodes.sort_values("node")
            at = _walked(_unpacked(rows["codes"], width), *(nodes[c].to_numpy() for c in ("node", "band", "bin")))
            share = (nodes["positives"] / nodes["n"]).to_numpy()
            return pd.DataFrame({"id": ids, "tree": np.int32(key[0]), "node": nodes["node"].to_numpy()[at], "share": share[at]})

        return packed.groupBy("tree", "block").cogroup(trees.groupBy("tree", "block")).applyInPandas(
            walk, "id bigint, tree int, node bigint, share double")

    def transform(self, df):
        prob = self.leaves(df).groupBy("id").agg(F.avg("share").alias("prob"))
        return df.join(prob, "id").withColumn("pred_label", (F.col("prob") > K.DEFAULT_TAU).cast("int"))

