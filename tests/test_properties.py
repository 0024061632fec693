"""Properties and brute-force checks, with set numbers of ranges and blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bandlore.operators import evaluate as E
from bandlore.operators import explain as X
from bandlore.operators import linear as L
from bandlore.operators import neighbors as N
from bandlore.operators import profile as P
from bandlore.operators import sampling as SA
from bandlore.operators import scaling as SC
from bandlore.operators.ordered import Ranged
from bandlore.operators.quantiles import exact_quantiles


def test_density_brute_force(spark):
    """Two classes, one far outlier, a class of one value."""
    rng = np.random.default_rng(11)
    rows = [("M", float(v)) for v in (*rng.normal(0, 1, 700), 60.0)] + [("R", float(v)) for v in rng.exponential(2, 300)]
    rows += [("S", 1.0)] * 5
    df = spark.createDataFrame([([v], label) for label, v in rows], "features array<double>, label string")
    got = {(r.label, r.point): (r.value, r.density) for r in P.class_density(df, [1]).collect()}
    every = np.array([v for _, v in rows])
    assert len(got) == 400
    for label in "MR":
        x = np.array([v for other, v in rows if other == label])
        h = x.std(ddof=1) * len(x) ** -0.2
        for point, t in enumerate(np.linspace(every.min(), every.max(), 200)):
            want = np.exp(-0.5 * ((t - x) / h) ** 2).sum() / (len(x) * h * np.sqrt(2 * np.pi))
            value, density = got[label, point]
            assert value == pytest.approx(t) and density == pytest.approx(want, abs=1e-10)


def _values(spark, n=4000, seed=1):
    rng = np.random.default_rng(seed)
    # a third of the rows share one value
    x = np.where(rng.random(n) < 0.33, 0.25, rng.normal(size=n))
    g = np.where(rng.random(n) < 0.8, "a", "b")
    return spark.createDataFrame([(str(a), float(b)) for a, b in zip(g, x)], "g string, x double"), g, x


@pytest.mark.parametrize("bound", [None, 1, 7])
def test_quantiles(spark, bound):
    df, g, x = _values(spark)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r.g: r.q for r in exact_quantiles(df, ["g"], "x", probs, ranges=bound).collect()}
    for k in ("a", "b"):
        assert got[k] == pytest.approx(np.quantile(x[g == k], probs).tolist())


def test_quantiles_of_extreme_values(spark):
    inf = float("inf")
    x = [-inf, inf, 5e-324, 0.0, 1e308, -1e308, 1e-300] * 5 + [float(i) for i in range(100)] + [7.0] * 200
    df = spark.createDataFrame([("a", v) for v in x], "g string, x double")
    probs = [0.01, 0.05, 0.2, 0.5, 0.9, 0.95]
    small = exact_quantiles(df, ["g"], "x", probs).head()
    found = exact_quantiles(df, ["g"], "x", probs, ranges=5).head()
    at = [p * (len(x) - 1) for p in probs]
    lows = [sorted(x)[int(a)] for a in at]
    assert all(v >= low for v, low in zip(found.q, lows) if v == v)
    assert found.q[2:5] == pytest.approx(small.q[2:5])
    assert found.q[0] == -inf


@pytest.mark.parametrize("bound", [None, 1, 9])
def test_running_sums_and_next(spark, bound):
    df, g, x = _values(spark)
    rows = df.withColumn("id", F.monotonically_increasing_id()).withColumn("w", F.lit(2))
    ranged = Ranged(rows, ["g"], [F.col("x"), F.col("id")], bound).add_next(["x"])
    got = ranged.running({"s": "w"}).collect()
    for k in ("a", "b"):
        part = sorted((r for r in got if r.g == k), key=lambda r: (r.x, r.id))
        assert [r.s for r in part] == [2 * (i + 1) for i in range(len(part))]
        assert [r.next_x for r in part] == [r.x for r in part[1:]] + [None]
    place = Ranged(rows, ["g"], [F.col("x"), F.col("id")], bound).positions()
    assert sorted(r.position for r in place.where("g = 'b'").collect()) == list(range(int((g == "b").sum())))


def test_running_sums_have_no_second_exchange(spark):
    """Many groups and none, small batches, nulls, and a plan that reads the written ranges without shuffling them."""
    rows = [(i % 3 if i % 7 else None, i % 50, float(i)) for i in range(900)]
    df = spark.createDataFrame(rows, "g int, v int, w double").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        for by, ranges in (([], 8), (["g"], 8), (["g"], None), (["w"], 6)):
            ranged = Ranged(df, by, [F.col("w")], ranges).add_next(["v"]).running({"s": "v", "t": "w"})
            assert "Exchange hashpartitioning" not in ranged._jdf.queryExecution().executedPlan().toString()
            groups = {}
            for r in sorted(ranged.collect(), key=lambda r: r.w):
                groups.setdefault(tuple(r[c] for c in by), []).append(r)
            assert sum(map(len, groups.values())) == 900
            for found in groups.values():
                assert [r.s for r in found] == np.cumsum([r.v for r in found]).tolist()
                assert [r.t for r in found] == pytest.approx(np.cumsum([r.w for r in found]).tolist())
                assert [r.next_v for r in found] == [r.v for r in found[1:]] + [None]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert Ranged(df.where("false"), ["g"], [F.col("w")]).running({"s": "v"}).count() == 0


@pytest.mark.parametrize("bound", [None, 6])
def test_auc_brute_force(spark, bound):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 3000)
    p = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)
    df = spark.createDataFrame([("m", int(a), float(b)) for a, b in zip(y, p)], "model string, y int, prob double")
    pos, neg = p[y == 1], p[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert E.roc_auc(df, ranges=bound).head()["roc_auc"] == pytest.approx(want)
    curve = sorted((r.fpr, r.tpr) for r in E.roc_curve(df, ranges=6).collect())
    assert curve[0] == (0, 0) and curve[-1] == (1, 1)
    assert all(a[1] <= b[1] for a, b in zip(curve, curve[1:]))


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_neighbors_brute_force(spark, metric):
    rng = np.random.default_rng(5)
    t = np.vstack([rng.normal(size=(300, 6)), np.tile(rng.normal(size=6), (150, 1)), rng.normal(4, 0.3, (150, 6))])
    q = np.vstack([rng.normal(size=(60, 6)), t[300:301], t[460:480]])
    train = spark.createDataFrame([(i, v.tolist(), int(i % 2)) for i, v in enumerate(t)],
                                  "id bigint, features array<double>, y int")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "id bigint, features array<double>")
    got = {}
    for r in N.nearest_neighbors(asked, train, 7, metric, n_pivots=8, train_block=40, query_block=25).collect():
        got.setdefault(r.id, {})[r["rank"]] = (r.neighbor, r.distance)
    for i, v in enumerate(q):
        d = np.sqrt(((t - v) ** 2).sum(1)) if metric == "euclidean" else np.abs(t - v).sum(1)
        order = np.lexsort((np.arange(len(t)), d))[:7]
        assert [got[i][k + 1][0] for k in range(7)] == order.tolist()
        assert [got[i][k + 1][1] for k in range(7)] == pytest.approx(d[order].tolist())


def test_neighbor_blocks_are_visited_only_where_asked(spark):
    """On grouped rows few blocks are visited, and rows of a block are sent once however many queries ask elsewhere."""
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 20, (20, 12))
    t = np.vstack([c + rng.normal(0, 0.5, (60, 12)) for c in centres])
    train = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(t)], "id bigint, features array<double>, y int")
    q = np.vstack([centres[0] + rng.normal(0, 0.5, (400, 12)), centres[1:4] + 0.1])
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "id bigint, features array<double>")
    assert N.visited_share(asked, train, 5, n_pivots=40) < 0.3
    got = N.nearest_neighbors(asked, train, 5, n_pivots=40, train_block=30, query_block=50).collect()
    assert len(got) == 5 * len(q)
    for r in got:
        d = np.sort(((t - q[r.id]) ** 2).sum(1))[:5]
        assert r.distance == pytest.approx(d[r["rank"] - 1] ** 0.5)
    blocks = N.Blocks(train, "euclidean", 40, 30)
    sent = []
    blocks_compared = N._compared
    try:
        N._compared = lambda left, right, keys, k, metric: sent.append(right) or blocks_compared(left, right, keys, k, metric)
        home = asked.select("id", "features", F.explode(blocks.home(5)("features")).alias("cell"))
        for part in (home.where("id >= 400"), home):
            blocks.compared(part, 5, 50)
    finally:
        N._compared = blocks_compared
    few, many = ({r.neighbor: r["count"] for r in s.groupBy("neighbor").count().collect()} for s in sent)
    assert set(few.values()) == {1} and all(many[i] == 1 for i in few)
    assert max(many.values()) > 1


def test_approximate_neighbors(spark, signals):
    rows = signals.withColumn("y", F.lit(1))
    exact = N.nearest_neighbors(rows.select("id", "features"), rows, 5)
    found = N.approximate_neighbors(rows.select("id", "features"), rows, 5, bits=2, train_block=60, query_block=70)
    score = N.recall(found, exact).head()
    assert score.queries == rows.count() and score.pairs == 5 * score.queries and score.recall >= 0.9
    measured = {(r.id, r.neighbor): r.distance for r in exact.collect()}
    assert all(measured.get((r.id, r.neighbor), r.distance) == pytest.approx(r.distance) for r in found.collect())


def test_exact_match_neighbor_votes_alone(spark):
    train = spark.createDataFrame([(0, [0.0, 0.0], 1), (1, [0.1, 0.0], 0), (2, [0.0, 0.1], 0)],
                                  "id bigint, features array<double>, y int")
    asked = spark.createDataFrame([(9, [0.0, 0.0])], "id bigint, features array<double>")
    near = N.nearest_neighbors(asked, train, 3)
    assert N.vote(near, 3, "distance").head()["prob"] == 1.0
    assert N.vote(near, 3, "uniform").head()["prob"] == pytest.approx(1 / 3)
    with pytest.raises(ValueError):
        N.vote(near, 3, "other")


def test_neighbors_of_a_table_in_itself(signals):
    rows = signals.withColumn("y", F.lit(1))
    near = N.nearest_neighbors(rows.select("id", "features"), rows, 1)
    assert near.where("id <> neighbor OR distance <> 0").count() == 0


def test_folds_are_balanced_and_complete(signals):
    folds = SA.stratified_folds(signals.withColumn("y", (F.col("label") == "M").cast("int")), 5)
    sizes = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1 and sum(sizes) == signals.count()
    per_class = [r["count"] for r in folds.where("y = 1").groupBy("fold").count().collect()]
    assert max(per_class) - min(per_class) <= 1


def test_prefixes_nest(signals):
    folds = SA.stratified_folds(signals.withColumn("y", (F.col("label") == "M").cast("int")), 5)
    pre = SA.learning_prefixes(folds.select("id", "y", "fold"))
    assert pre.where("held = fold").count() == 0
    for r in pre.groupBy("held").agg(*[F.count_if(F.col("step") <= s).alias(f"s{s}") for s in range(5)]).collect():
        assert [r[f"s{s}"] for s in range(5)] == [80, 160, 240, 320, 400]


def test_approximate_split_share(spark):
    share = SA.split_rows_approx(spark.range(20000)).agg(F.avg((F.col("split") == "test").cast("double"))).head()[0]
    assert share == pytest.approx(0.2, abs=0.01)


@pytest.mark.parametrize("kind", ["standard", "minmax"])
def test_scaler_model_equals_table_form(signals, kind, tmp_path):
    from pyspark.ml.functions import vector_to_array

    model = SC.BandScaler(kind=kind).fit(signals)
    path = str(tmp_path / "scaler")
    model.write().overwrite().save(path)
    again = SC.BandScalerModel.load(path)
    a = again.transform(signals).select("id", vector_to_array("scaled").alias("a"))
    b = SC.scale_features(signals, SC.band_scales(signals, kind)).select("id", "scaled")
    gap = a.join(b, "id").select(F.array_max(F.zip_with("a", "scaled", lambda x, z: F.abs(x - z))).alias("g"))
    assert gap.agg(F.max("g")).head()[0] < 1e-12
    back = again.inverse(again.transform(signals).withColumn("s", vector_to_array("scaled")), "s", "back")
    gap = back.select(F.array_max(F.zip_with("features", "back", lambda x, z: F.abs(x - z))).alias("g"))
    assert gap.agg(F.max("g")).head()[0] < 1e-12


def test_permutation_blocks_cover_all_rows(signals):
    rows = signals.select("id", F.lit(1).alias("y"), "features")
    pairs = X.permuted_pairs(rows, 3, block_rows=100)
    for r in (1, 2, 3):
        part = pairs.where(F.col("repeat") == r)
        donors = part.select("donor").distinct().count()
        assert part.count() == donors == signals.count()
        assert part.where(F.col("features") == F.col("donor")).count() == 0


@pytest.mark.parametrize("block_rows", [100, 4000])
def test_permutation_importance_brute_force(signals, block_rows):
    fitted = L.fit_mean_difference(signals)
    rows = signals.withColumn("y", (F.col("label") == "M").cast("int"))
    got = {r.band: r for r in X.linear_permutation_importance(rows, fitted, 4, block_rows=block_rows).collect()}
    p = fitted.head()["p"]
    c, w = np.array(p["centre"]), np.array(p["weight"])
    pairs = X.permuted_pairs(rows, 4, block_rows=block_rows).toPandas()
    x, d = np.stack(pairs["features"]), np.stack(pairs["donor"])

    def f1(y, hit):
        tp = (y & hit).sum()
        return 2 * tp / (2 * tp + (~y & hit).sum() + (y & ~hit).sum())

    for band in (1, 11, 36, 60):
        z = x.copy()
        z[:, band - 1] = d[:, band - 1]
        per = []
        for r in range(1, 5):
            at = (pairs["repeat"] == r).to_numpy()
            y = pairs["y"].to_numpy()[at] == 1
            per.append(f1(y, ((x[at] - c) @ w) >= 0) - f1(y, ((z[at] - c) @ w) >= 0))
        assert got[band].mean_importance == pytest.approx(np.mean(per))
        assert got[band].std_importance == pytest.approx(np.std(per))


def test_linear_shapley_adds_up(signals):
    fitted = L.fit_mean_difference(signals)
    phi = X.linear_shapley(signals.select("id", "features"), fitted, signals)
    total = phi.select("id", F.aggregate("phi", F.lit(0.0), lambda a, v: a + v).alias("t"))
    margins = L.margin(signals, fitted).select("id", "margin")
    mean = margins.agg(F.avg("margin")).head()[0]
    worst = total.join(margins, "id").agg(F.max(F.abs(F.col("t") - (F.col("margin") - mean)))).head()[0]
    assert worst < 1e-12


def test_duplicates_brute_force(spark):
    rng = np.random.default_rng(9)
    hot = rng.normal(size=4).tolist()
    rows = [(i, hot if i % 3 == 0 else rng.integers(0, 3, 4).astype(float).tolist(), "M" if i % 2 else "R")
            for i in range(600)]
    rows[5] = (5, [float("nan")] * 4, "M")
    rows[7] = (7, [float("nan")] * 4, "M")
    df = spark.createDataFrame(rows, "id bigint, features array<double>, label string")
    seen, want = set(), set()
    for i, f, lab in rows:
        key = (str(f), lab)
        if key in seen:
            want.add(i)
        seen.add(key)
    assert {r.id for r in P.duplicate_rows(df).collect()} == want
    assert P.duplicate_audit(df).head()["num_duplicates"] == len(want)


def test_size_does_not_change_results(spark):
    """A table and its 20-fold repeat with new ids have the same quantiles at ranks they share, and the same AUC."""
    df, _, x = _values(spark, 301)
    many = df.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("k")
    probs = [0.0, 1.0]
    a, b = ({r.g: list(r.q) for r in exact_quantiles(d, ["g"], "x", probs).collect()} for d in (df, many))
    assert a == b
    scored = df.select(F.lit("m").alias("model"), F.col("x").alias("prob"), (F.col("g") == "a").cast("int").alias("y"))
    twenty = scored.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("k")
    assert E.roc_auc(scored).head()["roc_auc"] == pytest.approx(E.roc_auc(twenty).head()["roc_auc"], abs=1e-12)


def test_quantiles_of_log_uniform_values(spark):
    x = 10.0 ** np.random.default_rng(4).uniform(-300, 300, 4000)
    df = spark.createDataFrame([("a", float(v)) for v in x], "g string, x double")
    probs = [0.1, 0.37, 0.5, 0.9]
    got = exact_quantiles(df, ["g"], "x", probs, ranges=3).head()["q"]
    assert list(got) == pytest.approx(np.quantile(x, probs).tolist(), rel=1e-9)


@pytest.mark.parametrize("rows", [1, 2, 8, 15, 16, 40])
def test_shifts_do_not_repeat(spark, rows):
    shifts = [X.shift_of(r, rows) for r in range(1, 16)]
    assert len(set(shifts)) == min(15, max(rows - 1, 1))
    assert all(s % rows for s in shifts) or rows == 1
    df = spark.createDataFrame([(i, 1, [float(i)]) for i in range(rows)], "id bigint, y int, features array<double>")
    pairs = X.permuted_pairs(df, 15).collect()
    assert len(pairs) == 15 * rows
    for r in range(1, 16):
        assert len({p.donor[0] for p in pairs if p.repeat == r}) == rows


def test_blocks_change_no_donor(signals):
    rows = signals.select("id", F.lit(1).alias("y"), "features")
    one, many = ({(p.id, p.repeat): p.donor for p in X.permuted_pairs(rows, 3, block_rows=b).collect()} for b in (4096, 60))
    assert one == many
