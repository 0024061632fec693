"""Fitted-model queries. Only the neighbour queries have a portable SQL form."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from bandlore import constants as K
from bandlore.operators import ensemble as EN
from bandlore.operators import evaluate as E
from bandlore.operators import explain as X
from bandlore.operators import models as M
from bandlore.operators import neighbors as N
from bandlore.operators import training as T
from bandlore.operators.scaling import BandScaler, BandScalerModel
from bandlore.plans.registry import FITTED, query, rounded
from bandlore.session import scratch_path
from bandlore.sources import sinks
from bandlore.streaming import score_stream as ST


def _prepared(t):
    """(training rows with folds, test rows), scaled by the training rows."""
    from pyspark.ml.functions import vector_to_array

    folded, test = t.folded(), t.parts()[1]
    scaler = BandScaler().fit(folded)
    add = lambda df: scaler.transform(df).withColumn("scaled_array", vector_to_array("scaled"))
    return add(folded), add(test)


def _scores(model, test, name):
    return M.with_scores(model, test, name).select("model", "id", "y", "prob", "pred_label")


_NEAR = """pd AS (SELECT a.id, b.id AS neighbor, b.y AS ny, {dist} AS d FROM slong a JOIN slong b USING (band)
WHERE a.split = 'test' AND b.split = 'train' GROUP BY a.id, b.id, b.y),
nn AS (SELECT id, neighbor, ny, d, row_number() OVER (PARTITION BY id ORDER BY d, neighbor) AS rank FROM pd)"""
_EUCLID = f"WITH {FITTED}, " + _NEAR.format(dist="sqrt(sum((a.x - b.x)*(a.x - b.x)))")
_CITY = f"WITH {FITTED}, " + _NEAR.format(dist="sum(abs(a.x - b.x))")


def _near(t, k, metric="euclidean", **options):
    train, test = t.parts()
    return N.nearest_neighbors(test.select("id", "features"), train.select("id", "features", "y"), k, metric, **options)


@query("j4_nearest_neighbors", f"{_EUCLID} SELECT id, neighbor, ny AS y, rank, round(d, 6) AS distance FROM nn WHERE rank <= 5")
def _(t):
    return rounded(_near(t, 5))


@query("j4_nearest_neighbors_manhattan", f"{_CITY} SELECT id, neighbor, ny AS y, rank, round(d, 6) AS distance FROM nn WHERE rank <= 4")
def _(t):
    # small blocks, so that cells and queries are spread over several tasks
    return rounded(_near(t, 4, "manhattan", train_block=40, query_block=30))


@query("m4_approximate_neighbors", f"""WITH {FITTED} SELECT count(*) FILTER (WHERE split = 'test') AS queries,
5*count(*) FILTER (WHERE split = 'test') AS pairs, true AS recall_reached FROM sp""")
def _(t):
    """Queries and exact pairs of the test rows, and whether the bucket join finds nine in ten of the pairs."""
    train, test = t.parts()
    found = N.approximate_neighbors(test.select("id", "features"), train.select("id", "features", "y"), 5)
    return N.recall(found, _near(t, 5)).select("queries", "pairs", (F.col("recall") >= 0.9).alias("recall_reached"))


@query("m4_knn_distance_vote", f"""{_EUCLID} SELECT id, round(CASE WHEN sum(CASE WHEN d = 0 THEN 1 ELSE 0 END) > 0
THEN avg(ny) FILTER (WHERE d = 0) ELSE sum(ny/d)/sum(1/d) END, 6) AS prob FROM nn WHERE rank <= 5 GROUP BY id""")
def _(t):
    return rounded(N.vote(_near(t, 5), 5, "distance"))


@query("m4_knn_uniform_vote", f"{_EUCLID} SELECT id, round(avg(ny), 6) AS prob FROM nn WHERE rank <= 7 GROUP BY id")
def _(t):
    return rounded(N.vote(_near(t, 7), 7, "uniform"))


@query("m5_logistic_regression")
def _(t):
    train, test = _prepared(t)
    return _scores(M.logistic(train.count()).fit(train), test, M.LOGISTIC)


@query("m6_kernel_svm")
def _(t):
    train, test = _prepared(t)
    return _scores(M.KernelSvm(folds=3, iterations=30).fit(train), test, M.SVM)


@query("m7_random_forest")
def _(t):
    train, test = _prepared(t)
    return _scores(M.forest(trees=50, depth=10).fit(train), test, M.FOREST)


@query("m9_perceptron")
def _(t):
    train, test = _prepared(t)
    return _scores(M.perceptron(iterations=60).fit(train), test, M.MLP)


@query("m9b_training_loss")
def _(t):
    train, _ = _prepared(t)
    return M.training_loss(M.perceptron(iterations=30).fit(train))


@query("m11_stacking")
def _(t):
    train, test = _prepared(t)
    makers = {M.LOGISTIC: M.logistic, M.FOREST: M.forest(trees=10, depth=5)}
    return _scores(EN.StackingModel(makers, 3).fit(train.withColumn("fold", F.col("fold") % 3)), test, EN.STACKING)


@query("m10_voting_models")
def _(t):
    train, test = _prepared(t)
    makers = {M.LOGISTIC: M.logistic, M.FOREST: M.forest(trees=20, depth=5)}
    return _scores(EN.VotingModel(makers).fit(train), test, EN.VOTING)


@query("m13_cross_validation")
def _(t):
    train, _ = _prepared(t)
    return T.cross_validate({M.LOGISTIC: M.logistic}, train)


@query("m14_grid_search")
def _(t):
    train, test = _prepared(t)
    best, f1, model = T.search(train, M.LOGISTIC, {"c": [0.05, 1.0], "solver": ["lbfgs"]}, 5)
    scored = _scores(model, test, f"c={best['c']}")
    return E.classification_metrics(scored).withColumn("cv_f1", F.lit(f1))


@query("j5_grid_sizes")
def _(t):
    # every setting of the full grid, with the training rows each fit would read
    rows = t.folded().agg(F.count(F.lit(1)).alias("training_rows"))
    listed = [(n, len(T.settings(g))) for n, g in T.grids("full").items()]
    sizes = F.array(*[F.struct(F.lit(n).alias("model"), F.lit(c).alias("settings")) for n, c in listed])
    return rows.select("training_rows", F.explode(sizes).alias("s")).select("s.*", "training_rows")


@query("m15_learning_curve")
def _(t):
    train, _ = _prepared(t)
    return T.learning_curve(M.logistic, train, (0.5, 1.0), 5)


@query("m16_train_and_compare")
def _(t):
    train, _ = _prepared(t)
    makers = {M.LOGISTIC: M.logistic, M.FOREST: M.forest(trees=20, depth=5)}
    _, table, _ = T.train_and_compare(train.where("fold <> 0"), train.where("fold = 0"), makers)
    return table


@query("s14_saved_models")
def _(t):
    train, test = _prepared(t)
    model = M.logistic(train.count()).fit(train)
    path = scratch_path(t.spark, "models")
    saved = sinks.save_models({M.LOGISTIC: model}, path, champion=M.LOGISTIC)
    scaler = BandScaler().fit(t.folded())
    scaler.write().overwrite().save(f"{path}/scaler")
    again = BandScalerModel.load(f"{path}/scaler").transform(test.drop("scaled", "scaled_array"))
    return _scores(LogisticRegressionModel.load(saved["best"]), again, "best")


@query("k4_score_models")
def _(t):
    train, test = _prepared(t)
    fitted = {M.LOGISTIC: M.logistic(train.count()).fit(train), M.FOREST: M.forest(trees=20, depth=5).fit(train)}
    return M.score_models(test, fitted).select("model", "id", "y", "prob", "pred_label")


@query("x1_tree_importance")
def _(t):
    train, _ = _prepared(t)
    return M.tree_importance(M.forest(trees=20, depth=5).fit(train), 15)


def _inputs(df):
    return df.select("id", "y", F.col("scaled_array").alias("features"))


@query("x2_model_permutation_importance")
def _(t):
    train, test = _prepared(t)
    model = M.logistic(train.count()).fit(train)
    return X.top_bands(X.permutation_importance(model, _inputs(test), 5), "mean_importance")


@query("x3_sampled_shapley")
def _(t):
    train, test = _prepared(t)
    model = M.logistic(train.count()).fit(train)
    return X.shapley_sampling(model, _inputs(test), X.background_rows(_inputs(train), 5), 1)


@query("x4_fast_attribution")
def _(t):
    train, test = _prepared(t)
    model = M.logistic(train.count()).fit(train)
    centres = X.kmeans_background(train, 8, features="scaled_array")
    attr = X.phi_arrays(X.shapley_sampling(model, _inputs(test), centres, 1)).join(_inputs(test), "id")
    return X.top_drivers(attr)


@query("x6_explanation_job")
def _(t):
    from bandlore.plans.modelling import run_explanation

    train, test = _prepared(t)
    model = M.logistic(train.count()).fit(train)
    both = train.drop("fold").unionByName(test)
    out = run_explanation(both, model, repeats=2, background=2, permutations=1)
    return out["shapley"].join(out["permutation"].select("band", "mean_importance"), "band", "left")


@query("k3_stream_model_scoring")
def _(t):
    from pyspark.ml.functions import vector_to_array  # noqa: F401

    scaler = BandScaler().fit(t.folded())
    model = M.logistic(t.folded().count()).fit(scaler.transform(t.folded()))
    path = scratch_path(t.spark, "arrivals")
    t.signals().select("id", "features").repartition(4).write.parquet(path)
    source = ST.read_vector_stream(t.spark, path, "id bigint, features array<double>")
    scorer = ST.model_scorer(PipelineModel([scaler, model]))
    return t.spark.read.parquet(ST.run_available(source, scorer, K.SAFE_TAU, scratch_path(t.spark, "stream"))[0]).drop("batch")
