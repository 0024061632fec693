"""Forests grown in tasks: the same trees however the work is cut, splits as by brute force, nothing of them in the driver."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from bandlore.operators import deep_forests as D
from bandlore.operators import evaluate as E
from bandlore.operators import models as M


@pytest.fixture(scope="module")
def rows(signals):
    return signals.select("id", (F.col("label") == "M").cast("int").alias("y"), array_to_vector("features").alias("scaled")).cache()


def _nodes(model):
    return sorted((r.tree, r.node, r.band, r.bin, r.n, r.positives, round(r.gain, 9)) for r in model.nodes.collect())


def test_cut_of_the_work_changes_no_tree(rows):
    """Nodes grown by histograms over all tasks and by one task are the same."""
    assert _nodes(D.DeepForest(trees=4, local_rows=30).fit(rows)) == _nodes(D.DeepForest(trees=4).fit(rows.repartition(7)))


def test_subtree_against_brute_force():
    rng = np.random.default_rng(3)
    codes, draws = rng.integers(0, 6, (90, 4)).astype(np.uint8), rng.integers(1, 4, 90)
    y = (codes.sum(1) + rng.integers(0, 5, 90) > 12).astype(int)
    table = D.grown(codes, y, draws, 0, 1, 7, 4).set_index("node")

    def impurity(at):
        p = (draws * y)[at].sum() / draws[at].sum()
        return 2 * p * (1 - p) * draws[at].sum()

    def check(path, at):
        node = table.loc[path]
        assert (node.n, node.positives) == (draws[at].sum(), (draws * y)[at].sum())
        gains = [impurity(at) - impurity(at & (codes[:, b] <= c)) - impurity(at & (codes[:, b] > c))
                 for b in range(4) for c in range(5) if 0 < (at & (codes[:, b] <= c)).sum() < at.sum()]
        if node.band < 0:
            assert not gains or max(gains) < 1e-9
            return 1
        assert node.gain * node.n == pytest.approx(max(gains))
        left = codes[:, int(node.band)] <= node.bin
        return 1 + check(2 * path, at & left) + check(2 * path + 1, at & ~left)

    assert check(1, np.ones(90, bool)) == len(table)


def test_forest_scores_and_importances(rows):
    train, test = rows.where("id % 4 > 0"), rows.where("id % 4 = 0")
    model = D.DeepForest(trees=40).fit(train)
    scored = M.with_scores(model, test, "m")
    assert scored.count() == test.count() and E.roc_auc(scored).head()["roc_auc"] > 0.75
    listed = M.tree_importance(model).collect()
    assert len(listed) == 60 and sum(r.importance for r in listed) == pytest.approx(1.0)
    assert {r.band for r in listed[:2]} == {11, 12}
    assert model.leaves(test).count() == 40 * test.count()


def test_one_class(rows):
    """Without a split every tree is a leaf and no band matters."""
    model = D.DeepForest(trees=3).fit(rows.where("y = 1"))
    assert M.with_scores(model, rows).agg(F.min("prob")).head()[0] == 1.0
    assert M.tree_importance(model).agg(F.sum("importance")).head()[0] == 0.0
