"""Neighbour joins: work units bounded in number and memory."""

import tracemalloc

import numpy as np

from bandlore.operators import neighbors as N


def test_small_blocks_of_a_large_table_are_merged():
    """Pieces of 40 and 30 rows of 80,000 and 20,000 rows in 32 blocks would be 1.3 million."""
    sizes, wanted = dict.fromkeys(range(32), 2_500), dict.fromkeys(range(32), 20_000)
    train, query = N._block_sizes(sizes, wanted, 40, 30)
    assert sum(-(-sizes[c] // train) * -(-wanted[c] // query) for c in sizes) <= N.MOST_PIECES
    assert train <= N.TRAIN_BLOCK and query <= N.QUERY_BLOCK
    assert N._block_sizes({0: 100}, {0: 90}, 40, 30) == (40, 30)
    huge = dict.fromkeys(range(1_000), 1_000_000)
    assert N._block_sizes(huge, huge, 40, 30) == (N.TRAIN_BLOCK, N.QUERY_BLOCK)


def test_city_block_screen_is_exact():
    """Single precision screens, the result is that of exact distances: near ties, far offsets, extreme values."""
    rng = np.random.default_rng(4)
    for offset, scale in ((0.0, 1.0), (1e4, 1e-3), (0.0, 1e200), (0.0, 1e-42)):
        t = offset + scale * np.round(rng.normal(size=(700, 9)), 2)
        q = offset + scale * np.round(rng.normal(size=(40, 9)), 2)
        i, j, d = N._block_top_k(q, t, np.arange(700), 6, "manhattan")
        every = np.abs(q[:, None] - t[None]).sum(2)
        want = np.take_along_axis(every, np.argsort(every, axis=1, kind="stable")[:, :6], 1)
        assert (i == np.repeat(np.arange(40), 6)).all()
        np.testing.assert_allclose(d.reshape(40, 6), want, rtol=1e-12)


def test_memory_of_a_piece():
    """A piece's work space does not follow the product of its sides."""
    rng = np.random.default_rng(5)
    q, t = rng.normal(size=(600, 60)), rng.normal(size=(20_000, 60))
    tracemalloc.start()
    try:
        N._block_top_k(q, t, np.arange(len(t)), 5, "euclidean")
        assert tracemalloc.get_traced_memory()[1] < 80e6
    finally:
        tracemalloc.stop()


def test_bits_and_probes_follow_the_rows(spark, monkeypatch):
    """On rows without structure small buckets miss neighbours; the choice by a sample still finds nine in ten."""
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(3_000, 40))
    train = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(rows[:2_700])], "id bigint, features array<double>, y int")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows[2_700:])], "id bigint, features array<double>")
    exact = N.nearest_neighbors(asked, train, 5).cache()
    monkeypatch.setattr(N, "BUCKET", 5)
    small = N.approximate_neighbors(asked, train, 5, bits=10, probes=2)
    assert N.recall(small, exact).head().recall < 0.9
    assert N.recall(N.approximate_neighbors(asked, train, 5), exact).head().recall >= 0.9
