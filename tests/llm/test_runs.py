"""Periodic runs against a search of every period, and the query against a plain version of its contract."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from bandlore.llm import runs as M
from bandlore.llm.queries import QUERIES


def brute(words, least=24, times=3):
    """All stretches in which words q apart are equal, of every q; the smallest q of each stretch."""
    words, found = np.asarray(words), {}
    n = len(words)
    for q in range(1, n // times + 1):
        same = np.concatenate(([False], words[q:] == words[:-q], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a + q >= max(least, times * q):
                found.setdefault((a, b - a + q), q)
    return sorted((a, n, q) for (a, n), q in found.items())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=4), st.integers(1, 12))
def test_small_alphabets(texts, least):
    arrays = [np.array(t, np.int64) for t in texts]
    assert M.found_runs(arrays, least) == [brute(t, least) for t in arrays]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 9)), max_size=8))
def test_repeated_blocks(blocks):
    words = np.array([w for block, n in blocks for w in block * n], np.int64)
    assert M.found_runs([words, words[::-1]]) == [brute(words), brute(words[::-1])]


def test_long_texts():
    rng = random.Random(3)
    texts = [[0] * 20_000, [0, 1] * 5_000 + [0, 2] * 5_000,
             [k for _ in range(40) for k in (*range(20), *rng.sample(range(100, 900), 5))],
             [rng.randrange(2) for _ in range(3_000)] * 4]
    arrays = [np.array(t, np.int64) for t in texts]
    got = M.found_runs(arrays)
    assert got[0] == [(0, 20_000, 1)] and got[1] == [(0, 10_001, 2), (10_000, 10_000, 2)]
    assert got[2:] == [brute(t) for t in arrays[2:]] and (0, 12_000, 3_000) in got[3]


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    known = {}
    runs = brute([known.setdefault(w, len(known)) for w in words])
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    gone = {k for start, length, q in runs for k in range(start + q, start + length)}
    left = b" ".join(w for k, w in enumerate(words) if k not in gone)
    return (len(runs), *best, best[1] and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(left).hexdigest())


def test_query_over_documents(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op11_periodic_runs"](spark, small).collect()
    assert len(rows) == len(docs) and sum(r.n_runs > 0 for r in rows) > 50
    for r in rows:
        assert tuple(r)[1:] == expected(r.doc_id, docs[r.doc_id]), r.doc_id


def test_edges(spark):
    """Nulls, empty and long texts, repeated rows, clashing columns, an empty table."""
    line = "one two three four "
    rows = [(None, None, 1, "x"), (1, None, 1, "x"), (2, "", 1, "x"), (3, " \t\n", 1, "x"), (4, line * 6, 1, "x"),
            (4, line * 6, 1, "x"), (None, line * 6, 1, "x"), (5, "é " * 50_000, 1, "x"), (5, "other " + line * 5, 1, "x"),
            (6, "\u00a0 \u2003 " * 30, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int, collapsed string")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in M.periodic_runs(docs).collect()]
    four = line.strip()
    assert sorted(got, key=str) == sorted([
        (None, 0, [], ""), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 24, [(0, 24, 4)], four),
        (4, 24, [(0, 24, 4)], four), (None, 24, [(0, 24, 4)], four), (5, 50_000, [(0, 50_000, 1)], "é"),
        (5, 21, [], "other " + (line * 5).strip()), (6, 60, [(0, 60, 2)], "\u00a0 \u2003")], key=str)
    planted = M.with_periods(docs)
    assert planted.columns == docs.columns and planted.count() == len(rows)
    assert M.periodic_runs(docs.where("false")).count() == 0
