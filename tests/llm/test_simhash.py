"""SimHash near-duplicates against a brute-force version."""

import random
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from bandlore.llm import simhash as M

DOCS = "doc_id long, text string"


def brute_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, budget=2):
    group = {p: p for p in prints}

    def root(p):
        while group[p] != p:
            p = group[p]
        return p

    for p in prints:
        for q in prints:
            if (p ^ q).bit_count() <= budget:
                group[max(root(p), root(q))] = min(root(p), root(q))
    return {p: root(p) for p in prints}


def signed(p):
    return p - (1 << 64) if p >> 63 else p


def test_documents_match_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = {r.doc_id: brute_print(r.text) for r in rows}
    root = brute_components(set(prints.values()))
    low = {}
    for i, p in prints.items():
        low[root[p]] = min(low.get(root[p], i), i)
    got = {r.doc_id: (r.fp, r.component_id) for r in M.near_duplicates(docs).collect()}
    assert got == {i: (signed(p), low[root[p]]) for i, p in prints.items()}


def test_cut_pieces_lose_no_link(spark):
    """Dense balls of fingerprints, pieces of four members: the trie is cut down to full depth."""
    random.seed(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(6):
        centre = random.getrandbits(64)
        for _ in range(40):
            p = centre
            for _ in range(random.randint(0, 4)):
                p ^= 1 << random.choice([0, 1, 20, 21, 22, 23, 42, 43, 44, 62, 63, random.randrange(64)])
            prints.add(p)
    nodes = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    for piece, budget in ((4, 2), (M.PIECE, 2), (30, 4), (M.PIECE, 6)):
        found = M.links(nodes, piece, budget).collect()
        stars = {r.a: r.b for r in M.components(spark.createDataFrame(found, "a long, b long")).collect()}
        got = {}
        for p in prints:
            got.setdefault(stars.get(signed(p), signed(p)), set()).add(p)
        want = {}
        for p, r in brute_components(prints, budget).items():
            want.setdefault(r, set()).add(p)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("front, direct", [(M.FRONT, M.DIRECT), (16, 1), (50, 4)])
def test_walk_joins_all_links(monkeypatch, front, direct):
    monkeypatch.setattr(M, "FRONT", front)
    monkeypatch.setattr(M, "DIRECT", direct)
    rng = np.random.default_rng(3)
    key = np.unique(rng.integers(0, 1 << 9, 200, dtype=np.uint64) << np.uint64(40))
    n = len(key)
    label = M._walk(key, np.arange(n), *[np.array([x]) for x in (0, n, 0, n)], 0, np.array([0]))
    root = brute_components([int(k) for k in key])
    assert [int(key[i]) for i in label] == [root[int(k)] for k in key]


def test_dense_ball_costs_its_size():
    """Fingerprints that differ from one by some of 16 bits: nearly all pairs are within six bits."""
    rng = np.random.default_rng(7)
    key = np.unique(rng.integers(0, 1 << 16, 12_000, dtype=np.uint64) << np.uint64(20))
    rows = [np.zeros(len(key), np.int64)] * 2 + [np.zeros(len(key), np.int64)] * 2
    rows[1] = rows[1] + 9
    start = time.process_time()
    a, b = M._forest([*rows, key], 6)
    assert len(a) == len(key) - 1 and len(set(b.tolist())) == 1
    assert time.process_time() - start < 20


def test_edges(spark):
    rows = [(5, None), (None, ""), (3, " \n\t"), (7, "one two"), (7, "one two"), (9, "ONE two"), (None, "other words here now"),
            (2, "word " * 30_000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS + ", fp string, root int")
    got = sorted(M.near_duplicates(docs).select("doc_id", "component_id").collect(), key=str)
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 3), (None, 3), (3, 3), (7, 7), (9, 7), (None, None), (2, 2)}
    kept = M.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 3, 7, None]
    none = spark.createDataFrame([], T._parse_datatype_string(DOCS))
    assert M.near_duplicates(none).count() == 0 and M.one_per_group(none).count() == 0
