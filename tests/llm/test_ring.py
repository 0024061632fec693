"""Bounded-load ring against a walk row by row."""

import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from bandlore.llm import ring as M
from bandlore.llm.queries import QUERIES


def walk(rows, shards, slack):
    """rows: (position, tie) in any order. Shard of each, by taking one row after the other around the ring."""
    points = M.ring(shards, 8)
    room = M.capacities(len(rows), shards, slack)
    home = {r: next(i for i, (last, _) in enumerate(points) if r[0] <= last) for r in rows}
    out, late = {}, []
    for r in sorted(rows):
        shard = points[home[r]][1]
        if room[shard]:
            room[shard] -= 1
            out[r] = shard
        else:
            late.append(r)
    for r in late:
        at = home[r]
        while not room[points[at][1]]:
            at = (at + 1) % len(points)
        room[points[at][1]] -= 1
        out[r] = points[at][1]
    return out


def test_matches_walk_over_rows(spark):
    docs = spark.range(700).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"))
    position = {r.doc_id: r.p for r in docs.select("doc_id", F.xxhash64(F.lit("ring"), "doc_id").alias("p")).collect()}
    for shards, slack in ((5, 0.0), (16, 0.0), (5, 0.1)):
        want = walk([(p, i) for i, p in position.items()], shards, slack)
        got = M.shard(docs, shards, slack, vnodes=8).collect()
        assert {(position[r.doc_id], r.doc_id): r.shard for r in got} == want


def check_rows(rows, shards=16):
    sizes = Counter(r.shard for r in rows)
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    counts = [sizes[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1


def test_query_over_documents(spark, small):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op4_ring_shards"](spark, small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    check_rows(rows)
    for r in rows:
        assert (r["size"], r.text_crc32) == (len(docs[r.doc_id]) + 1, zlib.crc32(docs[r.doc_id]))
        assert r.law == "rows" and r.grown_shard is None


def test_few_rows_move_when_a_shard_is_added(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    a = {r.doc_id: r.shard for r in M.shard(docs, 16, slack=0.25).collect()}
    b = {r.doc_id: r.shard for r in M.shard(docs, 17, slack=0.25).collect()}
    assert sum(a[i] != b[i] for i in a) < 0.12 * len(a)


def test_edges(spark):
    hot = [(None, None)] * 300 + [(7, "é")] * 300 + [(i, "") for i in range(100, 200)]
    docs = spark.createDataFrame([(*r, 3, "s") for r in hot], "doc_id long, text string, shard int, slot string")
    rows = M.shard(docs.repartition(4)).collect()
    assert len(rows) == 700 and {r["size"] for r in rows if r.doc_id == 7} == {3}
    check_rows(rows)
    assert M.shard(docs.where("false")).count() == 0
    assert [r.slot for r in M.shard(docs.limit(1)).collect()] == [0]


def test_arcs_cover_the_ring(spark):
    points = M.ring(16)
    assert points[-1][0] == M.LAST and len(points) == 16 * M.VNODES + 1
    rows = sorted((r.low, r.high, r.arc) for r in M._arc_table(spark, points).dropDuplicates(["arc"]).collect())
    assert rows[0][0] == -(1 << 63) and all(a[1] + 1 == b[0] for a, b in zip(rows, rows[1:]))
    assert xxhash.xxh64_intdigest("0:0", 7) - (1 << 63) in {p for p, _ in points}
