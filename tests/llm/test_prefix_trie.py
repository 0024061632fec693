"""The trie of prefixes against a dictionary of all prefixes; contraction against sums over random trees."""

import hashlib
import random
import zlib

from bandlore.llm import prefix_trie as M
from bandlore.llm.queries import QUERIES


def ordered(rows):
    """conv_id -> turns; rows: (conv_id, turn, role, text)."""
    convs = {}
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
        if c is not None:
            convs.setdefault(c, []).append(((turn is not None, turn or 0, role, digest), (role, text)))
    return {c: [t for _, t in sorted(found, key=lambda t: t[0])] for c, found in convs.items()}


def planted(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def brute(convs):
    members, ends = {}, {}
    for c, own in convs.items():
        for d in range(len(own) + 1):
            members.setdefault(tuple(own[:d]), []).append(c)
        ends.setdefault(tuple(own), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids[node[:-1]] = kids.get(node[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
    return sorted((min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), kids.get(n, 0), leaves[n],
                   saved[n], hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest())
                  for n in members)


def got(df):
    rows = [tuple(r) for r in df.collect()]
    return sorted(rows, key=lambda r: r[:2])


def test_query_over_conversations(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op12_prefix_trie"](spark, small)
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                          "ends_sha256"]
    assert got(df) == brute(planted(ordered(rows)))


def test_edges(spark):
    """Nulls, ties, repeated rows, turnless conversations, a long one, clashing columns, an empty table."""
    rng = random.Random(4)
    rows = [(1, None, None, None), (1, 0, "user", "é" * 7), (1, 0, "user", "é" * 7), (1, 0, "system", "b"), (2, 5, "user", ""),
            (2, 3, None, "x"), (None, 1, "user", "lost"), (101, 0, "a", "1"), (102, 0, "a", "1"), (103, 1, "a", "1"),
            (1007, 0, "z", "q" * 30_000)]
    rows += [(200, k, "u", rng.choice("ab")) for k in range(700)] + [(201, k, "u", rng.choice("ab")) for k in range(60)]
    rows += [(300 + k, t, "u", "same") for k in range(40) for t in range(9)]
    docs = spark.createDataFrame([(*r, 1, "y") for r in rows],
                                 "conv_id long, turn long, role string, text string, depth int, n string")
    convs = ordered(rows)
    assert got(M.prefix_trie(docs)) == brute(convs)
    assert got(M.prefix_trie(docs, M.rebuilt)) == brute(planted(convs))
    assert M.prefix_trie(docs.where("false"), M.rebuilt).count() == 0


def test_repeated_turns_over_many_ranges(spark):
    """A conversation of few distinct rows that goes on over most ranges."""
    rng = random.Random(5)
    rows = [(7, k // 9, "u", rng.choice(("same", "same", "other"))) for k in range(500)] + [(8, k, "u", "same") for k in range(20)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        ranked = M.turns(docs)
        places = [r.place for r in ranked.where("conv_id = 7").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(places) == list(range(1, 501))


def test_contraction(spark):
    """Chains, stars and random trees."""
    rng, nodes, value = random.Random(8), [], {}
    for tree, (n, near) in enumerate(((1, 1), (120, 1), (60, 1000), (300, 3), (300, 40))):
        for k in range(n):
            parent = None if not k else rng.randrange(max(0, k - near), k) if near < 1000 else 0
            value[tree, k] = rng.randrange(100), parent
            nodes.append((tree, k, None if parent is None else tree, parent, value[tree, k][0]))
    want = {node: v for node, (v, _) in value.items()}
    for tree, k in sorted(want, reverse=True):
        if value[tree, k][1] is not None:
            want[tree, value[tree, k][1]] += want[tree, k]
    df = spark.createDataFrame(nodes, "conv_id long, depth long, parent_conv_id long, parent_depth long, v long")
    rows = M.subtree_sums(df, "v").collect()
    assert len(rows) == len(want) and {(r.conv_id, r.depth): r.v for r in rows} == want
