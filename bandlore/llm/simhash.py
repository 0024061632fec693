"""Near-duplicates by 64-bit SimHash and a self-join of the binary trie of all distinct fingerprints.

Two fingerprints link if at most ``budget`` bits differ, two by default. The trie is walked in pairs of nodes: a pair
adds the differing bits of its two prefixes and is dropped as soon as they exceed the budget. The walk starts at budget +
1 rotations of the fingerprints and below a common top block: of budget + 1 disjoint blocks one must be equal in every
linking pair. So the pairs of nodes at the top need no listing, and each start node is an independent piece of work for
one task. A piece with too many members is cut into pairs of child nodes, again within the budget, before it reaches a
task; at full depth a node holds one fingerprint, so every piece becomes small enough, however they are spread.

A task returns a spanning forest of the links it found, never all pairs. Components come from star contraction.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from bandlore.llm.common import LOWER, binary_text, stable, written

BUDGET = 2
#: Most members of a piece of the trie in one task.
PIECE = 1 << 18
#: Bits by which a large piece is cut.
STEP = 8
#: Pairs of nodes that a task holds at once, and pairs of members below which two nodes are compared directly.
FRONT, DIRECT = 1 << 20, 64
PIECE_KEY = ["turn", "depth", "left", "right"]


def _simhash(text, size):
    from itertools import repeat

    import xxhash

    words = text.translate(LOWER).split()
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(size))) if len(words) >= size else [words]
    count = max(len(words) - size + 1, 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, shingles), repeat(42)), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 65_536):
        bits = np.unpackbits(hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def fingerprints(docs, size=3):
    """doc_id, fingerprint ``fp`` (signed 64 bits) and row hashes of every text. Null or wordless texts have fingerprint 0."""

    def run(batches):
        for batch in batches:
            fps = [_simhash(text.as_py() or b"", size) for text in batch.column("text")]
            keys = [batch.column(c) for c in ("doc_id", "row_hash", "row_check")]
            yield pa.record_batch([*keys, pa.array(fps, pa.int64())], ["doc_id", "row_hash", "row_check", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return binary_text(docs, "doc_id", *_row_keys()).mapInArrow(
        run, f"doc_id {kind}, row_hash long, row_check int, fp long")


def _rotated(fp, turn):
    return fp if turn == 0 else F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, 64 - turn))


def blocks(budget):
    """(rotation to the left, width) of disjoint blocks, one more than ``budget``: one is equal in every linking pair."""
    edges = [round(64 * k / (budget + 1)) for k in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _pieces(nodes, budget):
    """Every fingerprint below its start node in each rotation."""
    starts = F.array(*[
        F.struct(F.lit(turn).alias("turn"), F.lit(width).alias("depth"), _rotated(F.col("fp"), turn).alias("key"))
        for turn, width in blocks(budget)
    ])
    rows = nodes.select(F.explode(starts).alias("s")).select("s.*")
    top = F.expr("shiftrightunsigned(key, 64 - depth)")
    return rows.select("turn", "depth", top.alias("left"), top.alias("right"), "key")


def _cut(pieces, budget, step=STEP):
    """Members of large pieces, sent to the pairs of child nodes that the budget still allows."""
    bits = f"least({step}, 64 - depth)"
    child = pieces.withColumn("bits", F.expr(bits)).withColumn(
        "node", F.expr("shiftrightunsigned(key, 64 - depth - bits)")
    ).withColumn("is_left", F.expr("shiftrightunsigned(key, 64 - depth) = left"))
    masks = F.array(*[F.lit(m).cast("long") for m in range(1 << step) if m.bit_count() <= budget])
    rows = child.withColumn("mask", F.explode(masks)).where(
        f"bit_count(mask) + bit_count(left ^ right) <= {budget} and mask < shiftleft(1L, bits)")
    other = F.expr(
        "shiftleft(if(is_left, right, left), bits) | ((node & (shiftleft(1L, bits) - 1)) ^ mask)")
    rows = rows.withColumn("other", other)
    first = F.expr("if(left = right, node <= other, is_left)")
    return rows.select(
        "turn", (F.col("depth") + F.col("bits")).alias("depth"),
        F.when(first, F.col("node")).otherwise(F.col("other")).alias("left"),
        F.when(first, F.col("other")).otherwise(F.col("node")).alias("right"), "key")


def _roots(label, a, b):
    """Smallest index of everything linked by a-b, given what ``label`` holds together already."""
    n = len(label)
    a, b = np.concatenate((a, np.arange(n))), np.concatenate((b, label))
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _walk(key, label, lo_a, hi_a, lo_b, hi_b, depth, used, budget=BUDGET):
    """Join what links below pairs of trie nodes, each node a range of the sorted array ``key``.

    All pairs of one call share ``depth``. ``label`` holds the smallest index of what is joined so far, and is returned
    with what the links add. Pairs of nodes whose members are all joined already are passed over, so a dense ball of
    fingerprints costs about its size and not its pairs. Pairs of nodes wait on a stack in bounded parts.
    """
    ones, links, waiting = {}, [], 0

    def changes():
        return np.concatenate(([0], np.cumsum(label[1:] != label[:-1]))) if len(label) else np.zeros(0, np.int64)

    turns = changes()
    todo = [(depth, (lo_a, hi_a, lo_b, hi_b, used))]
    while todo:
        depth, front = todo.pop()
        if len(front[0]) > FRONT:
            todo += [(depth, tuple(x[k:k + FRONT] for x in front)) for k in range(0, len(front[0]), FRONT)]
            continue
        lo_a, hi_a, lo_b, hi_b, used = front
        one_a, one_b = turns[hi_a - 1] == turns[lo_a], turns[hi_b - 1] == turns[lo_b]
        apart = ~(one_a & one_b & (label[lo_a] == label[lo_b]))
        lo_a, hi_a, lo_b, hi_b, used = (x[apart] for x in (lo_a, hi_a, lo_b, hi_b, used))
        few = (hi_a - lo_a) * (hi_b - lo_b) <= (DIRECT if depth < 64 else key.size ** 2)
        a, b = _members(lo_a[few], hi_a[few], lo_b[few], hi_b[few])
        close = (label[a] != label[b]) & (np.bitwise_count(key[a] ^ key[b]) <= budget)
        links.append((a[close], b[close]))
        waiting += len(links[-1][0])
        if waiting > FRONT:
            label, links, waiting = _roots(label, *(np.concatenate(x) for x in zip(*links))), [], 0
            turns = changes()
        lo_a, hi_a, lo_b, hi_b, used = (x[~few] for x in (lo_a, hi_a, lo_b, hi_b, used))
        if not len(lo_a):
            continue
        if depth not in ones:
            bits = (key >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate(([0], np.cumsum(bits))).astype(np.int64)
        count = ones[depth]
        mid_a, mid_b = hi_a - (count[hi_a] - count[lo_a]), hi_b - (count[hi_b] - count[lo_b])
        same = lo_a == lo_b
        for start_a, end_a, start_b, end_b, add, twice in (
            (lo_a, mid_a, mid_b, hi_b, 1, False), (mid_a, hi_a, lo_b, mid_b, 1, True),
            (lo_a, mid_a, lo_b, mid_b, 0, False), (mid_a, hi_a, mid_b, hi_b, 0, False),
        ):
            keep = (end_a > start_a) & (end_b > start_b) & (used + add <= budget)
            if twice:
                keep &= ~same
            if keep.any():
                todo.append((depth + 1, tuple(x[keep] for x in (start_a, end_a, start_b, end_b, used + add))))
        todo = _joined(todo)
    return _roots(label, *(np.concatenate(x) for x in zip(*links))) if links else label


def _joined(todo):
    """The last parts of the stack as one, while they share a depth and stay below the bound."""
    while len(todo) > 1 and todo[-1][0] == todo[-2][0] and len(todo[-1][1][0]) + len(todo[-2][1][0]) <= FRONT:
        depth, last = todo.pop()
        todo[-1] = depth, tuple(np.concatenate(x) for x in zip(todo[-1][1], last))
    return todo


def _members(lo_a, hi_a, lo_b, hi_b):
    """All pairs of members of pairs of small nodes."""
    wide = hi_b - lo_b
    n = (hi_a - lo_a) * wide
    pair = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
    return lo_a[pair] + at // wide[pair], lo_b[pair] + at % wide[pair]


def _forest(rows, budget=BUDGET):
    """Spanning links of sorted member rows (turn, depth, left, right, key) that hold whole pieces."""
    turn, depth, left, right, key = rows
    out_a, out_b = [], []
    for t, d in sorted(set(zip(turn.tolist(), depth.tolist()))):
        here = np.flatnonzero((turn == t) & (depth == d))
        own, l, r = key[here], left[here], right[here]
        start = np.flatnonzero(np.concatenate(([True], (l[1:] != l[:-1]) | (r[1:] != r[:-1]))))
        end = np.append(start[1:], len(own))
        # Below a piece the left node's members come first: left < right, and both are prefixes of the keys.
        is_right = ((own >> np.uint64(64 - d)) if d else own * 0) != l.view(np.uint64)
        counted = np.concatenate(([0], np.cumsum(is_right)))
        mid = end - (counted[end] - counted[start])
        single = l[start] == r[start]
        used = np.bitwise_count(l[start].view(np.uint64) ^ r[start].view(np.uint64)).astype(np.int64)
        lo_a, hi_a = start, np.where(single, end, mid)
        lo_b, hi_b = np.where(single, start, mid), end
        live = np.where(single, end - start > 1, (hi_a > lo_a) & (hi_b > lo_b))
        root = np.arange(len(own))
        # Close links first: they join dense balls, which the wider budgets then pass over.
        for near in sorted({min(BUDGET, budget), *range(budget, BUDGET, -2)}):
            fit = live & (used <= near)
            root = _walk(own, root, lo_a[fit], hi_a[fit], lo_b[fit], hi_b[fit], d, used[fit], near)
        leaf = np.flatnonzero(root != np.arange(len(own)))
        back = [(own << np.uint64(64 - t)) | (own >> np.uint64(t)) if t else own][0]
        out_a.append(back[leaf])
        out_b.append(back[root[leaf]])
    if not out_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_a).view(np.int64), np.concatenate(out_b).view(np.int64)


def _links(batches, budget=BUDGET):
    """Walk the pieces of a sorted partition; whole pieces are taken together, some 65,536 rows or one piece at a time."""
    held = None
    for batch in batches:
        got = [batch.column(c).to_numpy(zero_copy_only=False) for c in (*PIECE_KEY, "key")]
        got[4] = got[4].view(np.uint64)
        held = got if held is None else [np.concatenate(x) for x in zip(held, got)]
        if len(held[0]) < 1 << 16:
            continue
        last = np.ones(len(held[0]), bool)
        for column in held[:4]:
            last &= column == column[-1]
        cut = int(np.flatnonzero(last)[0])
        if cut:
            yield _linked(*_forest([x[:cut] for x in held], budget))
            held = [x[cut:] for x in held]
    if held is not None:
        yield _linked(*_forest(held, budget))


def _linked(a, b):
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def links(nodes, piece=PIECE, budget=BUDGET):
    """Links a-b between distinct fingerprints ``fp`` of ``nodes``; together they connect what a full join connects.

    ``piece`` bounds the members of one piece of work, not the result: larger pieces are cut, with no row left out.
    """
    todo, ready = _pieces(nodes, budget), []
    while True:
        is_left = F.expr("int(shiftrightunsigned(key, 64 - depth) = left)")
        large = stable(todo.groupBy(*PIECE_KEY).agg(F.count("*").alias("n"), F.sum(is_left).alias("n_left")).where(
            F.col("n") > piece))
        if large.isEmpty():
            ready.append(todo)
            break
        ready.append(todo.join(large, PIECE_KEY, "left_anti"))
        two_sided = large.where("left = right or n_left between 1 and n - 1")
        todo = stable(_cut(todo.join(two_sided, PIECE_KEY, "left_semi"), budget))
    found = None
    for rows in ready:
        dealt = rows.select(*PIECE_KEY, "key").repartition(*PIECE_KEY).sortWithinPartitions(
            *PIECE_KEY, F.expr("shiftrightunsigned(key, 1)"), F.expr("key & 1"))
        part = dealt.mapInArrow(lambda batches: _links(batches, budget), "a long, b long")
        found = part if found is None else found.unionByName(part)
    return found


def components(edges):
    """Smallest node reachable from every node that has a link: columns a, b. Star contraction, cut by checkpoints."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs, last = stable(pairs), None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            return pairs
        last = state
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        pairs = stable(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())


def near_duplicates(docs, size=3, budget=BUDGET, piece=PIECE):
    """One row per document: doc_id, fp, component_id (smallest doc_id linked to it over any chain, itself included),
    and two hashes of doc_id and text (row_hash, row_check) that find the row again.

    Null, empty and wordless texts share fingerprint 0 and so one component. Rows with equal doc_id stay separate rows.
    A component whose doc_ids are all null has a null component_id. An empty table gives no rows.
    """
    return _classed(docs, size, budget, piece).drop("root")


def _row_keys():
    return F.xxhash64("doc_id", "text").alias("row_hash"), F.hash("doc_id", "text").alias("row_check")


def _classed(docs, size, budget, piece):
    prints = written(fingerprints(docs, size), "fingerprints")
    nodes = stable(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    stars = components(links(nodes, piece, budget))
    classed = nodes.join(stars.withColumnRenamed("a", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("b", "fp").alias("root"))
    least = classed.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints.join(classed.join(least, "root").drop("low"), "fp").select(
        "doc_id", "fp", "component_id", "root", "row_hash", "row_check")


def one_per_group(docs, size=3, budget=BUDGET, piece=PIECE):
    """``docs`` without near copies: of every component the row with the smallest doc_id stays (null doc_ids last).

    Between rows of one doc_id a hash of the text decides; of wholly equal rows one stays. Null, empty and wordless texts
    are one component. Other columns, whatever their names, are untouched; texts of any length count whole; an empty table
    stays empty.
    """
    classed = _classed(docs.select("doc_id", "text"), size, budget, piece)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "row_hash", "row_check")
    first = classed.groupBy("root").agg(F.min(rank).alias("r")).select("r.row_hash", "r.row_check").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    kept = docs.select(row, *_row_keys()).join(first, ["row_hash", "row_check"], "left_semi")
    same = Window.partitionBy("row_hash", "row_check").orderBy("row_hash")
    return kept.withColumn("copy", F.row_number().over(same)).where("copy = 1").select("row.*")
