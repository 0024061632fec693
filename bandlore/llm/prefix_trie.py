"""The trie of conversation prefixes, and subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns. Turns are ranked, and prefixes digested, by running sums over ranges of the
ordered turns: a range is summed in its task, and the few conversations that cross a border between ranges get the sums
of the ranges before. So a conversation may hold any share of all turns. The digest of a prefix is the sum of two 64-bit
hashes of its turns and their places. A node is then named by its smallest member and its depth.

Totals come from contraction rounds on the table of nodes. Rake: leaves hand their totals to their parents, as one grouped
sum, and are done. Compress: of every chain of nodes with a single child, those whose hash is above that of parent and
child are cut out; what they held stays as an amount on the edge of their child. A round takes all leaves and a third of
all chain nodes, so the rounds grow with the logarithm of the nodes, not with the depth. Then nodes that were cut out are
expanded again, by doubling: each points to the node that was its child, and its total is the child's and an amount.

Every round's nodes are written; no group is collected. The members that end in a node are sorted in ranges and digested
as a stream of blocks.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from bandlore.llm.common import written

#: Conversations whose ids differ by less share their first turns in ``rebuilt``, and the most turns they share.
FAMILY, SHARED = 100, 6
#: Most ids of a block of members.
BLOCK = 1 << 15
NODE = ["conv_id", "depth"]


def _running(rows, order, sums, name):
    """``rows`` with ``run_<sum>`` columns: running sums (64 bits, wrapping) of ``sums`` in each conv_id by ``order``."""
    import pyspark

    own = [f"run_{s}" for s in sums]
    columns = rows.columns

    def local(batches):
        part = pyspark.TaskContext.get().partitionId()
        last, held, line = None, np.zeros(len(sums), np.uint64), 0
        for batch in batches:
            conv = batch.column("conv_id").to_numpy(zero_copy_only=False)
            if not len(conv):
                continue
            starts = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
            of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(conv))))
            out = []
            for k, s in enumerate(sums):
                values = batch.column(s).to_numpy(zero_copy_only=False).view(np.uint64)
                total = np.cumsum(values, dtype=np.uint64)
                run = total - (total[starts] - values[starts])[of]
                if conv[0] == last:
                    run[of == 0] += held[k]
                out.append(run)
            last, held = conv[-1], np.array([r[-1] for r in out], np.uint64)
            yield pa.record_batch(
                [*(batch.column(c) for c in columns), *(pa.array(r.view(np.int64)) for r in out),
                 pa.array(np.full(len(conv), part, np.int32)), pa.array(np.arange(line, line + len(conv)))],
                [*columns, *own, "part", "line"])
            line += len(conv)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    kinds += "".join(f", {c} long" for c in own)
    ordered = rows.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    summed = written(ordered.mapInArrow(local, f"{kinds}, part int, line long"), name)
    # A range has two conversations at most that go on elsewhere.
    ends = summed.groupBy("conv_id", "part").agg(*[F.max_by(c, "line").alias(c) for c in own])
    several = ends.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    before, carried = {}, {}
    for row in ends.join(several, "conv_id").orderBy("conv_id", "part").collect():
        at = before.get(row.conv_id, [0] * len(own))
        carried[row.conv_id, row.part] = np.array(at, np.uint64)
        before[row.conv_id] = [(a + row[c]) % (1 << 64) for a, c in zip(at, own)]

    def moved(batches):
        for batch in batches:
            conv, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("conv_id", "part"))
            runs = [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64).copy() for c in own]
            for p in np.unique(part) if carried else ():
                here = part == p
                low, high = conv[here].min(), conv[here].max()
                for c in {low, high}:
                    if (c, p) in carried:
                        rows = here & (conv == c)
                        for run, add in zip(runs, carried[c, p]):
                            run[rows] += add
            yield pa.record_batch([*(batch.column(c) for c in columns), *(pa.array(r.view(np.int64)) for r in runs)],
                                  [*columns, *own])

    return summed.mapInArrow(moved, kinds)


def turns(conversations):
    """conv_id, place (from 1), and of the turn's role and text: digest, two hashes, code points of the text.

    Turns are ordered by number, null first, then role, then the digest. Null roles and texts count as empty. Rows
    without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        digest.alias("digest"), F.length(text).cast("long").alias("size"), F.lit(1).cast("long").alias("place"))
    return _running(rows, ["turn", "role", "digest"], ["place"], "turns").select(
        "conv_id", F.col("run_place").alias("place"), "digest", "size")


def own_turns(rows):
    """Conversations as they are: every turn at its place."""
    return rows.select("conv_id", F.col("place").alias("depth"), "digest", "size")


def rebuilt(rows, family=FAMILY, shared=SHARED):
    """The first h turns of the family's first conversation (c - c % family), then the own turns behind the first h,
    where h = crc32(conv_id) % shared."""
    first = F.expr(f"conv_id - conv_id % {family}")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared)
    heads = rows.where(F.expr(f"conv_id % {family} = 0 and place < {shared}"))
    heads = written(heads.groupBy(F.col("conv_id").alias("head")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "size"))).alias("turns")), "heads")
    own = rows.withColumn("h", h).where("place > h").withColumn("head", first).join(
        heads.select("head", F.size("turns").alias("n")), "head", "left").select(
        "conv_id", (F.least("h", F.coalesce("n", F.lit(0))) + F.col("place") - F.col("h")).alias("depth"), "digest", "size")
    convs = rows.select("conv_id").distinct().withColumn("h", h).withColumn("head", first)
    taken = convs.join(heads, "head").select("conv_id", F.explode(F.expr("slice(turns, 1, cast(h as int))")).alias("t"))
    return own.unionByName(taken.select("conv_id", F.col("t.place").alias("depth"), "t.digest", "t.size"))


def _nodes(rows, convs):
    """Nodes (conv_id, depth, parent_conv_id, n_convs, size) and the node (conv_id, depth) where each ``member`` ends."""
    hashed = rows.withColumn("a", F.xxhash64(F.lit(1), "depth", "digest")).withColumn(
        "b", F.xxhash64(F.lit(2), "depth", "digest")).drop("digest")
    prefixes = _running(hashed, ["depth"], ["a", "b"], "prefixes")
    # The parent's digest is the sum before; differences wrap, so they are taken in Arrow with the sums.

    def parents(batches):
        for batch in batches:
            run_a, run_b, a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("run_a", "run_b", "a", "b"))
            with np.errstate(over="ignore"):
                above = pa.array(run_a - a), pa.array(run_b - b)
            yield pa.record_batch([*(batch.column(c) for c in ("conv_id", "depth", "size", "run_a", "run_b")), *above],
                                  ["conv_id", "depth", "size", "run_a", "run_b", "up_a", "up_b"])

    kinds = "conv_id long, depth long, size long, run_a long, run_b long, up_a long, up_b long"
    prefixes = written(prefixes.mapInArrow(parents, kinds), "prefix_digests")
    key = ["depth", "run_a", "run_b"]
    nodes = prefixes.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size"),
        F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in ("run_a", "run_b")],
        "conv_id", "n_convs", F.lit(0).cast("long").alias("size"),
        *[F.lit(None).cast("long").alias(c) for c in ("up_a", "up_b")])
    nodes = written(nodes.unionByName(root), "keyed_nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("run_a").alias("up_a"), F.col("run_b").alias("up_b"),
                         F.col("conv_id").alias("parent_conv_id"))
    ends = prefixes.groupBy("conv_id").agg(
        F.max("depth").alias("depth"), F.max_by("run_a", "depth").alias("run_a"), F.max_by("run_b", "depth").alias("run_b"))
    ends = convs.join(ends, "conv_id", "left").select(
        F.col("conv_id").alias("member"), *[F.coalesce(c, F.lit(0)).alias(c) for c in key])
    return (nodes.join(above, ["depth", "up_a", "up_b"], "left").select(*NODE, "parent_conv_id", "n_convs", "size"),
            ends.join(nodes.select(*key, "conv_id"), key).select(*NODE, "member"))


def _rank(conv, depth, turn):
    return F.xxhash64(F.lit(turn), conv, depth)


def subtree_sums(nodes, *values):
    """conv_id, depth and the sums of the columns ``values`` over the subtree of every node.

    ``nodes``: conv_id, depth, parent_conv_id and parent_depth (null at roots), values; no duplicates, no cycles.
    """
    up = ["parent_conv_id", "parent_depth"]
    kids = nodes.where("parent_conv_id is not null").groupBy(*up).agg(F.count("*").alias("n")).toDF(*NODE, "n")
    carry = [f"carry_{v}" for v in values]
    state = written(nodes.join(kids, NODE, "left").select(
        *NODE, *up, *[F.col(v).cast("long").alias(v) for v in values],
        *[F.lit(0).cast("long").alias(c) for c in carry], F.coalesce("n", F.lit(0)).alias("n")), "tree")
    raked, cut, turn = [], [], 0
    while True:
        raked.append(state.where("n = 0").select(*NODE, *values))
        inner = state.where("n > 0")
        if inner.isEmpty():
            break
        # Rake: parents get what their leaves hold; of a parent with one other child, that child is known.
        is_leaf = F.col("n") == 0
        given = state.where("parent_conv_id is not null").groupBy(*up).agg(
            *[F.sum(F.when(is_leaf, F.col(v) + F.col(c)).otherwise(0)).alias(f"add_{v}") for v, c in zip(values, carry)],
            F.count(F.when(~is_leaf, 1)).alias("left"),
            F.max(F.when(~is_leaf, F.col("conv_id"))).alias("kid_conv_id"),
            F.max(F.when(~is_leaf, F.col("depth"))).alias("kid_depth")).withColumnsRenamed(dict(zip(up, NODE)))
        inner = inner.join(given, NODE).select(
            *NODE, *up, *[(F.col(v) + F.col(f"add_{v}")).alias(v) for v in values], *carry, F.col("left").alias("n"),
            "kid_conv_id", "kid_depth",
            F.when((F.col("left") == 1) & F.col("parent_conv_id").isNotNull(),
                   (_rank("conv_id", "depth", turn) > _rank("kid_conv_id", "kid_depth", turn))
                   & (_rank("conv_id", "depth", turn) > _rank("parent_conv_id", "parent_depth", turn))
                   ).otherwise(False).alias("goes"))
        inner = written(inner, "raked")
        # Compress: the child of a node that goes is hung below the node's parent. Both sides of the join are unique.
        gone = inner.where("goes").select(
            F.col("kid_conv_id").alias("conv_id"), F.col("kid_depth").alias("depth"),
            *[F.col(c).alias(f"old_{c}") for c in (*NODE, *up, *values, *carry)])
        hung = written(inner.where("not goes").drop("kid_conv_id", "kid_depth", "goes").join(gone, NODE, "left"), "hung")
        cut.append(hung.where("old_conv_id is not null").select(
            F.col("old_conv_id").alias("conv_id"), F.col("old_depth").alias("depth"), F.col("conv_id").alias("kid_conv_id"),
            F.col("depth").alias("kid_depth"), *[(F.col(f"old_{v}") + F.col(c)).alias(v) for v, c in zip(values, carry)]))
        moved = F.col("old_conv_id").isNotNull()
        state = hung.select(
            *NODE, *[F.when(moved, F.col(f"old_{c}")).otherwise(F.col(c)).alias(c) for c in up], *values,
            *[F.when(moved, F.col(c) + F.col(f"old_{v}") + F.col(f"old_{c}")).otherwise(F.col(c)).alias(c)
              for v, c in zip(values, carry)], "n")
        turn += 1
    totals = raked[0]
    for part in raked[1:]:
        totals = totals.unionByName(part)
    if not cut:
        return totals
    links = cut[0]
    for part in cut[1:]:
        links = links.unionByName(part)
    # A cut node's child was cut in a later round, if at all.
    for _ in range(math.ceil(math.log2(turn)) if turn > 1 else 0):
        links = written(links, "links")
        further = links.select(
            F.col("conv_id").alias("kid_conv_id"), F.col("depth").alias("kid_depth"), F.col("kid_conv_id").alias("next_conv_id"),
            F.col("kid_depth").alias("next_depth"), *[F.col(v).alias(f"next_{v}") for v in values])
        links = links.join(further, ["kid_conv_id", "kid_depth"], "left").select(
            *NODE, F.coalesce("next_conv_id", "kid_conv_id").alias("kid_conv_id"),
            F.coalesce("next_depth", "kid_depth").alias("kid_depth"),
            *[(F.col(v) + F.coalesce(f"next_{v}", F.lit(0))).alias(v) for v in values])
    kid = totals.select(F.col("conv_id").alias("kid_conv_id"), F.col("depth").alias("kid_depth"),
                        *[F.col(v).alias(f"kid_{v}") for v in values])
    expanded = links.join(kid, ["kid_conv_id", "kid_depth"]).select(
        *NODE, *[(F.col(v) + F.col(f"kid_{v}")).alias(v) for v in values])
    return totals.unionByName(expanded)


def _ends_digests(ends):
    """SHA-256 of the members that end in a node, as decimal numbers in rising order, joined by commas."""

    def blocks(batches):
        held = None

        def block(node, members):
            return pa.record_batch(
                [pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([members[0]], pa.int64()),
                 pa.array([",".join(map(str, members))], pa.string())], [*NODE, "first", "ids"])

        for batch in batches:
            for conv, depth, member in zip(*(batch.column(c).to_pylist() for c in (*NODE, "member"))):
                if held and (held[0] != (conv, depth) or len(held[1]) >= BLOCK):
                    yield block(*held)
                    held = None
                if held is None:
                    held = (conv, depth), []
                held[1].append(member)
        if held:
            yield block(*held)

    def digests(batches):
        node, digest = None, None

        def result():
            return pa.record_batch([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()),
                                    pa.array([digest.hexdigest()], pa.string())], [*NODE, "ends_sha256"])

        for batch in batches:
            for k, pair in enumerate(zip(*(batch.column(c).to_pylist() for c in NODE))):
                if pair != node:
                    if node:
                        yield result()
                    node, digest = pair, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(batch.column("ids")[k].as_py().encode())
        if node:
            yield result()

    order = [*NODE, "member"]
    ids = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        blocks, "conv_id long, depth long, first long, ids string")
    return ids.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(
        digests, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(conversations, build=own_turns):
    """One row per distinct prefix: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    A prefix is a sequence of first turns (role, text); members are the conversations that begin with it, and the root
    is the empty one. n_leaves counts childless nodes of the subtree, itself included; saved_tokens sums over the subtree
    (n_convs - 1) times the code points of the node's last text; ends_sha256 digests the members that end here.

    ``build`` makes the turns (conv_id, depth, digest, size) from ranked ones. Turns are ordered by number, null first;
    ties by role, then by digest of role and text, so repeated rows are repeated turns. Null roles and texts count as
    empty, rows without conv_id are in no conversation, and a conversation that ``build`` leaves without turns ends at
    the root. Texts of any length count whole. Other columns are ignored. An empty table gives no rows, not even a root.
    """
    ranked = written(turns(conversations), "ranked_turns")
    convs = ranked.select("conv_id").distinct()
    nodes, ends = _nodes(build(ranked), convs)
    nodes = written(nodes, "nodes")
    kids = nodes.where("depth > 0").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(kids, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie")
    totals = subtree_sums(
        nodes.select(*NODE, "parent_conv_id", F.when(F.col("depth") > 0, F.col("depth") - 1).alias("parent_depth"),
                     (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                     ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens")), "n_leaves", "saved_tokens")
    return nodes.drop("size").join(totals, NODE).join(_ends_digests(ends), NODE, "left").select(
        *NODE, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
