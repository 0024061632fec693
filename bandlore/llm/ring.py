"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many arcs of a ring of 64-bit hashes. A row belongs to the arc of its hash; rows that come after their
shard is full go on clockwise to the next shard with room. What each arc keeps and passes on follows from the number of
rows per arc alone, so that walk runs over a few thousand counts, never over rows. It yields segments: of the rows of
an arc, in ring order, those from one rank to another go to this shard, beginning at this slot. A row then only needs
its rank on the ring. Ranks come from a range sort with a tie-break, so equal keys are spread over tasks too.

With no slack the shards' row counts differ by one at most; all but the overflowing rows stay at their home shard.
"""

from pyspark.sql import functions as F

from bandlore.llm.common import written

VNODES = 256


#: Leading bits of a position by which arcs are joined.
BITS = 12
LAST = (1 << 63) - 1


def ring(shards, vnodes=VNODES):
    """Arcs in ring order: (last position, shard). The arc that wraps around is listed as two of the same shard."""
    import xxhash

    points = sorted(
        {xxhash.xxh64_intdigest(f"{s}:{v}", 7) - (1 << 63): s for s in range(shards) for v in range(vnodes)}.items())
    return [*points, (LAST, points[0][1])] if points[-1][0] < LAST else points


def capacities(rows, shards, slack=0.0):
    """Most rows of each shard: an even share, one more for the first ones; with slack, (1 + slack) times the share."""
    even, over = divmod(rows, shards)
    if slack:
        return [int((1 + slack) * rows / shards) + 1] * shards
    return [even + (s < over) for s in range(shards)]


def segments(counts, owners, room):
    """Walk clockwise over the arcs: rows (arc, first rank, end rank, shard, first slot), all without gaps.

    First every arc fills its own shard in ring order. What found no room then goes on clockwise from its arc.
    """
    room, slots, out, passed = list(room), [0] * len(room), [], []

    def place(arc, start, n, shard):
        got = min(n, room[shard])
        if got:
            out.append((arc, start, start + got, shard, slots[shard]))
            room[shard] -= got
            slots[shard] += got
        return got

    for arc, n in enumerate(counts):
        got = place(arc, 0, n, owners[arc])
        if got < n:
            passed.append((arc, got, n))
    for arc, start, end in passed:
        at = arc
        while start < end:
            at = (at + 1) % len(owners)
            start += place(arc, start, end - start, owners[at])
    return out


def _arc_table(spark, points):
    """(lead, low, high, arc): for each value of the leading bits the arcs that reach into it."""
    rows, low = [], -(1 << 63)
    for arc, (high, _) in enumerate(points):
        rows += [(lead, low, high, arc) for lead in range(low >> 64 - BITS, (high >> 64 - BITS) + 1)]
        low = high + 1
    return spark.createDataFrame(rows, "lead long, low long, high long, arc int")


def shard(docs, shards=16, slack=0.0, vnodes=VNODES):
    """One row per document: doc_id, size (UTF-8 bytes + 1; null text: 1), text_crc32, shard, slot (gapless in a shard).

    ``slack`` 0 keeps row counts at most one apart; a larger one lets a shard hold (1 + slack) times its share, so that
    fewer rows leave their home. Null doc_ids share one position; rows at one position follow in the order of the
    scan, so equal or null ids never need one task. An empty table gives no rows.

    The driver holds one count per arc and one per partition; both are broadcast, and neither grows with the rows.
    """
    spark = docs.sparkSession
    points = ring(shards, vnodes)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.lit("ring"), "doc_id").alias("position"), F.monotonically_increasing_id().alias("tie"))
    arcs = F.broadcast(_arc_table(spark, points))
    rows = rows.withColumn("lead", F.shiftright("position", 64 - BITS)).join(arcs, "lead").where(
        "position between low and high").drop("lead", "low", "high")
    ordered = written(rows, "ring-rows").repartitionByRange("position", "tie").sortWithinPartitions("position", "tie")
    ordered = written(ordered.withColumn("place", F.monotonically_increasing_id()), "ring-order")
    ordered = ordered.withColumn("part", F.shiftright("place", 33)).withColumn(
        "row", F.col("place").bitwiseAND((1 << 33) - 1))
    sizes = ordered.groupBy("part", "arc").agg(F.count("*").alias("n"), F.min("row").alias("row")).collect()
    # Partitions are in ring order, and so are the arcs in them: each piece gets the arc's rows that came before it.
    counts, starts = [0] * len(points), []
    for part, arc, n, row in sorted(sizes):
        starts.append((part, arc, counts[arc] - row))
        counts[arc] += n
    cut = segments(counts, [owner for _, owner in points], capacities(sum(counts), shards, slack))
    starts = spark.createDataFrame(starts, "part long, arc int, shift long")
    cut = spark.createDataFrame(cut, "arc int, first long, end long, shard int, slot0 long")
    ranked = ordered.join(F.broadcast(starts), ["part", "arc"]).withColumn("rank", F.col("row") + F.col("shift"))
    placed = ranked.join(F.broadcast(cut), "arc").where("rank >= first and rank < end")
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("slot0") + F.col("rank") - F.col("first")).alias("slot"))
