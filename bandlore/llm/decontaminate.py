"""Benchmark passages in documents, by a prefix-filtered set join and exact checks of item-sized windows.

A window is ten consecutive words of a benchmark item (or a whole shorter item). Its shingles are ordered by rarity in
the documents. Containment has to be complete, so the necessary prefix of a window is one shingle, its rarest: a document
without it cannot hold the window. Documents are probed with the prefix shingles of all windows. A match fixes where the
window would start; windows that would begin before the first word or end after the last are passed over (position and
length bounds), and the words of the rest are compared.

The windows go to the workers in blocks of bounded size, each probed against all documents. The documents are never
shuffled; only with more than one block are the found spans of a document brought together.
"""

import hashlib
import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from bandlore.llm.common import LOWER, binary_text, stable

SIZE = 10
SHINGLE = 3
#: Most windows and bytes of windows in a block.
BLOCK_ROWS, BLOCK_BYTES = 100_000, 32_000_000

#: Lower case, and a space for every ASCII character that is no digit or letter.
WORDS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in LOWER)
SPANS = "array<struct<start:int,length:int>>"


def _words(text):
    return text.translate(WORDS).split()


def windows(items, size=SIZE):
    """Distinct (item_id as string, window as space-joined words, n_words). Items without words have no windows."""

    def run(batches):
        for batch in batches:
            ids, texts, counts = [], [], []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text")):
                words = _words(text.as_py() or b"")
                for at in range(max(len(words) - size, 0) + 1 if words else 0):
                    ids.append(item)
                    texts.append(b" ".join(words[at:at + size]))
                    counts.append(min(size, len(words)))
            yield pa.record_batch([pa.array(ids, pa.string()), pa.array(texts, pa.binary()), pa.array(counts, pa.int32())],
                                  ["item_id", "window", "n_words"])

    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id")
    found = binary_text(items, item).mapInArrow(run, "item_id string, window binary, n_words int")
    return found.distinct()


def _shingles(words, size):
    return zip(*(words[i:] for i in range(size))) if size > 1 else zip(words)


def _blocks(found):
    """The windows in lists of bounded size, one after another on the driver."""
    found = stable(found)
    n, size = found.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window") + 40), F.lit(0))).first()
    blocks = max(1, math.ceil(n / BLOCK_ROWS), math.ceil(size / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("window", "item_id"), F.lit(blocks))
    for b in range(blocks):
        yield [(bytes(r.window), r.item_id) for r in found.where(block == b).collect()], blocks


def _frequencies(docs, wanted):
    """How often each wanted shingle occurs in all documents; the task sums are added up by shingle."""
    sizes = sorted({len(s) for s in wanted})

    def run(batches):
        total = Counter()
        for batch in batches:
            for text in batch.column("text"):
                words = _words(text.as_py() or b"")
                for size in sizes:
                    total.update(filter(wanted.__contains__, _shingles(words, size)))
        yield pa.record_batch(
            [pa.array([b" ".join(s) for s in total], pa.binary()), pa.array(total.values(), pa.int64())], ["shingle", "n"])

    counted = binary_text(docs).mapInArrow(run, "shingle binary, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return {tuple(bytes(r.shingle).split()): r.n for r in counted.collect()}


class Index:
    """Prefix shingles of a block of windows, and the items of each window."""

    def __init__(self, pairs, frequency):
        self.items, self.prefix = {}, {}
        for window, item in pairs:
            self.items.setdefault(tuple(window.split()), []).append(item)
        for words in self.items:
            parts = list(_shingles(words, min(SHINGLE, len(words))))
            at = min(range(len(parts)), key=lambda i: (frequency.get(parts[i], 0), parts[i], i))
            self.prefix.setdefault(parts[at], set()).add((at, len(words)))
        self.sizes = sorted({len(s) for s in self.prefix})

    @staticmethod
    def shingles(pairs):
        return {s for window, _ in pairs for words in [window.split()]
                for s in _shingles(words, min(SHINGLE, len(words)))}

    def probe(self, words):
        """Spans (start, length) of windows in ``words`` and the items they belong to."""
        spans, items = set(), set()
        for size in self.sizes:
            prefix = self.prefix
            for at, shingle in enumerate(_shingles(words, size)):
                if shingle not in prefix:
                    continue
                for offset, length in prefix[shingle]:
                    start = at - offset
                    if start < 0 or start + length > len(words) or (start, length) in spans:
                        continue
                    owners = self.items.get(tuple(words[start:start + length]))
                    if owners:
                        spans.add((start, length))
                        items.update(owners)
        return sorted(spans), items


def _probed(docs, index):
    def run(batches):
        for batch in batches:
            counts, spans, items = [], [], []
            for text in batch.column("text"):
                words = _words(text.as_py() or b"")
                found, owners = index.probe(words)
                counts.append(len(words))
                spans.append([{"start": s, "length": n} for s, n in found])
                items.append(sorted(owners))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("row_hash"), batch.column("row_check"), pa.array(counts, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
                 pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "row_hash", "row_check", "n_words", "spans", "items"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = binary_text(docs, "doc_id", F.xxhash64("doc_id", "text").alias("row_hash"),
                       F.hash("doc_id", "text").alias("row_check"))
    return rows.mapInArrow(
        run, f"doc_id {kind}, row_hash long, row_check int, n_words long, spans {SPANS}, items array<string>")


def contaminated(docs, benchmark, size=SIZE):
    """One row per document: doc_id, n_words, spans (start word, words; sorted), items (sorted), n_hit (words hit once
    or more).

    Null and empty texts have no words and no hits; nor has any document if the benchmark is empty. Repeated rows are
    probed one by one, repeated items count once, a null item_id counts as an empty one.
    """
    parts, blocks = [], 1
    for pairs, blocks in _blocks(windows(benchmark, size)):
        frequency = _frequencies(docs, Index.shingles(pairs)) if pairs else {}
        parts.append(_probed(docs, Index(pairs, frequency)))
    rows = parts[0]
    if blocks > 1:
        # Every block gave one row per document; equal documents have equal spans and are counted.
        for part in parts[1:]:
            rows = rows.unionByName(part)
        rows = rows.groupBy("row_hash", "row_check").agg(
            F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.count("*").alias("copies"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        ).withColumn("copy", F.explode(F.sequence(F.lit(1), F.expr(f"int(copies / {blocks})"))))
    # Spans are sorted: each adds the words after the end of all before it.
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("end"))
    hit = F.aggregate("spans", start, lambda a, s: F.struct(
        (a.hit + F.greatest(F.lit(0), s.start + s.length - F.greatest(a.end, s.start))).alias("hit"),
        F.greatest(a.end, s.start + s.length).alias("end")), lambda a: a.hit)
    return rows.select("doc_id", "n_words", "spans", "items", hit.alias("n_hit"), "row_hash", "row_check")


def digest_items(items):
    """SHA-256 of the comma-joined items in hexadecimal digits."""
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def without_leaks(docs, benchmark, size=SIZE):
    """``docs`` without the documents that hold a benchmark window. All columns and all other rows stay."""

    columns, schema = docs.columns, docs.schema
    pairs_of = list(_blocks(windows(benchmark, size)))
    for pairs, _ in pairs_of:
        if not pairs:
            continue
        index = Index(pairs, _frequencies(docs, Index.shingles(pairs)))
        docs = docs.mapInArrow(_dropper(index), schema).select(*columns)
    return docs


def _dropper(index):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            clean = [not index.probe(_words(t.as_py() or b""))[0] for t in texts]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run
