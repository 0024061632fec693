"""Token counts of whole texts through a cache keyed by the digests of normalised content and tokenizer.

The cache is a Parquet table (tokenizer, digest, n_tokens), partitioned by tokenizer. Texts are normalised in a way that
cannot change their count (runs of white space become one space) and digested. The digests are joined to the cache; of
those that it lacks, one text each is encoded and the count is appended. Only digests and counts are shuffled, and the
one text of each missing digest; copies never are.
"""

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from bandlore.llm.common import LOWER, binary_text, stable, tokenizer_path, written
from bandlore.session import scratch_path

#: Words whose count a worker remembers.
REMEMBERED = 600_000
CACHE = "digest binary, n_tokens long"
_counters = {}


def _digest(text):
    return hashlib.blake2b(b" ".join(text.split()), digest_size=16).digest()


class Counter:
    """Counts of texts, by a library's tokenizer on the distinct words between white space."""

    def __init__(self, text):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.known = {}

    def _encode(self, texts):
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words):
        """Runs of plain letters are encoded side by side, and told apart by the tokens that end a word."""
        plain = [w for w in words if w.isalpha()]
        for at in range(0, len(plain), 256):
            part = plain[at:at + 256]
            last = np.flatnonzero(self.ends[self._encode([b" ".join(part).decode()])[0]])
            self.known.update(zip(part, np.diff(last, prepend=-1).tolist(), strict=True))
        other = [w for w in words if not w.isalpha()]
        self.known.update(zip(other, map(len, self._encode([w.decode("utf-8", "replace") for w in other]))))

    def counts(self, texts):
        """Token counts of UTF-8 texts. No token spans white space, so a text has the sum of its words."""
        out = []
        for at in range(0, len(texts), 200):
            split = [(t if b"<|" in t else t.translate(LOWER)).split() for t in texts[at:at + 200]]
            known = self.known
            words = {w for text in split for w in text}
            if len(known) + len(words) > REMEMBERED:
                known.clear()
            words = {w for w in words if w not in known}
            marked = {w for w in words if w[-1:] in (b",", b".") and w[:-1].isalpha()}
            self._learn(((words - marked) | {w[:-1] for w in marked} | {w[-1:] for w in marked}) - known.keys())
            for w in marked:
                known[w] = known[w[:-1]] + known[w[-1:]]
            out += [sum([known[w] for w in text]) for text in split]
        return out


def _counter(text):
    key = hashlib.md5(text.encode()).hexdigest()
    if key not in _counters:
        _counters[key] = Counter(text)
    return _counters[key]


def _digested(docs):
    """doc_id, n_bytes, digest and, for those who read it, the text as bytes."""

    def run(batches):
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column("text")]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(map(len, texts), pa.int64()),
                 pa.array(map(_digest, texts), pa.binary()), pa.array(texts, pa.binary())],
                ["doc_id", "n_bytes", "digest", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return binary_text(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, n_bytes long, digest binary, text binary")


def _digests(docs):
    """As ``_digested`` without the text, which then never leaves the worker."""

    def run(batches):
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column("text")]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(map(_digest, texts), pa.binary())],
                ["doc_id", "n_bytes", "digest"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return binary_text(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, n_bytes long, digest binary")


def _encoded(rows, vocabulary):
    """digest and n_tokens of the texts of ``rows``: a task passes over digests that it has had, and one row of each stays."""

    def run(batches):
        own, seen = _counter(vocabulary), set()
        for batch in batches:
            fresh = []
            for digest in batch.column("digest").to_pylist():
                fresh.append(digest not in seen)
                seen.add(digest)
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            counts = own.counts([t.as_py() for t in batch.column("text")])
            yield pa.record_batch([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return rows.mapInArrow(run, "digest binary, n_tokens long").groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs, cache=None, path=None, limit=2048):
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every whole text; null counts as empty.

    ``cache`` is the folder of a cache kept between runs; without it the run starts a new one in the shared folder.
    ``path`` is the vocabulary file. One row for each row of ``docs``, in any order, repeated rows and ids included; of
    rows that share doc_id (null too) and text one is encoded. Texts of any length count whole. Columns other than doc_id
    and text are not returned. An empty table gives no rows.
    Counts missing from the cache are appended in one atomic write; a run that dies before leaves the cache as it was.
    """
    spark = docs.sparkSession
    with open(path or tokenizer_path(), encoding="utf-8") as file:
        vocabulary = file.read()
    version = hashlib.blake2b(vocabulary.encode(), digest_size=16).hexdigest()
    stored = f"{cache or scratch_path(spark, 'token-cache')}/{version}"
    spark.createDataFrame([], CACHE).write.mode("append").parquet(stored)
    digests = written(_digests(docs), "digests")
    missing = digests.join(spark.read.schema(CACHE).parquet(stored), "digest", "left_anti")
    missing = missing.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    texts = _digested(docs).select("doc_id", "digest", "text").alias("t")
    one_each = texts.join(
        missing.alias("m"), F.expr("t.doc_id <=> m.doc_id and t.digest = m.digest"), "left_semi").select("digest", "text")
    _encoded(one_each, vocabulary).write.mode("append").parquet(stored)
    known = spark.read.schema(CACHE).parquet(stored).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    # Written, so that the join shuffles both sides anew and a hot digest can be split.
    return digests.join(stable(known), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
