"""Token counts through the digest cache against the library on whole texts."""

import random

from bandlore.llm import token_cache as M
from bandlore.llm.common import tokenizer_path
from bandlore.llm.queries import QUERIES


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_query_over_documents(spark, small):
    own = library()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op6_token_counts"](spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = len(own.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 2048)


def test_random_texts_and_small_memory(monkeypatch):
    monkeypatch.setattr(M, "REMEMBERED", 50)
    own, rng = library(), random.Random(2)
    with open(tokenizer_path(), encoding="utf-8") as file:
        counter = M.Counter(file.read())
    letters = [chr(c) for c in range(0x20, 0x7F)] + list("éßÅΣİ字한ñ́ 　\x1c\x85\x00\t\n 😀")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2500)]
    texts += ["a<|endoftext|>b, c. <|startoftext|>", "<|EndOfText|>", "don't. we're, 's"]
    got = counter.counts([t.encode() for t in texts])
    assert got == [len(own.encode(t, add_special_tokens=False).ids) for t in texts]


def test_cache_is_read_and_only_misses_are_added(spark, tmp_path):
    rows = [(1, "one two", "a"), (2, " one\n two ", "b"), (3, None, "c"), (None, "three", "d"), (5, "", "e"), (5, "x", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    cache = str(tmp_path / "cache")
    first = sorted(map(tuple, M.token_counts(docs, cache).collect()), key=str)
    assert [(r[0], r[2]) for r in first] == [(1, 2), (2, 2), (3, 0), (5, 0), (5, 1), (None, 1)]
    stored = spark.read.parquet(f"{cache}/*")
    assert stored.count() == 4
    more = docs.unionByName(spark.createDataFrame([(9, "one  two\t", "g"), (10, "new words here", "h")], docs.schema))
    M.token_counts(more, cache).collect()
    assert spark.read.parquet(f"{cache}/*").count() == 5
    # A stored count is used as it is.
    other = str(tmp_path / "other")
    version = next((tmp_path / "cache").iterdir()).name
    spark.createDataFrame([(bytearray(M._digest(b"one two")), 77)], M.CACHE).write.parquet(f"{other}/{version}")
    assert {r.doc_id: r.n_tokens for r in M.token_counts(docs, other).collect()}[2] == 77


def test_equal_rows_are_encoded_once(spark, tmp_path):
    rows = [(None, "the same text")] * 50 + [(4, "the same text")] * 7 + [(None, "another")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert {r.n_tokens for r in M.token_counts(docs, str(tmp_path)).collect()} == {3, 1}
    assert spark.read.parquet(f"{tmp_path}/*").count() == 2
    assert M.token_counts(docs, str(tmp_path)).count() == 58


def test_empty_table(spark):
    assert M.token_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
