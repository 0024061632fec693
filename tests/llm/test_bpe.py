"""The backtracking encoder against the library whose vocabulary it reads."""

import hashlib
import random

import pytest

from bandlore.llm import bpe
from bandlore.llm.queries import QUERIES

LETTERS = [chr(c) for c in range(0x20, 0x7F)] + list(
    "éèßÄÖÅΣςİıſK𝔄字漢あ한ñó́ 　​ẞǅ٣½²Ⅷ\x1c\x1f\x85\x00\t\n 😀🇩👍🏽")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.tokenizer_path())


@pytest.fixture(scope="module")
def own():
    with open(bpe.tokenizer_path(), encoding="utf-8") as file:
        return bpe.encoder(file.read())


def test_random_texts(library, own):
    rng = random.Random(1)
    names = [t.replace(bpe.WORD_END, "") for t in library.get_vocab()]
    for k in range(15_000):
        pool = LETTERS if k % 2 else names
        text = "".join(rng.choice(pool) for _ in range(rng.randint(1, 12 if k % 2 else 4)))
        text += "<|endoftext|>" + text if k % 17 == 0 else "<|ENDOFTEXT|>'s" if k % 19 == 0 else ""
        want = library.encode(text, add_special_tokens=False).ids
        assert own.ids(text.encode()) == want, text
        assert own.decode(want).decode() == library.decode(want, skip_special_tokens=False)


def test_bounded_memory_changes_nothing(library, own, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own.known.clear()
    text = "one two, three. four five six seven, eight nine ten, one two three, four. " * 3
    assert own.ids(text.encode()) == library.encode(text, add_special_tokens=False).ids
    assert len(own.known) <= 3


def test_long_word(library, own):
    text = "abcthingsandmore" * 3000 + " " + "a" * 5000
    assert own.ids(text.encode()) == library.encode(text, add_special_tokens=False).ids


def test_query_over_documents(spark, small, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op8_bpe_round_trip"](spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_edges(spark, library):
    rows = [(None, None, 1), (1, "", 1), (1, "", 1), (2, " \n", 1), (3, "Hello, <|endoftext|> world", 1), (4, "x" * 40_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = {r.doc_id: list(r.ids) for r in bpe.encode(docs).collect()}
    assert got[None] == got[1] == got[2] == []
    for i, text, _ in rows[4:]:
        assert got[i] == library.encode(text, add_special_tokens=False).ids
    texts = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs)).collect()}
    assert texts[3] == library.decode(got[3], skip_special_tokens=False) and texts[1] == ""
    nothing = docs.where("false")
    assert bpe.encode(nothing).count() == bpe.round_trip_digests(nothing).count() == 0
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first().text is None
