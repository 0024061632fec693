"""Language ID: held-out accuracy, the word-first rule by hand, edge cases."""

import math
import random
import zlib

import pytest

from bandlore.llm import language as M
from bandlore.llm.queries import QUERIES


def test_held_out_accuracy(spark, small):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op2_language_id"](spark, small).collect()
    assert len(rows) == len(docs)
    right = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        lang, text = docs[r.doc_id].lang, docs[r.doc_id].text
        if r.held_out and lang and text:
            right.append(r.lang_pred == lang)
    assert len(right) > 150 and sum(right) >= 0.97 * len(right)


@pytest.fixture(scope="module")
def rows(spark):
    texts = [(i, lang, text) for i, (lang, text) in enumerate(
        [("en", "the cat and the dog sat on the mat"), ("en", "this is the house that they built with the old stones"),
         ("de", "der Hund und die Katze sind auf der Matte"), ("de", "das ist das Haus, das sie mit Steinen gebaut haben")] * 3)]
    return spark.createDataFrame(texts, "doc_id long, lang string, text string")


def test_words_first_then_runs(rows):
    model = M.train(rows)
    assert model.langs == ["de", "en"]
    n = {"the": 15, "all": sum(1 for _ in model.words)}
    mass = 3 * (9 + 11)
    assert model.word("the")[1] == pytest.approx(math.log((n["the"] + M.UNSEEN) / (mass + M.UNSEEN * n["all"])))
    seen = model.runs
    scores = [next(seen[w] for w in ("^und$"[i:i + k] for k in (4, 3, 2, 1)) if w in seen) for i in range(5)]
    del model.words["und"]
    assert model.word("und") == pytest.approx([2 * sum(s[x] for s in scores) / 5 for x in (0, 1)])
    assert model.predict("die Steine und der Hundekuchen")[0] == "de"
    assert model.predict("they sat with thatches")[0] == "en"


def test_bounded_memory_changes_nothing(rows, monkeypatch):
    texts = ["the old dog", "das Haus und", "unknown wörds here", "the the the"]
    want = [M.train(rows).predict(t) for t in texts]
    monkeypatch.setattr(M, "REMEMBERED", 4)
    model = M.train(rows)
    assert [model.predict(t) for t in texts * 2] == want * 2


def test_edges(spark, rows):
    model = M.train(rows)
    odd = [(None, None, 1), (1, "", 1), (2, "12 34 !? ___ ½ ²", 1), (3, "the " * 50_000, 1), (3, "the " * 50_000, 1), (4, "漢字", 1)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, score int")
    got = {r.doc_id: r for r in M.identify(docs, model).collect()}
    assert M.identify(docs, model).count() == 6
    assert [got[i].lang_pred for i in (None, 1, 2, 3)] == ["und", "und", "und", "en"] and got[1].score == 0
    kept = M.recognised(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {3}
    empty = rows.where("false")
    assert M.identify(empty, model).count() == 0
    assert {r.lang_pred for r in M.identify(docs, M.train(empty)).collect()} == {"und"}
    unlabelled = spark.createDataFrame([(1, None, "a b"), (2, "xx", None)], rows.schema)
    assert M.train(unlabelled).langs == []


def test_long_words_are_read_whole(spark):
    """A word is judged by all its letters, and a clause without spaces outweighs a short word."""
    rng = random.Random(3)
    make = lambda letters, n, m: " ".join("".join(rng.choice(letters) for _ in range(m)) for _ in range(n))
    rows = [(i, "aa" if i % 2 else "bb", make("abcd" if i % 2 else "wxyz", 40, 5)) for i in range(60)]
    model = M.train(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert model.predict("abcd" * 10 + "wxyz" * 250)[0] == "bb"
    assert model.predict("wxyz" * 10 + "abcd" * 250)[0] == "aa"
    assert model.predict("wxyzwx " * 3 + "abcd" * 200)[0] == "aa"


def test_small_language_beside_a_hot_one(spark):
    """A language with few texts keeps its terms whatever another has."""
    rng = random.Random(4)
    make = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(n))
    rows = [(i, "hot", make("abcdefghijkl", 300)) for i in range(300)]
    rows += [(1000 + i, "rare", make("αβγδεζηθ", 60)) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    model = M.train(docs, limit=2_000, words=500, runs=500)
    for text, lang in ((make("αβγδεζηθ", 20), "rare"), (make("abcdefghijkl", 20), "hot")):
        got, score = model.predict(text)
        assert got == lang and score > 0.9
