"""Benchmark windows against SQL and a scan of all windows."""

import random
import re

from compare import compare, connect

from bandlore.llm import decontaminate as M
from bandlore.llm.queries import ORACLE, QUERIES


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(texts, items):
    wins = {}
    for item, text in items:
        w = words(text)
        for at in range(max(len(w) - 10, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[at:at + 10]), set()).add(str(item) if item is not None else "")
    out = []
    for i, text in texts:
        w, hit, owners = words(text), set(), set()
        for win, own in wins.items():
            for at in range(len(w) - len(win) + 1):
                if tuple(w[at:at + len(win)]) == win:
                    hit.update(range(at, at + len(win)))
                    owners |= own
        out.append((i, len(w), len(hit), tuple(sorted(owners))))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect()), key=str)


def test_query_matches_sql(spark, small):
    name = "op5_benchmark_overlap"
    rows, problem = compare(spark, connect(small), small, name, QUERIES[name], ORACLE[name])
    assert not problem and rows == 1000
    assert QUERIES[name](spark, small).where("contaminated").count() > 5


def made(spark):
    """Few words, so that windows overlap, repeat and share their rarest shingles."""
    rng = random.Random(4)
    vocabulary = ["a", "B", "c", "é", "9"]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, text(rng.choice([1, 2, 3, 9, 10, 12, 30]) + 2)) for i in range(12)]
    items += [(3, items[0][1]), (20, items[0][1]), (None, items[5][1]), (21, None), (22, " ?!"), (23, "x")]
    texts = [(i, text(rng.randint(0, 40))) for i in range(60)]
    texts += [(i, text(5) + "," + items[i % 12][1].upper().replace("É", "é") + ";" + text(3)) for i in range(60, 80)]
    texts += [(90, None), (None, items[4][1]), (91, ""), (91, ""), (92, items[4][1]), (92, items[4][1]), (93, "zzz " * 20_000)]
    return (spark.createDataFrame([(*t, 1, "n") for t in texts], "doc_id long, text string, n_words int, item_id string"),
            spark.createDataFrame([(*t, "d") for t in items], "item_id int, text string, doc_id string"), texts, items)


def test_made_texts_in_one_and_many_blocks(spark, monkeypatch):
    docs, bench, texts, items = made(spark)
    want = brute(texts, items)
    assert got(M.contaminated(docs, bench)) == want
    monkeypatch.setattr(M, "BLOCK_ROWS", 20)
    assert got(M.contaminated(docs, bench)) == want
    kept = M.without_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((w[0] for w in want if not w[2]), key=str)


def test_empty_tables(spark):
    docs, bench, texts, _ = made(spark)
    assert M.contaminated(docs.where("false"), bench).count() == 0
    none = M.contaminated(docs, bench.where("false"))
    assert got(none) == brute(texts, [])
    assert M.without_leaks(docs, bench.where("false")).count() == len(texts)
