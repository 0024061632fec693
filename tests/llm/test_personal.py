"""Personal data: the contract's patterns run plainly, the field against enumeration, edge cases."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from bandlore.llm import personal as M
from bandlore.llm.queries import QUERIES


def plain(text):
    """The patterns as they are written, with drops after the match."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 13, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            odd = sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
            if low <= len(digits) <= high and (kind == "phone" or odd % 10 == 0):
                out.append((kind, *m.span()))
    return out


def test_patterns_on_random_texts():
    rng = random.Random(8)
    parts = ["a", "@", ".", "b-c", "%", "+", "1", "22", "255", "256", "007", " ", "-", "(", ")", "4333656629848432", "é", "٣", "\n",
             "+1 (812) 555-9048", "x.y@z.com", "10.20.30.40", ".com", "@@", "4111 1111 1111 1111"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert M.base_spans(text) == plain(text), text


def test_query_over_documents(spark, small):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op9_personal_data"](spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain(docs[r.doc_id])
        names = [f"{k}:{a}:{b}" for k, a, b in want]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in want) for x in M.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(names) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (M.KINDS.index(s.split(":")[0]), int(s.split(":")[1])))
    assert sum(len(plain(t)) for t in docs.values()) > 40


def segmentations(island):
    """All ways to cut an island into segments, as lists of segment indices."""
    by_start = {}
    for s, (a, b) in enumerate(zip(island.a, island.b)):
        by_start.setdefault(a, []).append((s, b))

    def go(at):
        if at == len(island.tokens):
            yield []
        for s, b in by_start.get(at, []):
            for rest in go(b):
                yield [s, *rest]

    return list(go(0))


def test_dynamic_programming_matches_enumeration():
    rng = np.random.default_rng(2)
    text = "call 812-555-9048 or a@b.cd now 4"
    island = M.Island(text, 0, len(text))
    weights = rng.normal(size=(len(M.KINDS) + 1, M.WIDTH))
    scores = island.scores(weights)
    ways = []
    for way in segmentations(island):
        for labels in itertools.product(range(len(weights)), repeat=len(way)):
            total = sum(scores[k, s] for k, s in zip(labels, way))
            if np.isfinite(total):
                ways.append((total, [(k, island.a[s], island.b[s]) for k, s in zip(labels, way) if k]))
    assert island.best(weights) == max(ways, key=lambda w: w[0])[1]
    # The gradient by a feature of one label is the gold count less the expected count.
    gold = {(1, 2): 4, (3, 4): 1}
    log_z = np.logaddexp.reduce([w for w, _ in ways])

    def likelihood(w):
        s = island.scores(w)
        alls = [sum(s[k, j] for k, j in zip(labels, way)) for way in segmentations(island)
                for labels in itertools.product(range(len(w)), repeat=len(way))]
        at = {(a, b): j for j, (a, b) in enumerate(zip(island.a, island.b))}
        covered = {t for a, b in gold for t in range(a, b)}
        own = sum(s[k, at[key]] for key, k in gold.items()) + sum(
            s[0, at[t, t + 1]] for t in range(len(island.tokens)) if t not in covered)
        return own - np.logaddexp.reduce(alls)

    slope = island.slope(weights, gold)
    assert np.isfinite(log_z)
    feature = int(island.features[2][3])
    moved = weights.copy()
    moved[4, feature] += 1e-5
    want = (likelihood(moved) - likelihood(weights)) / 1e-5
    got = (slope[4][:, None] * (island.features == feature)).sum()
    assert got == pytest.approx(want, abs=1e-3)


def test_field_adds_forms_that_patterns_miss(spark, small):
    docs = spark.read.parquet(f"{small.replace('sf0.01', 'sf0.1')}/documents.parquet")
    model = M.train(docs)
    found = {t: [(k, t[a:b]) for k, a, b, base in model.spans(t) if not base] for t in (
        "please call 812-555-9048 today", "paid with 4333.6566.2984.8432 then", "in 2024 we had 4.0. of 12 cats",
        "order 123456789 from 10:30:00")}
    assert list(found.values()) == [[("phone", "812-555-9048")], [("card", "4333.6566.2984.8432")], [], []]


def test_edges(spark):
    rows = [(None, None, 1), (1, "", 1), (2, "a@b.cd " * 5000, 1), (2, "a@b.cd " * 5000, 1), (3, "x" * 60_000 + "@", 1),
            (4, "1" * 60_000, 1), (5, "é 10.0.0.1", 1), (6, "a@b.cd, a@b.cd", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    model = M.train(docs)
    got = M.found_spans(docs, model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.base] for r in got}
    assert by[None] == by[1] == by[3] == by[4] == [] and len(by[2]) == 5000 and by[5] == [("ip", 2, 10)]
    safe = M.masked(docs, model)
    assert safe.columns == docs.columns
    texts = {r.doc_id: r.text for r in safe.collect()}
    assert texts[6] == "[EMAIL], [EMAIL]" and texts[5] == "é [IP]" and texts[None] is None and texts[1] == ""
    assert M.masked_text("0123456789", [("card", 2, 6, True), ("phone", 4, 8, True)]) == "01[CARD]89"
    nothing = docs.where("false")
    assert M.train(nothing).weights is None
    assert M.found_spans(nothing, model).count() == M.masked(nothing, model).count() == 0
    assert M.Model(None).spans("a@b.cd 812-555-9048") == [("email", 0, 6, True)]
