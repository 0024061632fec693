"""Toxicity: the automaton against edit distances, held-out labels, contexts, edge cases."""

import random
import zlib

import numpy as np
import pytest

from bandlore.llm import toxicity as M
from bandlore.llm.queries import QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_matches_edit_distance():
    rng = random.Random(3)
    terms = ["stupid", "stump", "scum", "trash", "thrash", "loweé*", "moro*", "ab"]
    automaton = M.Automaton(terms)
    words = set()
    for t in terms:
        t = t.removesuffix("*")
        for _ in range(300):
            w = list(t)
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(w) + 1)
                w[at:at + rng.randint(0, 1)] = rng.choice(["", "s", "t", "x", "é", "u1"])
            words.add("".join(w) + rng.choice(["", "", "n", "xyz"]))
    words = sorted(w for w in words if w and w.isalnum())
    codes, starts, lengths = M._words(" ".join(words))
    assert len(starts) == len(words)
    hit, term, wrong = automaton.match(codes, starts, lengths)
    got = {words[h]: (automaton.terms[t], bool(w)) for h, t, w in zip(hit, term, wrong)}
    for w in words:
        stem = [t for t in terms if t.endswith("*") and w.startswith(t[:-1])]
        near = [t for t in terms if not t.endswith("*") and len(t) >= M.FUZZY and distance(w, t) == 1]
        if w in terms:
            assert got[w] == (w, False)
        elif stem:
            assert got[w] == (stem[0], False)
        elif near:
            assert got[w][0] in near and got[w][1]
        else:
            assert w not in got, w


def test_held_out_labels(spark, small):
    small = small.replace("sf0.01", "sf0.1")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    rows = QUERIES["op3_toxicity"](spark, small).collect()
    assert len(rows) == len(docs)
    seen = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        if r.held_out and labels.get(r.doc_id) is not None and docs[r.doc_id]:
            seen.append((labels[r.doc_id], r.predicted))
    assert sum(y for y, _ in seen) >= 50
    assert sum(p for y, p in seen if y) >= 0.8 * sum(y for y, _ in seen)
    assert sum(p for y, p in seen if not y) <= 0.005 * len(seen)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("aeioubdfgklmnprst") for _ in range(6)) for _ in range(400)]
    texts = []
    for i in range(240):
        w = [rng.choice(words) for _ in range(60)]
        if i % 6 == 0:
            for at in rng.sample(range(60), 4):
                w[at] = rng.choice(["stupid", "moronic", "garbage"])
        texts.append((i, " ".join(w), int(i % 6 == 0)))
    docs = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    return docs.drop("toxic"), docs.select("doc_id", "toxic"), words


def test_spelling_and_context(tables):
    docs, labels, words = tables
    model = M.train(docs, labels)
    assert set(model.terms) == {"stupid", "moronic", "garbage"}
    plain = " ".join(words[:40])
    abuse = plain + " you stupid moronic garbage"
    misspelled = plain + " you stup1d moronnic grbage"
    quoted = plain + " the paper printed \"stupid moronic garbage\" yesterday"
    reported = plain + " he called them stupid"
    scores = [model.score(t) for t in (abuse, misspelled, quoted, reported, plain, "", None)]
    assert scores[0] >= 0.7 and scores[1] >= 0.7
    assert scores[0] > scores[1] > scores[2] > scores[4] and scores[3] < model.score(plain + " you all stupid")
    assert scores[4] == scores[5] == scores[6] < 0.2


def test_window_is_the_densest():
    automaton = M.Automaton(["stupid"])
    text = " ".join(["stupid"] + ["x"] * 50 + ["stupid", "y", "stupid"])
    total, peak, n = M.evidence(automaton, text)
    assert (total, peak, n) == (3.0, 2.0, 3)
    assert np.array_equal(M._words("ab, c1d\né")[2], [2, 3, 1])


def test_edges(spark, tables):
    docs, labels, _ = tables
    model = M.train(docs, labels)
    odd = [(None, None, 1), (1, "", 1), (2, "stupid " * 40_000, 1), (2, "stupid " * 40_000, 1), (3, "😀 𝔄𝔅 漢字", 1)]
    more = spark.createDataFrame(odd, "doc_id long, text string, score int")
    rows = M.scored(more, model).collect()
    assert len(rows) == 5 and {r.predicted for r in rows if r.doc_id == 2} == {1}
    assert all(r.predicted == 0 for r in rows if r.doc_id != 2)
    assert M.scored(more.where("false"), model).count() == 0
    nothing = M.train(docs, labels.where("toxic = 0"))
    assert {r.score < 0.01 for r in M.scored(docs, nothing).collect()} == {True}
    assert M.train(docs.where("false"), labels).terms == []
    nulls = labels.unionByName(spark.createDataFrame([(None, 1), (1, None), (7, 5)], labels.schema))
    assert M.train(docs, nulls).terms == model.terms


def hits(terms, text):
    lowered = text.lower()
    automaton = M.Automaton(terms)
    codes, starts, lengths = M._words(lowered)
    hit, term, wrong = automaton.match(codes, starts, lengths)
    return M._context(lowered, codes, starts, lengths, hit, wrong, automaton.worth[term])


def test_signs_beside_words():
    assert hits(["scum", "idiot"], "scum😀 idiot😀😀 you 😀scum") == [1.0] * 3
    assert hits(["scum"], "𝔄scum scum𝔄") == []  # letters beyond the basic plane are letters


def test_quotations_are_pairs():
    full, quoted = [1.0, 1.0], [M.QUOTED, M.QUOTED]
    terms = ["idiot", "scum"]
    for text in ('5" idiot scum', 'a 5" nail, you idiot, 6" scum', '"idiot scum', "“ idiot scum", "idiot » scum",
                 'x "y\nidiot scum" z', '"" idiot scum', 'idiot scum "'):
        assert hits(terms, text) == full, text
    for text in ('"idiot scum"', 'then ("idiot scum").', "„idiot scum“ x", "„idiot scum” x", "“idiot scum” x",
                 "« idiot scum »", "»idiot scum«", "”idiot scum”", '"a “b” idiot scum"', '5" and "idiot scum"'):
        assert hits(terms, text) == quoted, text
    assert hits(terms, 'a "b" idiot "c" scum') == full
    assert hits(terms, '"idiot" scum') == [M.QUOTED, 1.0]
    assert len(hits(terms, '"a ' * 100_000 + "idiot")) == 1  # many open marks cost no more than few


def made(spark, texts):
    docs = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(texts)], "doc_id long, text string, toxic int")
    return docs.select("doc_id", "text"), docs.select("doc_id", "toxic")


def spelled(rng, letters="aeioubdfgklmnprst", n=8):
    return "".join(rng.choice(letters) for _ in range(n))


def test_many_rare_terms(spark):
    """Each of 300 slurs stands in about 15 of 1,500 toxic texts; chance finds no term among the clean words."""
    rng = random.Random(17)
    slurs = sorted({spelled(rng, "bcdfghjklmnpqrtvwxz") for _ in range(300)})
    words = sorted({spelled(rng) for _ in range(4000)})
    texts = [(" ".join(rng.sample(words, 30) + (rng.sample(slurs, 3) if i < 1500 else [])), int(i < 1500))
             for i in range(12_000)]
    docs, labels = made(spark, texts)
    model = M.train(docs, labels)
    assert sum(s in model.terms for s in slurs) >= 0.98 * len(slurs)
    assert not set(model.terms) & set(words)
    clean = " ".join(words[:30])
    known = [s for s in slurs if s in model.terms]
    assert min(model.score(f"{clean} {a} {b} {clean}") for a, b in zip(known, reversed(known))) >= 0.7
    assert model.score(clean) < 0.1


def test_repeated_texts_are_one(spark):
    """A word in one toxic text, a hundred times over, is no term; one in many texts is."""
    rng = random.Random(4)
    words = [spelled(rng) for _ in range(500)]
    once = " ".join(rng.sample(words, 40)) + " solitary"
    near = once.split()
    texts = [(once, 1)] * 100 + [(" ".join([*near[:i], "changed", *near[i + 1:]]), 1) for i in range(40)]
    texts += [(" ".join(rng.sample(words, 40)) + " awfulness", 1) for _ in range(30)]
    texts += [(" ".join(rng.sample(words, 40)), 0) for _ in range(400)]
    docs, labels = made(spark, texts)
    terms = M.train(docs, labels).terms
    assert "awfulness" in terms and not {"solitary", *near} & set(terms)
    assert {t.removesuffix("*") for t in terms} <= {"awfulness"[:n] for n in (8, 9)}


def test_misspelled_inflections(spark):
    """A beginning is taken for its inflections, and their misspellings are found all the same."""
    rng = random.Random(8)
    words = [spelled(rng) for _ in range(500)]
    forms = ["idiot", "idiots", "idiotic", "idiocy"]
    texts = [(" ".join(rng.sample(words, 40)) + " " + forms[i % 4], 1) for i in range(80)]
    texts += [(" ".join(rng.sample(words, 40)), 0) for _ in range(400)]
    model = M.train(*made(spark, texts))
    assert {"idio*", "idiot", "idiots", "idiotic", "idiocy"} <= set(model.terms)
    for word in ("idiots", "idiotisch", "1diots", "idxots", "idiottic", "idocy"):
        assert M.evidence(model.automaton, f"you {word} there")[2] == 1, word
    for word in ("radio", "ideology", "video", "idxo"):
        assert M.evidence(model.automaton, f"you {word} there")[2] == 0, word


def test_lexicon_and_scores_by_brute_force(spark, tables):
    """Terms counted one by one, hits by edit distance to every term, windows by trying all of them."""
    docs, labels, _ = tables
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    with_stem = {i: t.replace("garbage", "garbageman") if i % 4 == 0 else t for i, t in texts.items()}
    docs = spark.createDataFrame(list(with_stem.items()), "doc_id long, text string")
    model = M.train(docs, labels)

    stands = {}
    for i, text in with_stem.items():
        for w in set(text.split()):
            for t in {w} | {w[:n] + "*" for n in M.STEMS if n < len(w)}:
                stands.setdefault(t, set()).add(i)
    stands = {t: ids for t, ids in stands.items() if len(ids) >= M.SUPPORT}
    toxic = sum(truth.values())
    share = toxic / len(truth)
    strong = {}
    reach = np.array([len(ids) for ids in stands.values()]) * -np.log(share)
    least = min(x for x in [*np.log(np.arange(1, len(reach) + 1) / M.CHANCE), *np.nextafter(reach, np.inf)]
                if (reach >= x).sum() * np.exp(-x) <= M.CHANCE * (1 + 1e-9))
    for t, ids in stands.items():
        a = sum(truth[i] for i in ids)
        b, n = len(ids) - a, len(ids)
        ratio = (a / toxic) / ((b + 0.5) / (len(truth) - toxic))
        if a >= M.SUPPORT and ratio >= M.RATIO:
            bound = (a / n / share) ** -a * (b / n / (1 - share)) ** -b if b else share ** a
            if -np.log(bound) >= least:
                strong[t] = a * np.log(ratio)
    assert set(model.terms) <= set(strong)
    for t in strong:  # what is not taken stands beside a term that begins alike and is at least as strong
        word = t.removesuffix("*")
        assert t in model.terms or any(
            strong[u] >= strong[t] - 1e-9 and (u.startswith(word) or u.endswith("*") and word.startswith(u[:-1]))
            for u in model.terms), t

    worth = dict(zip(model.terms, model.automaton.worth.tolist()))
    rng = random.Random(2)
    strange = ["stup1d", "stupidd", "moronicx", "garbag", "garbagemen", "garbagetruck", "mronic", "xstupidx"]
    for text in [*list(with_stem.values())[:40], *(" ".join(rng.choices(strange, k=9)) for _ in range(20))]:
        got = []
        for w in text.split():
            stems = [t for t in worth if t.endswith("*") and w.startswith(t[:-1])]
            near = [t for t in worth if not t.endswith("*") and len(t) >= M.FUZZY and distance(w, t) == 1]
            got.append([worth[w]] if w in worth else [worth[t] for t in stems]
                       or [M.MISSPELLED * worth[t] for t in near] or [0.0])
        if any(len(set(g)) > 1 for g in got):
            continue  # two terms one edit away: either is right
        flat = [g[0] for g in got]
        total, peak, _ = M.evidence(model.automaton, text)
        assert total == pytest.approx(sum(flat))
        assert peak == pytest.approx(max(sum(flat[i:i + M.WINDOW]) for i in range(len(flat))))
