"""Repeated passages against a version that reads the documents one after another."""

import random

from bandlore.llm import repeats as M
from bandlore.llm.queries import QUERIES


def forms(text):
    """Of the units of a text: what is digested, words, line, start and end."""
    found, out, before = M.units(text or ""), [], b""
    for (start, end, n, form), size, line in zip(found, found.sizes, found.lines):
        out.append(((before, form) if n < M.SHORT else form, size, line, start, end))
        before = form
    return out


def earlier_check(rows):
    """rows: (doc_id, text, spans) by rank. What may go and what must go, from all earlier texts one after the other.

    A removed unit must be of a line that stands earlier, or of a run of RUN_WORDS words that stands earlier as one. Lines
    that stand earlier must go.
    """
    lines, places, texts = set(), {}, []
    for number, (i, text, spans) in enumerate(rows):
        own = forms(text)
        texts.append([u[0] for u in own])
        by_line = {}
        for k, u in enumerate(own):
            by_line.setdefault(u[2], []).append(k)
        may, must = set(), set()
        for ks in by_line.values():
            whole = tuple(M.units(text)[k][3] for k in ks)
            if len(ks) > 1 and whole in lines or len(ks) == 1 and own[ks[0]][0] in places:
                must.update(ks)
            if len(ks) > 1:
                lines.add(whole)
            for k in ks:
                places.setdefault(own[k][0], []).append((number, k))
        gone = {k for k, u in enumerate(own) if any(a <= u[3] and u[4] <= b for a, b in spans)}
        # Stretches that follow an earlier place, this text's own included, from where they begin to be removed.
        for k in sorted(gone):
            if k in may:
                continue
            for other, place in places[own[k][0]]:
                if (other, place) >= (number, k):
                    break
                n = 0
                while k + n < len(own) and place + n < len(texts[other]) and texts[other][place + n] == own[k + n][0]:
                    n += 1
                if sum(u[1] for u in own[k:k + n]) >= M.RUN_WORDS:
                    may.update(range(k, k + n))
        assert must <= gone <= may | must, (i, sorted(gone - may - must), sorted(must - gone))
        assert all(any(own[k][3] == a for k in gone) and any(own[k][4] == b for k in gone) for a, b in spans)


def cut(text, spans):
    for a, b in reversed(spans):
        text = text[:a] + text[b:]
    return text


def got(df):
    rows = [(r.doc_id, r.text, [(s.start, s.end) for s in r.spans]) for r in df.collect()]
    return sorted(rows, key=lambda t: (t[0] is None, t[0]))


def test_query_over_documents(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op10_repeated_passages"](spark, small).collect()
    assert len(rows) == len(docs)
    spans = {r.doc_id: [tuple(map(int, s.split(":"))) for s in r.removed_spans.split(",") if s] for r in rows}
    assert all(r.text == cut(docs[r.doc_id], spans[r.doc_id]) for r in rows)
    earlier_check([(i, docs[i], spans[i]) for i in sorted(docs)])
    assert sum(bool(s) for s in spans.values()) > 20


def test_ranges_and_hot_digests(spark):
    """A line that most texts hold, over many ranges: the first keeps it, all others lose it."""
    hot = "the very same line of words stands here"
    texts = [(k, f"{hot}\nown words of number {k} and more\n{hot if k % 3 else 'an end'}") for k in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        rows = got(M.without_repeats(docs))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    earlier_check([(i, dict(texts)[i], s) for i, _, s in rows])
    assert [hot in text for _, text, _ in rows] == [True] + [False] * 399


def test_line_of_sentences_from_different_texts_stays(spark):
    rng = random.Random(6)
    parts = [passage(rng, 1) for _ in range(4)]
    texts = [(k, f"{passage(rng, 1)} {p} {passage(rng, 1)}") for k, p in enumerate(parts[:3])]
    texts += [(5, " ".join(parts[:3])), (6, " ".join(parts[:3])), (7, parts[3]), (8, parts[3])]
    rows = {i: text for i, text, _ in got(M.without_repeats(spark.createDataFrame(texts, "doc_id long, text string")))}
    assert rows[5] == " ".join(parts[:3]) and rows[6] == "" and rows[8] == ""


def passage(rng, n):
    return ". ".join(" ".join("".join(rng.choice("abcdeé") for _ in range(6)) for _ in range(9)).capitalize()
                     for _ in range(n)) + "."


def test_planted_passages_go_and_clean_text_stays(spark):
    rng = random.Random(9)
    shared = [passage(rng, 7) for _ in range(3)]
    clean = [passage(rng, 5) + "\n" + passage(rng, 4) for _ in range(30)]
    texts = []
    for i, text in enumerate(clean):
        cut = text.rfind(" ", 0, 150) + 1
        texts.append((i, text if i % 2 else text[:cut] + shared[i % 3] + " " + text[cut:]))
    rows = [(*t, 5, "x") for t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at int, marked string")
    for i, text, spans in got(M.without_repeats(docs)):
        if i % 2:
            assert text == clean[i] and not spans
        elif i >= 6:
            assert shared[i % 3] not in text and len(text) <= len(clean[i]) + 12
        else:
            assert shared[i % 3] in text or spans


def test_edges(spark):
    rng = random.Random(1)
    a, b = passage(rng, 6), passage(rng, 6)
    texts = [(1, a + "\n" + a), (2, None), (3, ""), (4, " \n "), (None, a), (5, "The end.\nThe end.\n" * 30), (6, "x " * 30_000),
             (7, b.replace(" ", "  ")), (8, b), (9, "the of. " + b)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = got(M.without_repeats(docs))
    assert all(text == (cut(dict(texts)[i], s) if dict(texts)[i] else dict(texts)[i]) for i, text, s in rows)
    earlier_check([(i, dict(texts)[i], s) for i, _, s in rows])
    twice = docs.unionByName(docs.where("doc_id in (7, 8)"))
    rows = [r for r in got(M.without_repeats(twice)) if r[0] in (7, 8)]
    assert [r[1] for r in rows] == [b.replace(" ", "  ")] * 2 + [""] * 2
    assert M.without_repeats(docs.where("false")).count() == 0
