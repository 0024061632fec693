"""Line-first cleaning against plain Python."""

import re
from collections import Counter

from compare import compare, connect

from bandlore.llm import quality as M
from bandlore.llm.queries import ORACLE, QUERIES


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_query_matches_sql_and_python(spark, small):
    rows, problem = compare(spark, connect(small), small, "op7", QUERIES["op7_line_quality"], ORACLE["op7_line_quality"])
    assert not problem and rows == 1000
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in QUERIES["op7_line_quality"](spark, small).collect():
        want = base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_labelled_good_documents_are_kept(spark, small):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    got = [(labels[r.doc_id], r.kept, r.base_failed) for r in QUERIES["op7_line_quality"](spark, small).collect()
           if r.doc_id in labels]
    good = [k or b for q, k, b in got if q == 1]
    assert sum(good) >= 0.99 * len(good)
    bad = [k for q, k, _ in got if q == 0]
    assert sum(bad) <= 0.1 * len(bad)


def prose_line(i):
    return f"Line {i} says " + " ".join(f"word{i}x{k}" for k in range(12)) + ", and that is all."


def test_lines(spark):
    prose = [prose_line(i) for i in range(8)]
    page = ["Home | About | News | Contact", prose[0], "", "All rights reserved.", "WHAT!! A!! LINE!!", *prose[1:4],
            "Prices rose 5% while A & B fell; \"stop!\" they said."]
    junk = [" ".join(f"{w}{i}x{k}{m}" for k, (w, m) in enumerate(zip("abcdefgh", ("##", "**", "$$", "%%", "&&", "##", "", ""))))
            for i in range(9)]
    rows = [(1, "\n".join(page)), (2, "\n".join(junk + prose[:2])), (3, None), (4, ""), (5, " \n\t"),
            (None, "\n".join(prose)), (6, "\n".join(prose)), (6, "\n".join(prose)), (7, "w " * 20_000)]
    docs = spark.createDataFrame([(*r, [1], "x") for r in rows], "doc_id long, text string, words array<int>, kept string")
    got = {r.doc_id: r for r in M.cleaned(docs).collect()}
    assert M.cleaned(docs).count() == len(rows)
    assert got[1].text.split("\n") == [page[1], "", *page[5:]] and got[1].kept
    assert not got[2].kept and not got[2].base_failed
    assert got[3].text is None and got[3].base_failed and got[3].n_words == 0
    assert got[4].text == "" and got[5].n_words == 0 and got[None].kept and got[6].kept
    assert got[7].n_repeat_words == 20_000 and not got[7].kept
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(t)
    assert M.cleaned(docs.where("false")).count() == 0


def test_no_python_in_the_plan(spark, small):
    plan = QUERIES["op7_line_quality"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
