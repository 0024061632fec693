"""The corpus pipeline, stage by stage, against brute force on the stage's own input."""

import pytest
from test_decontaminate import brute as leaks
from test_simhash import brute_components

import corpus_pipeline as P
from bandlore.llm import bpe, language, personal, simhash


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    """The input and result of every stage, each read back from Parquet."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), {}
    for name, stage in P.STAGES:
        stage(spark, docs, small).write.parquet(str(folder / name))
        result = spark.read.parquet(str(folder / name))
        out[name] = (docs, result)
        docs = result
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_rows_are_kept(stages):
    for name, (before, after) in stages.items():
        if name != "encoding":
            assert after.dtypes == before.dtypes
    old, new = (rows(x) for x in stages["decontamination"])
    assert all(new[i] == old[i] for i in new)


def test_language_stage(stages):
    before, after = stages["language_id"]
    model = language.train(before)
    old, new = rows(before), rows(after)
    verdict = {i: model.predict(r.text) for i, r in old.items()}
    assert set(new) == {i for i, (lang, score) in verdict.items() if lang != "und" and score >= 0.5}
    assert len(new) >= 0.98 * len(old)


def test_near_dedup_stage(stages):
    before, after = stages["near_dedup"]
    old = rows(before)
    prints = {i: simhash._simhash((r.text or "").encode(), P.NEAR_WORDS) & (1 << 64) - 1 for i, r in old.items()}
    root = brute_components(set(prints.values()), P.NEAR_BITS)
    low = {}
    for i, p in prints.items():
        low[root[p]] = min(low.get(root[p], i), i)
    assert set(rows(after)) == set(low.values())
    texts = {}
    for i, r in old.items():
        texts.setdefault(r.text, []).append(i)
    kept = set(rows(after))
    assert all(len(kept & set(same)) <= 1 for same in texts.values())


def test_near_dedup_keeps_columns_of_any_name(spark):
    """Clashing column names, very long texts, ties and repeated rows."""
    long = "word " * 40_000
    texts = [(3, long, "a"), (2, long, "b"), (2, long, "b"), (5, "quite another text here", "c"), (None, long, "d"), (7, None, "e"),
             (6, "", "f")]
    docs = spark.createDataFrame([(*t, 4, f"{t[2]}2", 1.5, "r") for t in texts],
                                 "doc_id long, text string, lang string, row_hash int, _copy string, copy double, root string")
    got = simhash.one_per_group(docs, P.NEAR_WORDS, P.NEAR_BITS)
    assert got.dtypes == docs.dtypes
    assert sorted((r.doc_id, r.lang, r.row_hash, r["_copy"], r["copy"], r.root) for r in got.collect()) == [
        (2, "b", 4, "b2", 1.5, "r"), (5, "c", 4, "c2", 1.5, "r"), (6, "f", 4, "f2", 1.5, "r")]


def test_decontamination_stage(spark, small, stages):
    before, after = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    texts = [(r.doc_id, r.text) for r in before.collect()]
    assert set(rows(after)) == {i for i, _, hit, _ in leaks(texts, items) if not hit}


def test_personal_stage(stages):
    before, after = stages["personal_data"]
    model = personal.train(before)
    old, new = rows(before), rows(after)
    assert set(old) == set(new)
    for i, r in old.items():
        assert new[i].text == personal.masked_text(r.text, model.spans(r.text))
        if not personal.SEED.search(r.text):
            assert new[i] == r
    assert sum(old[i].text != new[i].text for i in old) > 10


def test_encoding_stage(stages):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.tokenizer_path())
    before, after = stages["encoding"]
    texts = rows(before)
    found = after.collect()
    assert len(found) == len(texts)
    for r in found:
        assert list(r.ids) == library.encode(texts[r.doc_id].text, add_special_tokens=False).ids == list(r.ids)[:r.n_tokens]


def test_run_gives_the_last_stage(spark, small, stages):
    def comparable(df):
        return sorted((r.doc_id, tuple(r.ids)) for r in df.collect())

    assert comparable(P.run(spark, small)) == comparable(stages["encoding"][1])


def test_empty_and_null_rows(spark, small, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.read.parquet(f"{small}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    odd = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "the same text here", "en", None, 18),
           (2, "the same text here", "en", None, 18), (3, "ein anderer Text ist das", "de", "b", None)]
    for data, kept in ((odd, [2, 3]), ([], [])):
        docs = spark.createDataFrame(data, schema)
        for _, stage in P.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        assert sorted(r.doc_id for r in docs.collect()) == kept
