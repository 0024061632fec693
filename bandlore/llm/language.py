"""Language of whole texts: words first, shorter and shorter letter runs for unseen words.

A word that the model knows scores its log frequency in every language. An unseen word is read from left to right by
letter runs: at each place the longest known run of four letters or fewer scores, with marks for the word's ends. A word
of more than LONG letters, as a clause in a script without spaces, is read whole and counts as the several words that its
length makes. All counts come from one grouping of the training documents' words; the model is a bounded table sent to the
workers. Training texts and terms are shared out by language, so that a language with many texts takes none of the others'.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from bandlore.llm.common import rows_read, sampled, written

#: Most training documents, chosen by the hash of doc_id, and most words and letter runs of a model. Languages share them
#: equally, but each has LEAST words and runs and EACH documents if there are so many.
TRAINING, WORDS, RUNS, LEAST, EACH = 20_000, 60_000, 60_000, 2_000, 500
#: Longest letter run; letters of a word from which on it counts as several.
LONGEST, LONG = 4, 24
#: Words whose scores a worker remembers; it changes speed only.
REMEMBERED = 200_000
#: Share of a language's mass kept for words that it lacks.
UNSEEN = 0.1
LETTERS = re.compile(r"[^\W\d_]+")
UNDECIDED = "und"


def _runs(word):
    marked = f"^{word}$"
    return [marked[i:i + n] for n in range(1, LONGEST + 1) for i in range(len(marked) - n + 1)]


def _counted(docs):
    """(lang, kind, term, n): words and letter runs, summed in each task before they are shuffled."""

    def run(batches):
        from collections import Counter

        for langs, texts in rows_read(batches, "lang", "text"):
            words, grams = {}, {}
            for lang, text in zip(langs, texts):
                words.setdefault(lang, Counter()).update(LETTERS.findall(text.lower()))
            for lang, counted in words.items():
                of_lang = grams.setdefault(lang, Counter())
                for word, n in counted.items():
                    for gram in _runs(word):
                        of_lang[gram] += n
            rows = [(lang, kind, t, n) for kind, found in (("word", words), ("run", grams))
                    for lang, counted in found.items() for t, n in counted.items()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.string(),) * 3 + (pa.int64(),))],
                ["lang", "kind", "term", "n"])

    counted = docs.select("lang", "text").mapInArrow(run, "lang string, kind string, term string, n long")
    return counted.groupBy("lang", "kind", "term").agg(F.sum("n").alias("n"))


def _words(word):
    """As how many words a run of letters counts."""
    return max(1.0, len(word) / LONG)


class Model:
    """Log frequencies by language of known words and letter runs."""

    def __init__(self, langs, words, runs):
        self.langs, self.words, self.runs = langs, words, runs
        self.known, self.rows = {}, None
        self.floor = min([min(v) for v in runs.values()], default=-10.0)

    def __getstate__(self):
        return self.langs, self.words, self.runs

    def __setstate__(self, state):
        self.__init__(*state)

    def word(self, word):
        """Log frequency of a word in each language."""
        found = self.words.get(word)
        if found is not None:
            return found
        marked, total, runs = f"^{word}$", [0.0] * len(self.langs), 0
        for at in range(len(marked)):
            for n in range(LONGEST, 0, -1):
                found = self.runs.get(marked[at:at + n]) if at + n <= len(marked) else None
                if found is not None:
                    total = [a + b for a, b in zip(total, found)]
                    break
            else:
                total = [a + self.floor for a in total]
            runs += 1
        # The runs overlap; a word counts as much as two of them.
        return [2 * a / runs * _words(word) for a in total]

    def predict(self, text):
        """Language and its share of the evidence, 0 to 1."""
        words = LETTERS.findall((text or "").lower())
        if not self.langs or not any(c.isalpha() for w in words for c in w):
            return UNDECIDED, 0.0
        if self.rows is None or len(self.known) + len(words) > REMEMBERED:
            self.known, self.rows = {}, np.zeros((1024, len(self.langs)))
        known = self.known
        for w in words:
            if w not in known:
                at = known[w] = len(known)
                if at == len(self.rows):
                    self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
                self.rows[at] = self.word(w)
        total = self.rows[[known[w] for w in words]].sum(axis=0) / np.sqrt(sum(map(_words, words)))
        share = np.exp(total - total.max())
        best = int(share.argmax())
        return self.langs[best], float(share[best] / share.sum())


def _training(docs, limit):
    """Labelled rows, about ``limit``: of every language the same number if it has so many, chosen by the hash of doc_id."""
    rows = docs.where("text is not null and lang is not null").select("doc_id", "lang", "text")
    totals = rows.groupBy("lang").agg(F.count("*").alias("n"))
    known = totals.count()
    if not 0 < known <= limit // EACH:  # a column of many values names no languages
        return sampled(rows, limit)
    shares = [v for r in totals.collect() for v in (F.lit(r.lang), F.lit(min(1.0, limit / known / r.n)))]
    key = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_003))
    return rows.where(key < 1_000_003 * F.element_at(F.create_map(*shares), F.col("lang")))


def train(docs, limit=TRAINING, words=WORDS, runs=RUNS):
    """A model from the texts and languages of ``docs``; rows without text or language teach nothing.

    Of every language its most frequent terms are kept: an equal share of ``words`` words and ``runs`` letter runs, and
    LEAST at least. Without any language the model has none.
    """
    counts = written(_counted(_training(docs, limit)), "language-counts")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    kept, rank = {}, Window.partitionBy("lang").orderBy(F.desc("n"), "term")
    for kind, most in (("word", words), ("run", runs)):
        terms = counts.where(F.col("kind") == kind)
        # Counts of a bounded sample: a language's terms fit into a task.
        often = terms.withColumn("rank", F.row_number().over(rank)).where(
            F.col("rank") <= max(LEAST, most // max(1, len(langs)))).select("term").distinct()
        kept[kind] = terms.join(often, "term").groupBy("term").agg(
            F.sum("n").alias("all"), F.collect_list(F.struct("lang", "n")).alias("by")).where("all > 1").collect()

    def scored(found):
        mass = dict.fromkeys(langs, 0)
        for r in found:
            for b in r.by:
                mass[b.lang] += b.n
        out = {}
        for r in found:
            n = {b.lang: b.n for b in r.by}
            out[r.term] = [float(np.log((n.get(x, 0) + UNSEEN) / (mass[x] + UNSEEN * len(found)))) for x in langs]
        return out

    return Model(langs, scored(kept["word"]), scored(kept["run"]))


def identify(docs, model, *keep):
    """doc_id, the ``keep`` columns, lang_pred and score of every document; only the text is read for a prediction.

    ``und`` and 0 for null texts and texts without a letter, or if the model knows no language. Ties go to the language
    that sorts first. Repeated rows are judged alike, one by one; texts and words of any length are read whole.
    """

    def run(batches):
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column("text")]
            columns = [batch.column(c) for c in ("doc_id", *keep)]
            yield pa.record_batch(
                [*columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", *keep, "lang_pred", "score"])

    rows = docs.select("doc_id", *keep, "text")
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", *keep))
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def recognised(docs, model, least=0.5):
    """``docs`` without documents of no recognisable language (``und``, or a score below ``least``)."""
    columns, schema = docs.columns, docs.schema

    def run(batches):
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column("text")]
            yield batch.filter(pa.array([lang != UNDECIDED and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, schema).select(*columns)
