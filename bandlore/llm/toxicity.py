"""Toxicity of whole texts by a learned lexicon, misspellings included, and the context of each hit.

The lexicon is a trie of words and word beginnings that labelled toxic documents hold far more often than others, by a
test that is corrected for the number of terms tried. It is intersected with the Levenshtein automata of its words: a
state is a set of (trie node, edits so far), and the sets met are numbered once, as they are met, which gives one
deterministic table for the whole lexicon. All words of a batch run through the table letter by letter, together.

A hit counts by how strongly its term speaks for the label, less if misspelled, and less inside a quotation or after a reporting word. The sum of a document
and its densest window of words go into a logistic regression fitted on the labels.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from bandlore.llm.common import rows_read, sampled, written

#: Most labelled training documents (by hash of doc_id).
TRAINING = 20_000
#: A term stands in this many distinct toxic texts at least, is this much likelier there, and the chance that any of
#: the terms tried looks as strong without being so is at most this.
SUPPORT, RATIO, CHANCE = 3, 10.0, 0.05
#: How much likelier a term is that counts in full; others count by their logarithm.
FULL = 200.0
#: Five-word shingles, and bands of two smallest hashes of them, by which near copies in the training texts are found.
SHINGLE, BANDS = 5, 4
#: Lengths of word beginnings; shortest word that may be misspelled by one edit.
STEMS, FUZZY = (3, 4, 5, 6, 7, 8), 5
#: Words in a window; what a misspelled, a quoted and a reported hit counts.
WINDOW, MISSPELLED, QUOTED, REPORTED = 40, 0.6, 0.3, 0.5
#: Words before a hit among which a reporting word is looked for. The reporting words.
NEAR = 4
REPORTING = frozenset(
    "said says called wrote quoted quote quotes word term sagte nannte schrieb zitat dit appelle mot dijo llama palabra".split())
#: Quotation marks, and the marks that each of them can end a quotation of.
CLOSES = {'"': '"', "”": "“„”", "“": "„", "»": "«", "«": "»", "„": ""}
#: Marks that open only in front of a word and close only behind one.
BOTH_WAYS = '"”'


def _log(x):
    return math.log1p(x)


def _words(text):
    """Words of a lower-cased text as (codes, starts, lengths); a word is a run of letters and digits."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _letter_table()[np.minimum(codes, 0xFFFF)]
    high = codes > 0xFFFF
    if high.any():
        inside[high] = [chr(c).isalnum() for c in codes[high].tolist()]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside, [0]))))
    return codes, edge[::2], edge[1::2] - edge[::2]


_letters = []


def _letter_table():
    if not _letters:
        _letters.append(np.array([chr(c).isalnum() for c in range(0x10000)], np.int8))
    return _letters[0]


class Automaton:
    """The lexicon trie crossed with one-edit Levenshtein automata, as a table of numbered state sets.

    ``terms``: words, or word beginnings written with a final ``*``, and what a hit of each counts (else 1). A beginning
    must match exactly; a word of FUZZY letters or more also matches with one letter changed, added or left out, unless
    it is among ``strict``. States are made when a word first needs them, so that a large lexicon costs what its texts use.
    """

    def __init__(self, terms, strict=(), fuzzy=FUZZY):
        self.terms = sorted(terms)
        self.worth = np.array([terms[t] if isinstance(terms, dict) else 1.0 for t in self.terms])
        may_fail = {t for t in self.terms if not t.endswith("*") and len(t) >= fuzzy and t not in strict}
        # Of every trie node: its children, the term that ends there, the beginning, and whether edits lead on from it.
        self.children, self.ends, self.stems, self.may_err = [{}], {}, {}, set()
        for i, term in enumerate(self.terms):
            word, node = term.removesuffix("*"), 0
            path = [0]
            for letter in word:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                node = self.children[node][letter]
                path.append(node)
            (self.stems if term.endswith("*") else self.ends)[node] = i
            if term in may_fail:
                self.may_err.update(path)
        self.fuzzy_end = {n for n, i in self.ends.items() if self.terms[i] in may_fail}
        self.letters = ["", *sorted({c for term in self.terms for c in term.removesuffix("*") if ord(c) < 0xFFFF})]
        self.classes = np.zeros(0x10000, np.int32)
        for k, letter in enumerate(self.letters[1:], 1):
            self.classes[ord(letter)] = k
        # By state: where each letter leads (-1: not made yet), and what a word that ends there has matched: exactly,
        # with one edit, by its beginning; -1 for nothing. State 0 is dead, state 1 the start.
        self.table = np.full((64, len(self.letters)), -1, np.int32)
        self.exact, self.near, self.stem = (np.full(64, -1, np.int32) for _ in range(3))
        self.number, self.order = {}, []
        self._state(frozenset())
        self.table[0] = 0
        self._state(self._closed([(0, 0)]))

    def _closed(self, states):
        """With letters of the term left out; of one node only the fewest edits matter."""
        least = {}
        for node, edits in states:
            if edits < least.get(node, 2):
                least[node] = edits
        for node, edits in list(least.items()):
            if edits == 0 and node in self.may_err:
                for child in self.children[node].values():
                    if child in self.may_err:
                        least.setdefault(child, 1)
        return frozenset(least.items())

    def _step(self, states, letter):
        after = []
        for node, edits in states:
            child = self.children[node].get(letter)
            if child is not None and (edits == 0 or child in self.may_err):
                after.append((child, edits))
            if edits == 0 and node in self.may_err:
                after.append((node, 1))
                after += [(c, 1) for c in self.children[node].values() if c in self.may_err]
        return self._closed(after)

    def _state(self, states):
        """The number of a state set, which is added if it is new."""
        at = self.number.setdefault(states, len(self.order))
        if at < len(self.order):
            return at
        self.order.append(states)
        if at == len(self.table):
            self.table = np.concatenate((self.table, np.full_like(self.table, -1)))
            self.exact, self.near, self.stem = (
                np.concatenate((x, np.full_like(x, -1))) for x in (self.exact, self.near, self.stem))
        for node, edits in sorted(states):
            if node in self.ends and edits == 0:
                self.exact[at] = self.ends[node]
            elif node in self.fuzzy_end and edits == 1:
                self.near[at] = max(self.near[at], self.ends[node])
            if node in self.stems and edits == 0:
                self.stem[at] = self.stems[node]
        return at

    def _next(self, state, letter):
        """Where letters lead from states, both as numbers; steps not made yet are made once each."""
        to = self.table[state, letter]
        new = to < 0
        if not new.any():
            return to
        width = len(self.letters)
        for pair in np.unique(state[new].astype(np.int64) * width + letter[new]).tolist():
            at, k = divmod(pair, width)
            after = self._state(self._step(self.order[at], self.letters[k]))
            self.table[at, k] = after
        return self.table[state, letter]

    def match(self, codes, starts, lengths):
        """For the words that match: (word index, term, misspelled). Beginnings win over misspelled whole words."""
        term = np.full(len(starts), -1, np.int32)
        wrong = np.zeros(len(starts), bool)
        alive, state, depth = np.arange(len(starts)), np.ones(len(starts), np.int32), 0
        while len(alive):
            state = self._next(state, self.classes[np.minimum(codes[starts[alive] + depth], 0xFFFF)])
            depth += 1
            stem = self.stem[state]
            found = (stem >= 0) & (term[alive] < 0)
            term[alive[found]] = stem[found]
            ended = lengths[alive] == depth
            last, there = alive[ended], state[ended]
            exact, near = self.exact[there], self.near[there]
            term[last[exact >= 0]] = exact[exact >= 0]
            miss = (exact < 0) & (near >= 0) & (term[last] < 0)
            term[last[miss]] = near[miss]
            wrong[last[miss]] = True
            going = ~ended & (state > 0)
            alive, state = alive[going], state[going]
        hit = np.flatnonzero(term >= 0)
        return hit, term[hit], wrong[hit]


def _quoted(text, marks):
    """Spans (from, to) between paired quotation marks of one line; ``marks``: the positions of all marks of a text.

    A mark that nothing on its line closes opens nothing, and a mark that points both ways opens only in front of a
    word and not behind a letter or digit, so that signs for inches are none.
    """
    spans, opened, line = [], {}, 0
    for at in marks:
        mark, before = text[at], text[at - 1:at]
        if text.find("\n", line, at) >= 0:
            opened.clear()
        line = at
        behind = bool(before) and not before.isspace()
        ends = [o for o in CLOSES[mark] if o in opened] if mark not in BOTH_WAYS or behind else []
        if ends:
            start = max(opened[o] for o in ends)
            spans.append((start, at))
            opened = {o: p for o, p in opened.items() if p < start}
        elif mark not in BOTH_WAYS or (not before.isalnum() and text[at + 1:at + 2].strip()):
            opened[mark] = at
    return spans


def _context(text, codes, starts, lengths, hits, wrong, worth):
    """What each hit counts, from its term, its spelling and the text around it."""
    marks = np.flatnonzero(np.isin(codes, [ord(q) for q in CLOSES])).tolist()
    inside = np.zeros(len(codes) + 1, np.int32)
    for start, end in _quoted(text, marks):
        inside[start] += 1
        inside[end] -= 1
    inside = np.cumsum(inside)
    out = []
    for hit, bad, full in zip(hits.tolist(), wrong.tolist(), worth.tolist()):
        weight = MISSPELLED * full if bad else full
        if inside[starts[hit]]:
            weight *= QUOTED
        elif any(text[starts[w]:starts[w] + lengths[w]] in REPORTING for w in range(max(0, hit - NEAR), hit)):
            weight *= REPORTED
        out.append(weight)
    return out


def evidence(automaton, text):
    """Sum of what the hits count, the largest sum in a window of WINDOW words, and the number of hits."""
    lowered = (text or "").lower()
    codes, starts, lengths = _words(lowered)
    hits, terms, wrong = automaton.match(codes, starts, lengths)
    if not len(hits):
        return 0.0, 0.0, 0
    weights = _context(lowered, codes, starts, lengths, hits, wrong, automaton.worth[terms])
    total = np.concatenate(([0.0], np.cumsum(weights)))
    ahead = np.searchsorted(hits, hits + WINDOW, "left")
    return float(total[-1]), float((total[ahead] - total[:-1]).max()), len(hits)


def _terms(docs):
    """(term, toxic, n): in how many documents of each label a word or word beginning stands."""

    def run(batches):
        from collections import Counter

        found = {0: Counter(), 1: Counter()}
        for labels, texts in rows_read(batches, "toxic", "text"):
            for label, text in zip(labels, texts):
                lowered = text.lower()
                _, starts, lengths = _words(lowered)
                words = {lowered[s:s + n] for s, n in zip(starts.tolist(), lengths.tolist())}
                found[label].update(words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n})
        rows = [(t, label, n) for label, counted in found.items() for t, n in counted.items()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 3,
                                                              (pa.string(), pa.int32(), pa.int64()))], ["term", "toxic", "n"])

    return docs.mapInArrow(run, "term string, toxic int, n long").groupBy("term", "toxic").agg(F.sum("n").alias("n"))


def _once(rows):
    """One text of each label and group of near copies: what a thousand copies say is said once.

    Texts are linked by equal bands of smallest shingle hashes; a text follows the smallest of its bands, twice. This
    only weighs evidence: no text is left out of a score or of the fit of the curve.
    """
    words = F.filter(F.split(F.lower("text"), r"\s+"), lambda w: w != "")
    last = F.greatest(F.size("words") - SHINGLE + 1, F.lit(1))
    marks = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.array_join(F.slice("words", i, SHINGLE), " ")))
    least = lambda k: F.array_min(F.transform("marks", lambda m: F.xxhash64(F.lit(k), m)))
    bands = F.array(*[F.xxhash64(F.lit(k), least(2 * k), least(2 * k + 1), "toxic") for k in range(BANDS)])
    texts = rows.dropDuplicates(["toxic", "text"]).withColumn("id", F.xxhash64("toxic", "text"))
    links = written(texts.withColumn("words", words).withColumn("marks", marks).select("id", F.explode(bands).alias("band")),
                    "toxicity-copies")
    heads = links.groupBy("band").agg(F.min("id").alias("head"))
    for _ in range(2):
        first = links.join(heads, "band").groupBy("id").agg(F.min("head").alias("head"))
        heads = links.join(first, "id").groupBy("band").agg(F.min("head").alias("head"))
    return written(texts.join(first.where("id = head"), "id", "left_semi").select("toxic", "text"), "toxicity-once")


def _surprise(a, b, share):
    """Columns: how unlikely it is that ``a`` or more of a + b texts are toxic where a ``share`` is, as -log of a bound.

    The bound is Chernoff's: (a + b) times the divergence of the share found from the share of all.
    """
    n = a + b
    rest = F.when(b > 0, b * F.log(b / (n * F.lit(1 - share)))).otherwise(0.0)
    return F.when(a > n * share, a * F.log(a / (n * F.lit(share))) + rest).otherwise(0.0)


def _threshold(sizes, share):
    """The least surprise that a term needs, from the numbers of terms (``count``) in ``n`` texts.

    Tarone's correction: a term in so few texts that it stays below the threshold even if all of them are toxic is
    never taken, so it is not among the terms tried.
    """
    above, least = 0, 0.0
    for r in sorted(sizes, key=lambda r: -r.n):
        reach, tried = r.n * -math.log(share), above + r["count"]
        if reach < math.log(tried / CHANCE):
            return max(least, math.nextafter(reach, math.inf))
        above, least = tried, math.log(tried / CHANCE)
    return least


def lexicon(rows):
    """Terms for the automaton and what a hit of each counts, from labelled ``rows`` (toxic, text).

    Near copies of one label count once. A term is taken if its ratio is RATIO or more and its bound of chance, times the
    number of terms that could reach it, is at most CHANCE: frequency does not matter otherwise, and nothing limits how
    many are taken. Beginnings are taken by evidence (toxic texts times the logarithm of the ratio, of
    equals the longer term first), none within another and none that a stronger word begins with; whole words of FUZZY
    letters or more stay beside a beginning of theirs, for their misspellings.
    """
    rows = _once(rows)
    of_label = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = of_label.get(1, 0), of_label.get(0, 0)
    if not toxic:
        return {}
    a, b = (F.sum(F.when(F.col("toxic") == label, F.col("n")).otherwise(0)) for label in (1, 0))
    counts = written(_terms(rows).groupBy("term").agg(a.alias("a"), b.alias("b")).where(F.col("a") + F.col("b") >= SUPPORT),
                     "toxicity-terms")
    share = toxic / (toxic + clean)
    bound = _threshold(counts.groupBy((F.col("a") + F.col("b")).alias("n")).count().collect(), share)
    ratio = (F.col("a") / toxic) / ((F.col("b") + 0.5) / max(clean, 1))
    strong = counts.withColumn("ratio", ratio).where((F.col("a") >= SUPPORT) & (ratio >= RATIO))
    # Without a clean text nothing can be told by chance; the ratio alone decides then.
    if clean:
        strong = strong.where(_surprise(F.col("a"), F.col("b"), share) >= bound)
    found = strong.withColumn("evidence", F.col("a") * F.log("ratio")).collect()
    found.sort(key=lambda r: (-r.evidence, -len(r.term.removesuffix("*")), r.term.endswith("*"), r.term))
    chosen, stems, begun = {}, set(), set()
    for r in found:
        word, whole = r.term.removesuffix("*"), not r.term.endswith("*")
        beginnings = {word[:n] for n in range(1, len(word) + 1)}
        if stems & beginnings and not (whole and len(word) >= FUZZY) or not whole and word in begun:
            continue
        chosen[r.term] = min(1.0, math.log(r.ratio) / math.log(FULL))
        begun |= beginnings
        if not whole:
            stems.add(word)
    return chosen


def _misread(rows, automaton):
    """Terms whose misspellings stand in a larger share of the clean than a tenth of that of the toxic texts."""

    def run(batches):
        from collections import Counter

        found = Counter()
        for labels, texts in rows_read(batches, "toxic", "text"):
            for label, text in zip(labels, texts):
                _, terms, wrong = automaton.match(*_words(text.lower()))
                found.update((t, label) for t in set(terms[wrong].tolist()))
                found[-1, label] += 1
        seen = [(t, label, n) for (t, label), n in found.items()]
        yield pa.record_batch([pa.array([x[i] for x in seen], k) for i, k in enumerate(
            (pa.int32(), pa.int32(), pa.int64()))], ["term", "toxic", "n"])

    counts = rows.mapInArrow(run, "term int, toxic int, n long").groupBy("term", "toxic").agg(F.sum("n").alias("n"))
    n = {(r.term, r.toxic): r.n for r in counts.collect()}
    toxic, clean = n.get((-1, 1), 0), n.get((-1, 0), 0)
    return {automaton.terms[t] for t, label in n if t >= 0 and label == 0
            and 10 * n[t, 0] * toxic > n.get((t, 1), 0) * clean}


class Model:
    """An automaton and the logistic curve over the evidence that it finds."""

    def __init__(self, automaton, weights, bias):
        self.automaton, self.weights, self.bias = automaton, weights, bias
        self.terms = automaton.terms

    def score(self, text):
        total, peak, _ = evidence(self.automaton, text)
        z = self.bias + self.weights[0] * _log(total) + self.weights[1] * _log(peak)
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def train(docs, labels, limit=TRAINING):
    """A model from the texts whose doc_id has a label ``toxic`` of 0 or 1. At most about ``limit`` of them are read.

    Without a toxic label the lexicon is empty and every score is next to 0.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    marked = sampled(labels.where("toxic in (0, 1)").select("doc_id", "toxic").distinct(), limit)
    # About ``limit`` ids at most, whatever the table: small enough to send, so that no text is shuffled.
    rows = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(marked), "doc_id").select(
        F.col("toxic").cast("int").alias("toxic"), "text")
    rows = written(rows, "toxicity-sample")
    terms = lexicon(rows)
    if not terms:
        return Model(Automaton({}), [0.0, 0.0], -60.0)
    automaton = Automaton(terms)
    automaton = Automaton(terms, _misread(rows, automaton))

    def run(batches):
        for batch in batches:
            found = [evidence(automaton, t.as_py()) for t in batch.column("text")]
            yield pa.record_batch(
                [batch.column("toxic"), pa.array([[_log(a), _log(b)] for a, b, _ in found], pa.list_(pa.float64()))],
                ["toxic", "x"])

    seen = rows.mapInArrow(run, "toxic int, x array<double>")
    seen = seen.select(F.col("toxic").cast("double").alias("label"), array_to_vector("x").alias("features"))
    fit = LogisticRegression(regParam=1e-4, standardization=False, maxIter=200).fit(seen)
    # More evidence never lowers a score.
    return Model(automaton, [max(0.0, float(w)) for w in fit.coefficients], float(fit.intercept))


def scored(docs, model, *keep, threshold=0.7):
    """doc_id, the ``keep`` columns, score (0 to 1) and predicted (1 from ``threshold`` on) of every whole text.

    Null and empty texts have no hits. Only the text is read for a score, to its end however long; repeated rows are
    scored one by one, and further columns, of whatever name, are not read. An empty table gives an empty table.
    """

    def run(batches):
        for batch in batches:
            found = [model.score(t.as_py()) for t in batch.column("text")]
            columns = [batch.column(c) for c in ("doc_id", *keep)]
            yield pa.record_batch(
                [*columns, pa.array(found, pa.float64()), pa.array([int(s >= threshold) for s in found], pa.int32())],
                ["doc_id", *keep, "score", "predicted"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", *keep))
    return docs.select("doc_id", *keep, "text").mapInArrow(run, f"{kinds}, score double, predicted int")
