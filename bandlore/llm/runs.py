"""Periodic runs of words, by enumerating maximal pairs on the tree of LCP intervals.

Two places i < j of a text form a maximal pair if the words from them on agree for ``l`` words, no further, and the words
before them differ. Such a pair with distance q = j - i and l >= (times - 1) * q is exactly a run of period q: it starts
at i, is q + l words long, and neither neighbour keeps the period. So nothing has to be extended.

Suffixes are sorted by doubling, many texts at once; a suffix whose first words occur once in its text has no partner and
leaves the sort early. The intervals of common prefixes are walked bottom-up; every interval keeps the places of its
suffixes by the word to their left, and a place joining it is compared with places of other left words within reach. Places
of one prefix of l words that lie within l / 2 form one arithmetic progression, in which only the first can differ from the
rest in its left word, so a place needs to look at two classes to its left and right and not at all of them.

Texts are worked on in the task that reads them; nothing is shuffled.
"""

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from bandlore.llm.common import binary_text

#: Fewest words of a run, and how often its period fits into it at least.
LEAST, TIMES = 24, 3
#: Words of texts that are sorted together.
TOGETHER = 1 << 17
RUNS = "array<struct<start:int,length:int,period:int>>"


def _named(high, low):
    """Ranks of the pairs (high, low)."""
    order = np.lexsort((low, high))
    changed = np.ones(len(order), bool)
    changed[1:] = (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]])
    # A rank is the place of the first equal pair, so that a finer sort only moves equals.
    first = np.maximum.accumulate(np.where(changed, np.arange(len(order)), 0))
    ranks = np.empty(len(order), np.int64)
    ranks[order] = first
    return ranks


def _sorted_suffixes(names, ends, shortest):
    """Suffixes that share ``shortest`` words or more with another one: their order, and ranks by doubled lengths.

    ``names`` are equal for equal words of one text; ``ends`` is the end of the text of each place.
    """
    places = np.arange(len(names))
    ranks, width, levels = _named(names, np.zeros(len(names), np.int64)), 1, []
    levels.append(ranks)
    ahead = np.zeros(len(names), np.int64)
    while 2 * width <= shortest:
        further = places + width
        ahead[:] = 0
        inside = further < ends
        ahead[inside] = ranks[further[inside]] + 1
        ranks, width = _named(ranks, ahead), 2 * width
        levels.append(ranks)
    # Only suffixes that are equal so far, and whole, go on.
    left = places[places + width <= ends]
    _, group, size = np.unique(ranks[left], return_inverse=True, return_counts=True)
    alike = left = left[size[group] > 1]
    while len(left):
        further = left + width
        low = np.zeros(len(left), np.int64)
        inside = further < ends[left]
        low[inside] = ranks[further[inside]] + 1
        order = np.lexsort((low, ranks[left]))
        old, low, sorted_left = ranks[left][order], low[order], left[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (old[1:] != old[:-1]) | (low[1:] != low[:-1])
        group_start = np.maximum.accumulate(np.where(np.concatenate(([True], old[1:] != old[:-1])), np.arange(len(order)), 0))
        part_start = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
        ranks = ranks.copy()
        ranks[sorted_left] = old + part_start - group_start
        width *= 2
        levels.append(ranks)
        last = np.append(fresh[1:], True)
        left = np.sort(sorted_left[~(fresh & last)])
    return alike[np.argsort(ranks[alike], kind="stable")], levels


def _common(x, y, levels, ends):
    """Number of words that the suffixes at x and y share."""
    same = np.zeros(len(x), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        width, ranks = 1 << k, levels[k]
        a, b = x + same, y + same
        fits = (a + width <= ends[x]) & (b + width <= ends[y])
        fits[fits] = ranks[a[fits]] == ranks[b[fits]]
        same[fits] += width
    return same


class _Interval:
    """Places below an interval of the tree, all of them in order, and by the word to their left."""

    __slots__ = ("places", "by_left")

    def __init__(self, place, word):
        self.places, self.by_left = [place], {word: [place]}

    def take(self, other):
        for place in other.places:
            insort(self.places, place)
        for word, places in other.by_left.items():
            mine = self.by_left.get(word)
            if mine is None:
                self.by_left[word] = places
            else:
                for place in places:
                    insort(mine, place)


def _pairs(small, large, same, reach, words, out):
    """Maximal pairs between two children of an interval of ``same`` common words, at most ``reach`` apart."""
    places, by_left = large.places, large.by_left
    for word, own in small.by_left.items():
        for place in own:
            low = bisect_left(places, place - reach)
            if low == len(places) or places[low] > place + reach:
                continue
            after = bisect_left(places, place, low)
            if after > low and words[places[low]] != word:
                out.append((places[low], place, same))
            if after < len(places) and places[after] <= place + reach and words[places[after]] != word:
                # This place begins the progression: all later places within reach are in one class.
                ahead = by_left[words[places[after]]]
                for k in range(bisect_left(ahead, place), len(ahead)):
                    if ahead[k] > place + reach:
                        break
                    out.append((place, ahead[k], same))


def maximal_pairs(order, same, words, times=TIMES):
    """Maximal pairs (i, j, common words) with common words >= (times - 1) * (j - i).

    ``order`` are places in suffix order, ``same`` the words each shares with the one before (0: a new tree), ``words``
    the word to the left of a place.
    """
    out, stack = [], []  # stack of (common words of the open interval, its places)

    def close(down_to):
        """Close intervals with more than ``down_to`` common words."""
        while len(stack) > 1 and stack[-1][0] > down_to:
            depth, top = stack.pop()
            below = stack[-1][1]
            small, large = (top, below) if len(top.places) <= len(below.places) else (below, top)
            _pairs(small, large, depth, depth // (times - 1), words, out)
            large.take(small)
            stack[-1] = stack[-1][0], large

    for place, shared in zip(order, same):
        close(shared)
        if not shared:
            stack = []
        stack.append((shared, _Interval(place, words[place])))
    close(0)
    return out


def found_runs(texts, least=LEAST, times=TIMES):
    """Per text, given as an array of word numbers, its runs (start, length, period) by start and period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    total = int(sizes.sum())
    if not total:
        return [[] for _ in texts]
    stops = np.cumsum(sizes)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    ends = stops[text_of]
    words = np.concatenate(texts).astype(np.int64)
    names = text_of * (words.max() + 1) + words
    # q + l >= least and l >= (times - 1) * q: so many words are shared at least.
    shortest = max(1, least - least // times)
    order, levels = _sorted_suffixes(names, ends, shortest)
    out = [{} for _ in texts]
    if len(order):
        same = np.concatenate(([0], _common(order[1:], order[:-1], levels, ends)))
        same[same < shortest] = 0
        # Nothing stands left of a text's first word.
        left = np.concatenate(([-1], words[:-1]))
        left[(stops - sizes)[sizes > 0]] = -1
        for i, j, shared in maximal_pairs(order.tolist(), same.tolist(), left.tolist(), times):
            q = j - i
            if shared >= (times - 1) * q and q + shared >= least:
                text = int(text_of[i])
                key = i - int(stops[text] - sizes[text]), q + shared
                # Multiples of a run's period give the same stretch.
                out[text][key] = min(q, out[text].get(key, q))
    return [sorted((start, length, q) for (start, length), q in found.items()) for found in out]


def kept_words(words, runs):
    """The words without those that repeat the first period of a run."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        gone[start + q] += 1
        gone[start + length] -= 1
    return [w for w, n in zip(words, np.cumsum(gone).tolist()) if not n]


def _numbers(words):
    known = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def periodic_runs(docs, least=LEAST, times=TIMES):
    """doc_id, n_words, ``runs`` (start, length, period: in words, by start and period) and the ``collapsed`` text of
    every row: its words without those behind the first period of a run, joined by single spaces.

    Words are separated by white space of ASCII. A run is a stretch with smallest period q, of ``least`` words and
    ``times`` (three or more) periods or more, that no neighbouring word extends. Null and empty texts have no words and
    no runs. Repeated rows and equal or null doc_ids stay rows of their own. Texts of any length are worked on whole, each
    in one task. Of two runs with one start the shorter period comes first. Columns other than doc_id and text are not
    returned. An empty table gives no rows.
    """
    parts = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "length", "period")]))

    def result(ids, rows):
        found = found_runs([_numbers(w) for w in rows], least, times)
        return pa.record_batch(
            [ids, pa.array([len(w) for w in rows], pa.int64()),
             pa.array([[{"start": i, "length": n, "period": q} for i, n, q in f] for f in found], parts),
             pa.array([b" ".join(kept_words(w, f)).decode("utf-8", "replace") for w, f in zip(rows, found)], pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches):
        for batch in batches:
            rows, held = [], 0
            for k, text in enumerate(batch.column("text")):
                rows.append((text.as_py() or b"").split())
                held += len(rows[-1])
                if held >= TOGETHER:
                    yield result(batch.column("doc_id").slice(k + 1 - len(rows), len(rows)), rows)
                    rows, held = [], 0
            if rows:
                yield result(batch.column("doc_id").slice(batch.num_rows - len(rows)), rows)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return binary_text(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def _let(value, then):
    """``then`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def with_periods(docs):
    """``docs`` with runs planted into every tenth text (by the checksum of doc_id), its words joined by single spaces.

    With h = crc32(doc_id), g = h / 10 and n words, those from a = g % n on repeat the first 1 + (n - a) / (3 + g % 8) of
    them, if h % 10 is 0. Texts without words and rows without doc_id stay as they are, and so do other columns.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def turned(words):
        n = F.size(words)
        a = (g % n).cast("int")
        starts = F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).cast("int").alias("p"))
        return F.when(n > 0, _let(starts, lambda s: F.array_join(F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.element_at(words, 1 + F.when(i < s.a, i).otherwise(s.a + (i - s.a) % s.p))), " "))
        ).otherwise(F.col("text"))

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    planted = F.col("text").isNotNull() & (h % 10 == 0)
    return docs.withColumn("text", F.when(planted, _let(words, turned)).otherwise(F.col("text")))
