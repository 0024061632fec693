"""Repeated passages, by global hashing of lines and of their parts.

A unit is a line or a part of one: lines are also cut after a sentence end and before a capitalised word of any script,
so that a passage pasted into the middle of a line has units of its own. A unit of more than LONG words is cut further
after words that a hash picks, and scripts without spaces after pairs of letters that it picks, so that equal passages
are cut alike wherever they begin. Units are normalised (lower case, single spaces, no marks at the ends) and digested;
units of one or two words are digested together with the unit before them. A line of several units also has a digest of
its own.

Of every digest the earliest place, by doc_id and position, is kept. A line goes if its own digest stands earlier, however
short it is. Other units that follow each other go if together they have at least ``run_words`` words (two letters of a
script without spaces count as one) and stand earlier together: each unit knows the first and the last place before its
own, and a run needs one earlier text in which all its units follow each other.

Digests are found once and written. They are then sorted by digest and place in ranges, so that a digest which very many
documents hold is spread over tasks; a range is read as a stream, and takes over what it needs of the ranges before. Only
the marks found are grouped by document. Texts are read again for the documents' own rows.
"""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from bandlore.llm.common import binary_text, written

#: Fewest words of a removed run of units that is no whole line.
RUN_WORDS = 20
#: Units with fewer words are digested with the one before, unless they begin a line.
SHORT = 3
#: Letters of scripts without spaces: Thai, Lao, Myanmar, Khmer, kana, Han.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
#: Units of more words are cut after one word in PICKED, or one pair of letters in PAIRS without spaces.
LONG, PICKED, PAIRS = 20, 8, 16


def _letters(kind):
    """The letters of a kind as ranges of a character class."""
    points = [c for c in range(0x80, 0x1EA00) if kind(chr(c))]
    starts = [c for c, before in zip(points, [-1, *points]) if c != before + 1]
    ends = [c for c, after in zip(points, [*points[1:], -1]) if c + 1 != after]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends))


BORDER = re.compile(
    r"\s*\n\s*|(?<=[.!?…।॥؟۔։።])\s+|(?<=[。！？｡．])\s*"
    rf"|\s+(?=[A-Z{_letters(str.isupper)}][a-z{_letters(str.islower)}])")
WORD, INK = re.compile(r"\S+"), re.compile(r"\S")
SPANS = "array<struct<start:int,end:int>>"


class Units(list):
    """(start, end, words, normalised bytes) of units, and beside them their ``sizes`` in words, ``lines``, and the
    ``spans`` (first unit, last unit) of lines of several units."""

    def __init__(self):
        self.sizes, self.lines = [], []

    @property
    def spans(self):
        firsts = [k for k, line in enumerate(self.lines) if not k or self.lines[k - 1] != line]
        return [(a, b - 1) for a, b in zip(firsts, [*firsts[1:], len(self)]) if b - a > 1]


def _size(text, words):
    """Words of a unit; two letters of a script without spaces count as one at least."""
    return len(words) if text.isascii() else max(len(words), len(UNSPACED.findall(text)) // 2)


def _picked(part):
    """Offsets in a long unit after which its content says to cut it."""
    out = []
    for m in WORD.finditer(part):
        word = m.group().lower()
        if not word.isascii() and UNSPACED.search(word):
            out += [m.start() + k for k in range(2, len(m.group())) if not zlib.crc32(
                part[m.start() + k - 2:m.start() + k].lower().encode("utf-8", "replace")) % PAIRS]
        if not zlib.crc32(word.encode("utf-8", "replace")) % PICKED:
            out.append(m.end())
    return out


def _cuts(text):
    """(end of a unit, start of the next) at all borders and at the end."""
    at = 0
    for start, end in [*((m.start(), m.end()) for m in BORDER.finditer(text)), (len(text), len(text))]:
        part = text[at:start]
        if len(part) > LONG and _size(part, part.split()) > LONG:
            for k in _picked(part):
                after = INK.search(part, k)
                if after:
                    yield at + k, at + after.start()
        yield start, end
        at = end


def units(text):
    """The units of a text with words; offsets are code points. A unit that begins a line has SHORT words or more, so
    that it is digested without the line before."""
    out, at, line, last = Units(), 0, 0, -1
    for cut in _cuts(text):
        words = text[at:cut[0]].lower().split()
        if words:
            size = _size(text[at:cut[0]], words)
            out.append((at, cut[0], size if line == last else max(size, SHORT),
                        " ".join(words).strip(".,;:!?\"'()").encode("utf-8", "replace")))
            out.sizes.append(size)
            out.lines.append(line)
            last = line
        line += "\n" in text[cut[0]:cut[1]]
        at = cut[1]
    return out


def digests(found):
    """16-byte digests of units, then of lines of several units."""
    out, before = [], b""
    for _, _, n, form in found:
        out.append(hashlib.blake2b(before + b"\n" + form if n < SHORT else form, digest_size=16).digest())
        before = form
    for a, b in found.spans:
        line = b" ".join(form for _, _, _, form in found[a:b + 1])
        out.append(hashlib.blake2b(line, digest_size=16, person=b"line").digest())
    return out


def runs(starts, ends, sizes, lines, marks, run_words=RUN_WORDS):
    """Spans (start, end) to remove and the number of their units, from arrays that hold a number per unit.

    ``marks``: by digest number the (earlier text, place) of its first and its last.
    """
    n = len(lines)
    gone = np.zeros(n + 1, bool)
    begins = np.flatnonzero(np.concatenate(([True], lines[1:] != lines[:-1])))
    wide = np.diff(np.append(begins, n))
    several = np.flatnonzero(wide > 1)
    for at in marks:
        if at >= n:  # the digest of a whole line
            line = several[at - n]
            gone[begins[line]:begins[line] + wide[line]] = True
    for k in begins[wide == 1].tolist():
        if k in marks:
            gone[k] = True
    at, order = 0, sorted(a for a in marks if a < n)
    while at < len(order):
        begin = end = order[at]
        common = {(text, place - begin) for text, place in marks[begin]}
        while at + 1 < len(order) and order[at + 1] == end + 1:
            both = common & {(text, place - end - 1) for text, place in marks[end + 1]}
            if not both:
                break
            at, end, common = at + 1, end + 1, both
        if sizes[begin:end + 1].sum() >= run_words:
            gone[begin:end + 1] = True
        at += 1
    edges = np.flatnonzero(gone[1:] != gone[:-1]) + 1
    edges = np.concatenate(([0], edges)) if gone[0] else edges
    return [(int(starts[a]), int(ends[b - 1])) for a, b in zip(edges[::2], edges[1::2])], int(gone.sum())


def _keys():
    return F.xxhash64("doc_id", "text").alias("row_hash"), F.hash("doc_id", "text").alias("row_check")


UNIT = ["starts", "ends", "sizes", "lines"]


def _digested(docs):
    """Per document its keys, the digests as two arrays of words, and of every unit offsets, words and line."""

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                found = [units((t.as_py() or b"").decode("utf-8", "replace")) for t in part.column("text")]
                words = [np.frombuffer(b"".join(digests(f)), np.int64) for f in found]
                columns = [part.column(c) for c in ("doc_id", "row_hash", "row_check")]
                columns += [pa.array([w[k::2] for w in words], pa.list_(pa.int64())) for k in (0, 1)]
                columns += [pa.array([np.array([u[k] for u in f], np.int32) for f in found], pa.list_(pa.int32())) for k in (0, 1)]
                columns += [pa.array([np.array(x, np.int32) for x in own], pa.list_(pa.int32()))
                            for own in ([f.sizes for f in found], [f.lines for f in found])]
                yield pa.record_batch(columns, ["doc_id", "row_hash", "row_check", "high", "low", *UNIT])

    kind = docs.schema["doc_id"].dataType.simpleString()
    arrays = ", ".join(f"{c} array<int>" for c in UNIT)
    rows = binary_text(docs, "doc_id", *_keys()).mapInArrow(
        run, f"doc_id {kind}, row_hash long, row_check int, high array<long>, low array<long>, {arrays}")
    return written(rows, "digests")


PLACE = ["row_hash", "row_check", "at"]
MARK = [*PLACE, "first_row", "first_at", "last_row", "last_at"]


def _sorted_marks(units, order):
    """Units that are not the first of their digest, with the first place and the last one before their own.

    Ranges of the sorted units are worked on alone, and every unit of a range's first digest is kept; what ranges before it
    hold of that digest is one row per range, and is filled in by ``marks``. Equal rows share one place.
    """
    import pyspark

    def result(kind, part, head, *columns):
        *columns, edge = columns
        n = len(head)
        return pa.record_batch(
            [pa.array([kind] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(head), *map(pa.array, columns),
             pa.array([edge] * n, pa.list_(pa.int64()))], ["kind", "part", "head", *MARK, "edge"])

    def run(batches):
        part, batches = pyspark.TaskContext.get().partitionId(), list(batches)
        rows = pa.Table.from_batches(batches) if batches else None
        if rows is None or not rows.num_rows:
            return
        d1, d2, row, check, at = (rows.column(c).to_numpy() for c in ("d1", "d2", *PLACE))
        here = np.arange(len(d1))
        fresh, moved = np.ones(len(d1), bool), np.ones(len(d1), bool)
        fresh[1:] = (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
        moved[1:] = fresh[1:] | (row[1:] != row[:-1]) | (check[1:] != check[:-1]) | (at[1:] != at[:-1])
        first = np.maximum.accumulate(np.where(fresh, here, 0))
        place = np.maximum.accumulate(np.where(moved, here, 0))
        last = np.where(fresh[place], -1, place - 1)
        head = first == 0
        for low in range(0, len(d1), 1 << 18):
            kept = low + np.flatnonzero((head | (last >= 0))[low:low + (1 << 18)])
            alone = last[kept] < 0
            yield result(0, part, head[kept], row[kept], check[kept], at[kept], row[first[kept]], at[first[kept]],
                         pa.array(row[last[kept]], mask=alone), pa.array(at[last[kept]], mask=alone), None)
        end = [-1]
        yield result(1, part, head[end], row[end], check[end], at[end], row[first[end]], at[first[end]], row[end], at[end],
                     [d1[0], d2[0], d1[-1], d2[-1]])

    dealt = units.repartitionByRange(*order).sortWithinPartitions(*order).select("d1", "d2", *PLACE)
    return written(dealt.mapInArrow(
        run, "kind int, part int, head boolean, row_hash long, row_check int, at int, first_row long, first_at int, "
             "last_row long, last_at int, edge array<long>"), "sorted_marks")


def marks(rows):
    """Digests that stand earlier: per document (row_hash, row_check) their numbers ``at`` with the first and the last
    earlier place. ``rows`` come from ``_digested``."""
    units = rows.select("doc_id", "row_hash", "row_check", F.posexplode(F.arrays_zip("high", "low")).alias("at", "d")).select(
        F.col("d.high").alias("d1"), F.col("d.low").alias("d2"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", *PLACE)
    found = _sorted_marks(units, ["d1", "d2", "unnamed", "doc_id", *PLACE])
    carried, held = [], None  # one row per range
    for r in found.where("kind = 1").orderBy("part").collect():
        goes_on = held is not None and held[:2] == tuple(r.edge[:2])
        if goes_on:
            carried.append((r.part, *held[2:]))
        first = held[2:4] if goes_on and r.edge[:2] == r.edge[2:] else (r.first_row, r.first_at)
        held = (*r.edge[2:], *first, r.last_row, r.last_at)
    before = rows.sparkSession.createDataFrame(carried, "part int, f_row long, f_at int, l_row long, l_at int")
    full = found.where("kind = 0").join(F.broadcast(before), "part", "left")
    goes_on = F.col("head") & F.col("f_row").isNotNull()
    full = full.select(
        "row_hash", "row_check", "at",
        *[F.when(goes_on, F.col(f"f_{c}")).otherwise(F.col(f"first_{c}")).alias(f"first_{c}") for c in ("row", "at")],
        *[F.coalesce(f"last_{c}", F.when(goes_on, F.col(f"l_{c}"))).alias(f"last_{c}") for c in ("row", "at")],
    ).where("last_at is not null")
    return full.groupBy("row_hash", "row_check").agg(F.collect_set(F.struct(*MARK[2:])).alias("marked"))


def _spans(rows, run_words):
    """Per document (row_hash, row_check) n_units, n_removed, removed_chars and the spans to remove."""

    def run(batches):
        for batch in batches:
            counts, gone, chars, spans = [], [], [], []
            own = [batch.column(c) for c in UNIT]
            marked = batch.column("marked")
            for k in range(batch.num_rows):
                starts, ends, sizes, lines = (c[k].values.to_numpy() for c in own)
                cut, n = [], 0
                if marked[k].is_valid:
                    at, *places = (marked[k].values.field(c).to_pylist() for c in MARK[2:])
                    cut, n = runs(starts, ends, sizes, lines,
                                  {a: ((f, fa), (g, ga)) for a, f, fa, g, ga in zip(at, *places)}, run_words)
                counts.append(len(lines))
                gone.append(n)
                chars.append(sum(b - a for a, b in cut))
                spans.append([{"start": a, "end": b} for a, b in cut])
            yield pa.record_batch(
                [batch.column("row_hash"), batch.column("row_check"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(chars, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                ["row_hash", "row_check", "n_units", "n_removed", "removed_chars", "spans"])

    joined = rows.select("row_hash", "row_check", *UNIT).join(marks(rows), ["row_hash", "row_check"], "left")
    found = joined.mapInArrow(run, "row_hash long, row_check int, n_units long, n_removed long, removed_chars long, "
                                   f"spans {SPANS}")
    # Equal rows have equal spans.
    return found.dropDuplicates(["row_hash", "row_check"])


def without_repeats(docs, run_words=RUN_WORDS):
    """One row per document: doc_id, text without repeated lines and runs, n_units, n_removed (units), removed_chars, and spans
    (start, end) of what was removed, in code points of the original text.

    Null text stays null, without units; empty texts stay empty. Documents are ranked by doc_id, null last, then by a
    hash; rows equal in doc_id and text are one document, and all keep what it keeps. A unit repeated inside a document is
    kept at its first place. Texts of any length are cut whole, each in one task. Columns other than doc_id and text are
    not returned; an empty table gives no rows.
    """

    def run(batches):
        for batch in batches:
            texts = []
            for value, cut in zip(batch.column("text"), batch.column("spans")):
                text = value.as_py()
                if text is not None:
                    text = text.decode("utf-8", "replace")
                    ends = [0, *(x for s in cut.as_py() for x in (s["start"], s["end"])), len(text)]
                    text = "".join(text[a:b] for a, b in zip(ends[::2], ends[1::2]))
                texts.append(text)
            names = ["doc_id", "text", "n_units", "n_removed", "removed_chars", "spans"]
            yield pa.record_batch([pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = _spans(_digested(docs), run_words)
    rows = binary_text(docs, "doc_id", *_keys()).join(found, ["row_hash", "row_check"])
    return rows.drop("row_hash", "row_check").mapInArrow(
        run, f"doc_id {kind}, text string, n_units long, n_removed long, removed_chars long, spans {SPANS}")
