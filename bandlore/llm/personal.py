"""Personal data: spans by fixed patterns, and more of them by a semi-Markov conditional random field.

The field scores whole segments of up to LONGEST tokens: shape, length, digit sums, separators and the words beside the
segment are features of the span, not of single tokens. Dynamic programming over segment ends, bounded by LONGEST,
chooses boundaries and kinds together; training sums over all segmentations in the same way. A segment of a kind holds a
digit, an at sign, or the word "at" before a host with a dot, so a text falls into islands around these, each with as
many tokens to both sides as a segment has, and solving each island solves the text.

The field learns from a bounded number of the spans of each kind that the patterns find, with their surface varied (marks spelled out,
prefixes and separators changed), so that it also finds forms that the patterns miss. Spans of the patterns always stay;
spans of the field are added where they touch none of them and still look like their kind.
"""

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from bandlore.llm.common import binary_text, stable

KINDS = ("email", "ip", "card", "phone")
#: Longest segment in tokens; whole tokens to both sides of what starts an island.
LONGEST = AROUND = 7
#: Training: most islands of each kind and, of those without spans, as many as of all kinds; longest text of an island
#: without spans, passes, step; number of hashed features.
ISLANDS, PLAIN, PASSES, STEP, WIDTH = 125, 160, 10, 0.3, 1 << 13

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOT = r"(?:\.(?=[a-z])|\s?[\[(] ?dot ?[\])]\s?|\sdot\s)"
SEED = re.compile(rf"[0-9@]|[\[(] ?at ?[\])]|(?<=\s)at\s+[a-z0-9-]+{DOT}[a-z]", re.IGNORECASE)
#: An address whose at sign or dots are spelled out, and the rest of a host in this form.
SPELLED = re.compile(
    rf"[a-z0-9]\s*(?:(?:@|[\[(] ?at ?[\])])\s*[a-z0-9-]+\s*(?:\.|[\[(] ?dot ?[\])]|\sdot\s)\s*[a-z]"
    rf"|\sat\s+[a-z0-9-]+{DOT}[a-z])")
MORE = re.compile(rf"(?:{DOT}[a-z0-9-]+)+", re.IGNORECASE)
NOT_DIGIT = re.compile(r"[^0-9]")
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def luhn(digits):
    total = 0
    for at, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if at % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def _emails(text):
    """Matches of the e-mail pattern, found from their at signs: time stays linear in runs without one."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            free = match.end()
            out.append((start, free))
        at = text.find("@", max(at + 1, free))
    return out


def _is_ip(text):
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def base_spans(text):
    """(kind, start, end) of the fixed patterns, by kind as in KINDS and then start."""
    out = [("email", *s) for s in _emails(text)]
    if not any(c in text for c in "0123456789"):
        return out
    out += [("ip", *m.span()) for m in IP.finditer(text) if _is_ip(m.group())]
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15]
    return out


def islands(text):
    """(start, end) of the stretches around seeds, with AROUND whole tokens to both sides; disjoint, in order."""
    out, done = [], 0
    for seed in SEED.finditer(text):
        if seed.start() < done:
            continue
        start, end = seed.start(), seed.end()
        for _ in range(AROUND + 1):
            while start > 0 and not text[start - 1].isspace():
                start -= 1
            while start > 0 and text[start - 1].isspace() and text[start - 1] != "\n":
                start -= 1
            while end < len(text) and not text[end].isspace():
                end += 1
            while end < len(text) and text[end].isspace() and text[end] != "\n":
                end += 1
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        done = end
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _tokens(text, start, end):
    return [(start + m.start(), start + m.end()) for m in re.finditer(r"\S+", text[start:end])]


def _trimmed(text, start, end):
    """A segment without quotes, brackets and stops at its ends, as far as they do not belong to it."""
    while start < end and text[start] in "\"'<>[]{},;:.!?=":
        start += 1
    while start < end and text[end - 1] in "\"'<>[]{},;:.!?=":
        end -= 1
    if text.count("(", start, end) < text.count(")", start, end) and text[end - 1:end] == ")":
        end -= 1
    if text.count("(", start, end) > text.count(")", start, end) and text[start:start + 1] == "(":
        start += 1
    return start, end


def _hashed(name):
    return int.from_bytes(hashlib.blake2b(name.encode("utf-8", "replace"), digest_size=4).digest(), "little") % WIDTH


def features(text, start, end, before, after, n):
    """Hashed features of one segment: of its whole text and of the tokens beside it."""
    start, end = _trimmed(text, start, end)
    seg = text[start:end]
    shape = re.sub(r"[A-Za-z]+", "a", seg)
    digits = NOT_DIGIT.sub("", seg)
    groups = re.sub(r"[0-9]+", lambda m: str(min(len(m.group()), 9)), shape)
    kinds = re.sub(r"[0-9]+", "0", shape)
    names = [
        "bias", f"n={n}", f"groups={groups}", f"kinds={kinds}", f"first={shape[:1]}", f"digits={min(len(digits), 20)}",
        f"signs={''.join(sorted(set(re.sub(r'[a0-9]', '', kinds))))}", f"before={before.lower()[-12:]}",
        f"after={after.lower()[:12]}", f"at={'@' in seg or 'at' in re.findall('[a-z]+', seg.lower())}",
        f"dot={seg.lower().count('dot') + seg.count('.')}",
        f"luhn={13 <= len(digits) <= 19 and luhn(digits)}", f"ip={bool(IP.fullmatch(seg)) and _is_ip(seg)}",
        f"phone={9 <= len(digits) <= 15 and not re.search('[A-Za-z]', seg)}", f"letters={bool(re.search('[A-Za-z]', seg))}",
    ]
    return [_hashed(x) for x in names]


class Island:
    """All segments of an island: tokens from a to b, and their features."""

    def __init__(self, text, start, end):
        self.text, self.tokens = text, _tokens(text, start, end)
        words = [text[s:e] for s, e in self.tokens]
        seeds = np.concatenate(([0], np.cumsum([bool(SEED.search(w)) or w.lower() in ("at", "dot") for w in words])))
        self.a, self.b, rows = [], [], []
        for b in range(1, len(words) + 1):
            for a in range(b - 1, max(-1, b - 1 - LONGEST), -1):
                if b - a > 1 and seeds[b] == seeds[a]:
                    continue
                self.a.append(a)
                self.b.append(b)
                rows.append(features(text, self.tokens[a][0], self.tokens[b - 1][1], words[a - 1] if a else "",
                                     words[b] if b < len(words) else "", b - a))
        self.features = np.array(rows, np.int64).reshape(len(rows), -1)

    def scores(self, weights):
        """Score of each segment as each label; label 0 is outside and fits single tokens only."""
        out = weights[:, self.features].sum(axis=2)
        out[0, [b - a > 1 for a, b in zip(self.a, self.b)]] = -np.inf
        return out

    def best(self, weights):
        """The best segmentation: (label, first token, end token) of the segments that are not outside."""
        n, scores = len(self.tokens), self.scores(weights)
        label, top = scores.argmax(axis=0).tolist(), scores.max(axis=0).tolist()
        value, back = [0.0] + [-np.inf] * n, [None] * (n + 1)
        for s, (a, b) in enumerate(zip(self.a, self.b)):
            if value[a] + top[s] > value[b]:
                value[b], back[b] = value[a] + top[s], s
        out, at = [], n
        while at:
            s = back[at]
            if label[s]:
                out.append((label[s], self.a[s], self.b[s]))
            at = self.a[s]
        return out[::-1]

    def slope(self, weights, gold):
        """Gradient of the log likelihood of the segments ``gold`` {(first, end): label}, as (label x segment) weights."""
        n, scores = len(self.tokens), self.scores(weights)
        summed = np.logaddexp.reduce(scores, axis=0).tolist()
        ahead, behind = [0.0] + [-np.inf] * n, [-np.inf] * n + [0.0]
        spans = list(zip(self.a, self.b, summed))
        for a, b, s in spans:
            ahead[b] = np.logaddexp(ahead[b], ahead[a] + s)
        for a, b, s in reversed(spans):
            behind[a] = np.logaddexp(behind[a], behind[b] + s)
        outer = np.array([ahead[a] + behind[b] - ahead[n] for a, b, _ in spans])
        covered = {t for a, b in gold for t in range(a, b)}
        target = np.zeros_like(scores)
        for s, (a, b, _) in enumerate(spans):
            if (a, b) in gold:
                target[gold[a, b], s] = 1
            elif b - a == 1 and a not in covered:
                target[0, s] = 1
        return target - np.exp(scores + outer)


def varied(text, spans):
    """The text with its spans in other forms: (text, spans). Which form depends on the span's own hash."""
    out, at, kept = [], 0, []
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        if start < at:
            continue
        old = text[start:end]
        turn = _hashed(old) % 4
        digits = NOT_DIGIT.sub("", old)
        if kind == "email":
            user, host = old.rsplit("@", 1)
            new = (f"{user} [at] {host}", f"{user} at {host.replace('.', ' dot ')}", f"{user}(at){host}",
                   f"{user} @ {host}", f"{user} [at] {host.replace('.', ' dot ')}")[_hashed(old) % 5]
        elif kind == "card":
            parts = [digits[i:i + 4] for i in range(0, len(digits), 4)]
            new = (".".join(parts), "/".join(parts), " - ".join(parts), "  ".join(parts))[turn]
        elif kind == "phone":
            tail = digits[-10:]
            new = (f"({tail[:3]}) {tail[3:6]}-{tail[6:]}", f"{tail[:3]}-{tail[3:6]}-{tail[6:]}",
                   f"{tail[:3]}.{tail[3:6]}.{tail[6:]}", f"00{digits[:-10]} {tail[:3]} {tail[3:6]} {tail[6:]}")[turn]
        else:
            new = (old.replace(".", " . "), old.replace(".", "[.]"), old.replace(".", " dot "), old.replace(".", ","))[turn]
        out.append(text[at:start])
        kept.append((kind, sum(map(len, out)), sum(map(len, out)) + len(new)))
        out.append(new)
        at = end
    return "".join([*out, text[at:]]), kept


def _gold(island, spans):
    """Labels of the token ranges that the spans cover; None if a span does not fit the segments."""
    gold = {}
    for kind, start, end in spans:
        inside = [t for t, (s, e) in enumerate(island.tokens) if s < end and start < e]
        if not inside or len(inside) > LONGEST or any(a <= t < b for a, b in gold for t in inside):
            return None
        gold[inside[0], inside[-1] + 1] = KINDS.index(kind) + 1
    return gold if all(key in set(zip(island.a, island.b)) for key in gold) else None


def looks_like(kind, text):
    """Whether a span that the field found can be of its kind."""
    digits, lowered = NOT_DIGIT.sub("", text), text.lower()
    if kind == "email":
        return bool(SPELLED.search(lowered))
    letters = re.sub(r"dot", "", lowered)
    if re.search(r"[a-z@=%$#]", letters):
        return False
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and len(re.findall(r"[0-9]+", text)) >= 3


class Model:
    """Weights of the field by label (outside, then KINDS) and hashed feature."""

    def __init__(self, weights):
        self.weights = weights

    def spans(self, text):
        """(kind, start, end, of a pattern) of all spans, by kind and start."""
        base = base_spans(text)
        out, taken = [(*s, True) for s in base], [(s, e) for _, s, e in base]
        if self.weights is not None:
            for start, end in islands(text):
                for label, a, b in (island := Island(text, start, end)).best(self.weights):
                    s, e = _trimmed(text, island.tokens[a][0], island.tokens[b - 1][1])
                    kind = KINDS[label - 1]
                    if kind == "email" and (more := MORE.match(text, e)):
                        e = more.end()
                    if s < e and not any(s <= y and x <= e for x, y in taken) and looks_like(kind, text[s:e]):
                        out.append((kind, s, e, False))
        return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1]))


def _around(text, start, end):
    """The whole tokens of a span and AROUND more to both sides on its line."""
    low, high = text.rfind("\n", 0, start) + 1, text.find("\n", end)
    before = list(re.finditer(r"\S+", text[max(low, start - PLAIN):start]))[-AROUND - 1:]
    after = re.compile(r"\S*(?:[^\S\n]+\S+){0,%d}" % AROUND).match(text, end, len(text) if high < 0 else high)
    return text[max(low, start - PLAIN) + before[0].start() if before else start:after.end()]


def _examples(text):
    """(kind, text) of the surroundings of each span, and of islands without one as kind ''."""
    spans = base_spans(text)
    for kind, start, end in spans:
        yield kind, _around(text, start, end)
    starts = sorted((s, e) for _, s, e in spans)
    lows, highs = [s for s, _ in starts], list(accumulate((e for _, e in starts), max))
    for start, end in islands(text):
        # Spans that start before the island's end; one of them ends behind its start or none does.
        before = bisect_left(lows, end)
        if not before or highs[before - 1] <= start:
            yield "", text[start:end] if end - start <= PLAIN else text[start:start + PLAIN].rsplit(None, 1)[0]


def train(docs, most=ISLANDS):
    """A model from the spans of the patterns in all texts of ``docs``: the surroundings of at most ``most`` spans of each
    kind, and islands without spans, as many as of all kinds, all chosen by hash.

    Kinds that no text holds are not learned. If no text at all holds a span, the field is off: patterns only.
    """

    def run(batches):
        # The smallest hashes of a task; they hold the smallest of all.
        best = {kind: {} for kind in ("", *KINDS)}
        for batch in batches:
            for value in batch.column("text"):
                for kind, part in _examples((value.as_py() or b"").decode("utf-8", "replace")):
                    best[kind].setdefault(hashlib.blake2b(part.encode("utf-8", "replace"), digest_size=8).hexdigest(), part)
                    if len(best[kind]) > 8 * most * len(KINDS):
                        best[kind] = dict(sorted(best[kind].items())[:bound(kind)])
        rows = [(kind, h, part) for kind, own in best.items() for h, part in sorted(own.items())[:bound(kind)]]
        yield pa.record_batch([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], ["kind", "hash", "island"])

    def bound(kind):
        return most if kind else most * len(KINDS)

    found = stable(binary_text(docs).mapInArrow(run, "kind string, hash string, island string").distinct())
    rows = [r for kind in (*KINDS, "")
            for r in found.where(F.col("kind") == kind).orderBy("hash", "island").limit(bound(kind)).collect()]
    rows = {r.island: r for r in rows}.values()
    lessons = []
    for r in rows:
        base = base_spans(r.island)
        for text, spans in ((r.island, base), varied(r.island, base)) if base else ((r.island, []),):
            island = Island(text, 0, len(text))
            gold = _gold(island, spans) if island.tokens else None
            if gold is not None:
                lessons.append((island, gold))
    if not any(gold for _, gold in lessons):
        return Model(None)
    weights = np.zeros((len(KINDS) + 1, WIDTH))
    seen = np.full_like(weights, 1e-6)
    for _ in range(PASSES):
        for island, gold in lessons:
            slope = np.zeros_like(weights)
            push = island.slope(weights, gold)
            for label in range(len(weights)):
                np.add.at(slope[label], island.features, push[label][:, None])
            at = slope != 0
            seen[at] += slope[at] ** 2
            weights[at] += STEP * slope[at] / np.sqrt(seen[at])
    return Model(weights)


def found_spans(docs, model):
    """doc_id and spans (kind, start, end in code points, base: of a pattern) of every whole text, by kind and start.

    Null and empty texts have none. Repeated rows are searched one by one; other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "base"), s)) for s in model.spans(
                (t.as_py() or b"").decode("utf-8", "replace"))] for t in batch.column("text")]
            kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
            yield pa.record_batch([batch.column("doc_id"), pa.array(spans, pa.list_(kind))], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return binary_text(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, spans {SPANS}")


def masked_text(text, spans):
    """The text with the name of its kind in brackets for each span; of overlapping spans the earlier one names it."""
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if end <= at:
            continue
        if start >= at:
            out.append(text[at:start] + f"[{kind.upper()}]")
        at = end
    return "".join([*out, text[at:]])


def masked(docs, model):
    """``docs`` with the spans of every text masked; null texts stay null. All rows and columns stay."""
    schema, columns = docs.schema, docs.columns

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            clean = [t if t is None else masked_text(t, model.spans(t)) for t in texts]
            yield batch.set_column(columns.index("text"), "text", pa.array(clean, batch.schema.field("text").type))

    return docs.mapInArrow(run, schema)
