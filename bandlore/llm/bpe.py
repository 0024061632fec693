"""Byte-pair encoding of whole texts by longest matches with backtracking, and decoding by an offset table.

An Aho-Corasick automaton of the vocabulary finds every token that starts at a position of a word. The encoder takes
the longest, and goes on if it may stand beside the token before it: two tokens are compatible if the merges, applied to
their joined characters, leave exactly these two. If none fits, it steps back one token. Because every prefix of a
merge result is settled pair by pair, the outcome is what the merges give, in time linear in the word.

A worker keeps the encodings of recent words in a bounded table; it changes how often a word is encoded, not the result.
"""

import hashlib
import json
import unicodedata

import pyarrow as pa

from bandlore.llm.common import LOWER, binary_text, tokenizer_path

#: Words whose encoding a worker remembers.
REMEMBERED = 300_000
WORD_END = "</w>"
_encoders = {}


def _byte_letters():
    """The printable letter that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(plain))
    return letters


def _lower(text):
    """NFC and lower case, letter by letter: the form of a letter does not depend on its neighbours."""
    return text.lower() if text.isascii() else "".join(map(str.lower, unicodedata.normalize("NFC", text)))


class Encoder:
    """The tables of one vocabulary: tokens, merge trees, automaton, offsets for decoding."""

    def __init__(self, text):
        import ahocorasick
        import regex

        spec = json.loads(text)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
        self.letters = {b: c for b, c in _byte_letters().items()}
        self.rank, self.parts = {}, {}
        for at, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            pair = vocab[a], vocab[b]
            self.rank[pair] = at
            self.parts[vocab[a + b]] = (*pair, at)
        self.spines = {}
        self.automaton = ahocorasick.Automaton()
        reachable, self.size, of_symbols = {}, {}, {}
        for token, i in sorted(vocab.items(), key=lambda x: self.parts.get(x[1], (0, 0, -1))[2]):
            made = self.parts.get(i)
            reachable[i] = token not in self.special and (
                made is None or reachable[made[0]] and reachable[made[1]] and self._first_join(*made[:2]) == made[2])
            if reachable[i]:
                symbols = self._marked(token.removesuffix(WORD_END)) if token.endswith(WORD_END) else token
                self.automaton.add_word(symbols, i)
                self.size[i] = len(symbols)
                of_symbols[symbols] = i
        self.shorter = {}
        for symbols, i in of_symbols.items():
            cuts = (of_symbols.get(symbols[:n]) for n in range(len(symbols) - 1, 0, -1))
            self.shorter[i] = next((c for c in cuts if c is not None), None)
        self.automaton.make_automaton()
        self.compatible = {}
        names = {i: t for t, i in (vocab | self.special).items()}
        shown = [names.get(i, "").encode() for i in range(max(names) + 1)]
        self.blob, self.offsets = b"".join(shown), [0]
        for name in shown:
            self.offsets.append(self.offsets[-1] + len(name))
        self.known = {}

    @staticmethod
    def _marked(letters):
        """The last letter of a word is a symbol of its own, moved to a private area."""
        return letters[:-1] + chr(0xE000 + ord(letters[-1]))

    def _spine(self, token, side):
        """The symbols that stand at one edge of ``token`` while it is merged, and the rank that makes the next."""
        found = self.spines.get((token, side))
        if found is None:
            found, at = [(token, float("inf"))], token
            while at in self.parts:
                made = self.parts[at]
                at = made[side]
                found.append((at, made[2]))
            found = self.spines[token, side] = tuple(reversed(found))
        return found

    def _first_join(self, a, b):
        """Rank of the first merge across the border of ``a`` and ``b``; None if there is none before both are whole.

        A merge of rank r takes place while its two symbols stand at the border, that is before either is merged
        into its own side. Of equal ranks the one further left goes first.
        """
        left, right, i, j = self._spine(a, 1), self._spine(b, 0), 0, 0
        while True:
            (x, next_x), (y, next_y) = left[i], right[j]
            r = self.rank.get((x, y))
            if r is not None and r < next_x and r <= next_y:
                return r if x == a and y == b else -1
            if i + 1 == len(left) and j + 1 == len(right):
                return None
            if next_x <= next_y:
                i += 1
            else:
                j += 1

    def _fits(self, a, b):
        fits = self.compatible.get(a << 20 | b)
        if fits is None:
            if len(self.compatible) >= REMEMBERED:
                self.compatible.clear()
            fits = self.compatible[a << 20 | b] = self._first_join(a, b) is None
        return fits

    def encode_word(self, symbols):
        """Token ids of one word, given as vocabulary letters whose last is marked."""
        longest, size, shorter, known = {}, self.size, self.shorter, self.compatible
        for end, token in self.automaton.iter_long(symbols):
            longest[end + 1 - size[token]] = token
        ids, at, dead, token, last = [], 0, None, longest[0], None
        while True:
            after = at + size[token]
            if (dead is None or after not in dead) and (
                last is None or known.get(last << 20 | token) or self._fits(last, token)
            ):
                ids.append(token)
                if after == len(symbols):
                    return ids
                at, last = after, token
                token = longest.get(at)
                if token is None:
                    token = longest[at] = next(self.automaton.iter_long(symbols, at))[1]
                continue
            token = shorter[token]
            if token is None:  # nothing goes on from here: one token back
                if dead is None:
                    dead = set()
                dead.add(at)
                token = ids.pop()
                at -= size[token]
                last = ids[-1] if ids else None

    def _piece(self, piece):
        """Ids of a run of text without ASCII white space."""
        text = piece.decode("utf-8", "replace")
        if text.isascii() and text.isalpha():
            return self.encode_word(self._marked(text.lower()))
        if self.cut is None or "<|" not in text:
            parts = [text]
        else:
            parts = self.cut.split(text)
        ids = []
        for part in parts:
            if part in self.special:
                ids.append(self.special[part])
                continue
            for word in self.words.findall(_lower(part)):
                if not (word.isascii() and word.isprintable()):
                    word = "".join([self.letters[b] for b in word.encode()])
                ids += self.encode_word(self._marked(word))
        return ids

    def decode(self, ids):
        """Names of the tokens, joined by a space."""
        blob, offsets = self.blob, self.offsets
        return b" ".join([blob[offsets[i]:offsets[i + 1]] for i in ids])

    def _entry(self, piece):
        """Count, decimal ids, decoded bytes and ids of a piece. A word before one comma or stop is looked up by itself."""
        entry = self.known.get(piece)
        if entry is None:
            if piece[-1:] in (b",", b".") and _lower(piece[:-1].decode("utf-8", "replace")).isalpha():
                word, mark = self._entry(piece[:-1]), self._entry(piece[-1:])
                entry = (word[0] + mark[0], word[1] + b" " + mark[1], word[2] + b" " + mark[2], word[3] + mark[3])
            else:
                ids = self._piece(piece)
                entry = (len(ids), b" ".join([b"%d" % i for i in ids]), self.decode(ids), tuple(ids))
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[piece] = entry
        return entry

    def pieces(self, text):
        """(count, decimal ids, decoded bytes, ids) of each piece of a text that has any token."""
        get, other = self.known.get, self._entry
        parts = (text if b"<|" in text else text.translate(LOWER)).split()
        return [e for e in [get(p) or other(p) for p in parts] if e[0]]

    def ids(self, text):
        return [i for entry in self.pieces(text) for i in entry[3]]


def encoder(text):
    """The encoder of a vocabulary file's content, built once in each worker."""
    key = hashlib.md5(text.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(text)
    return _encoders[key]


def _vocabulary(path):
    with open(path or tokenizer_path(), encoding="utf-8") as file:
        return file.read()


def encode(docs, path=None):
    """doc_id, ids (array of token ids) and n_tokens of every whole text; null, empty and blank texts have no ids.

    One row for each row of ``docs``, repeated rows included; other columns are ignored. ``path`` is the vocabulary.
    """
    text = _vocabulary(path)

    def run(batches):
        own = encoder(text)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [own.ids(t.as_py() or b"") for t in part.column("text")]
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(map(len, ids), pa.int64())],
                    ["doc_id", "ids", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return binary_text(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, ids array<int>, n_tokens long")


def decode(rows, path=None):
    """``rows`` (doc_id, ids) as doc_id and text: the names of the tokens joined by a space. Null ids give null."""
    text = _vocabulary(path)

    def run(batches):
        own = encoder(text)
        for batch in batches:
            texts = [None if i is None else own.decode(i).decode("utf-8", "replace")
                     for i in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip_digests(docs, path=None):
    """doc_id, n_tokens, SHA-256 of the decimal ids and of the decoded text, from one pass over the texts.

    The same ids and names as ``encode`` and ``decode`` give, hashed where they are made.
    """
    text = _vocabulary(path)

    def digest(parts):
        return hashlib.sha256(b" ".join(parts)).hexdigest()

    def run(batches):
        own = encoder(text)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for value in batch.column("text"):
                found = own.pieces(value.as_py() or b"")
                counts.append(sum([e[0] for e in found]))
                of_ids.append(digest([e[1] for e in found]))
                of_text.append(digest([e[2] for e in found]))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return binary_text(docs, "doc_id").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
