"""Passages pasted into other lines without sentence marks around them."""

import random

from test_repeated_lines import left


def words(rng, n, letters):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(4, 8))) for _ in range(n))


def test_passages_inside_long_units_go(spark):
    rng = random.Random(11)
    for letters in ("abcdefghij", "абвгдежзик", "αβγδεζηθικ", "ابتثجحخدذر", "कखगघचछजझटठ"):
        shared = words(rng, 90, letters)
        texts = [f"{words(rng, 40 + i, letters)} {shared} {words(rng, 35, letters)}" for i in range(3)]
        got = left(spark, texts)
        assert got[0] == texts[0]
        for text, kept in zip(texts[1:], got[1:]):
            assert len(shared) * 0.5 < len(text) - len(kept) <= len(shared)


def test_scripts_without_spaces_and_their_marks(spark):
    rng = random.Random(12)
    han = lambda n: "".join(chr(rng.randrange(0x4e00, 0x9000)) for _ in range(n))
    shared = han(400)
    texts = [han(90 + i) + shared + han(70) for i in range(2)]
    got = left(spark, texts)
    assert got[0] == texts[0] and 300 < len(texts[1]) - len(got[1]) <= 400
    marked = han(60) + "。"
    texts = [han(30) + "。" + marked + han(30) + "。" for _ in range(2)]
    assert left(spark, texts) == [texts[0], texts[1].replace(marked, "")]
