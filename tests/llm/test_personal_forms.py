"""Every form of ``varied`` is found end to end, by a model that learned from plain addresses and numbers."""

import random

import pytest

from bandlore.llm import personal as M

WORDS = "we met them near the old mill and spoke about weather before dinner while others waited".split()


def luhn_number(rng):
    head = "".join(rng.choice("123456789") for _ in range(15))
    return next(head + d for d in "0123456789" if M.luhn(head + d))


def span(rng, kind):
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(3, 8)))
    if kind == "email":
        return f"{word()}@{'.'.join(word() for _ in range(rng.randint(1, 2)))}.{rng.choice(['com', 'org', 'net'])}"
    if kind == "ip":
        return ".".join(str(rng.randint(11, 250)) for _ in range(4))
    if kind == "card":
        return luhn_number(rng)
    return "+1" + "".join(rng.choice("23456789") for _ in range(10))


def sentence(rng, inside):
    words = [rng.choice(WORDS) for _ in range(18)]
    return " ".join([*words[:9], inside, *words[9:]])


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(2)
    texts = [sentence(rng, span(rng, M.KINDS[i % 4])) for i in range(240)]
    texts += [sentence(rng, rng.choice(["at 10:30", "in 2024", "at home. Then", "12 of 40"])) for _ in range(80)]
    return M.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_every_form_is_masked(model):
    rng = random.Random(4)
    for kind in M.KINDS:
        for _ in range(24):
            text = sentence(rng, old := span(rng, kind))
            at = text.index(old)
            new, [(_, start, end)] = M.varied(text, [(kind, at, at + len(old))])
            found = [s for s in model.spans(new) if s[1] < end and start < s[2]]
            if M.looks_like(kind, new[start:end]):
                assert [(s[1], s[2]) for s in found] == [(start, end)], new  # some phones also are valid cards


def test_spelled_addresses(model):
    for text in ("please write to john at example dot com about it", "please write to john [at] example dot com about it"):
        [(kind, start, end, _)] = model.spans(text)
        assert kind == "email" and text[start:end].startswith("john ") and text[end:] == " about it"
    assert model.spans("we met at home. Then they sat at tables near the door") == []


def test_features_read_the_whole_segment():
    a, b = (M.features(text, 0, len(text), "", "", 1) for text in ("x" * 90 + "@y.com", "x" * 90 + "12345"))
    assert sum(x != y for x, y in zip(a, b)) >= 5
