"""The field learns every kind that stands anywhere, however rare spans are among digits."""

import random

from test_personal_forms import luhn_number

from bandlore.llm import personal as M


def test_rare_kinds_among_numeric_logs(spark):
    rng = random.Random(3)
    texts = [" ".join(f"step {rng.randrange(10 ** 6)} took {rng.randrange(900)} ms" for _ in range(12)) for _ in range(1500)]
    plain = [" ".join(f"step {rng.randrange(10 ** 6)} took ms" for _ in range(9)) for _ in range(3)]
    # In a line of numbers: the island around the span is longer than any that is learned as a whole.
    texts[700] = f"{plain[0]} card {luhn_number(rng)} was used {plain[1]}"
    texts[900] = f"{plain[1]} mail to anna@example.org for help {plain[2]}"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = M.train(docs)
    assert model.weights is not None
    assert (model.weights[[1, 3]] > 0.5).any(axis=1).all()
    assert M.train(docs.where("doc_id not in (700, 900)")).weights is None
