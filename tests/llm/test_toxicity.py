import random

import pytest

from tarmac.llm import toxicity

from .helpers import documents, rows_of

INSULTS = ["dreckskerl", "vollpfosten", "hohlkopf", "schwachmat"]


def text(rng, bad, n=120):
    words = ["".join(rng.choice(["the", "an", "er", "ing", "ou", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    for _ in range(5 if bad else 0):
        words[rng.randrange(n)] = rng.choice(INSULTS)
    return " ".join(words)


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(17)
    rows = [(i, text(rng, i % 4 == 0)) for i in range(400)]
    labels = [(i, int(i % 4 == 0), 1) for i in range(400)] + [(5000, 1, 0), (None, 1, 0), (3, None, 0)]
    frame = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    return toxicity.train(documents(spark, rows + [(450, None), (451, "")]), frame)


def test_held_out_texts_and_edges(spark, model):
    rng = random.Random(18)
    rows = [(i, text(rng, i % 3 == 0)) for i in range(150)] + [(900, None), (901, ""), (902, " \n"), (903, text(rng, False, 30_000)), (0, "again")]
    out = toxicity.score(documents(spark, rows), model)
    assert out.count() == len(rows)
    got = rows_of(out)
    hit = [got[i]["score"] >= 0.7 for i in range(1, 150)]
    right = [h == (i % 3 == 0) for i, h in zip(range(1, 150), hit)]
    assert sum(right) > 0.95 * len(right)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert all(got[i]["score"] == got[900]["score"] < 0.7 for i in (901, 902))


def test_copies_count_once():
    rng = random.Random(19)
    copy = text(rng, False).encode()
    n = toxicity.contexts([copy] * 30)
    assert n == toxicity.contexts([copy])


def test_windows_hold_the_whole_text():
    rng = random.Random(20)
    t = text(rng, True).upper().encode() + b"\n\tEnd"
    assert b" ".join(toxicity.windows(t, 64)) == b" ".join(t.lower().split())
    assert toxicity.windows(b"", 64) == []


def test_without_both_classes(spark):
    frame = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    docs = documents(spark, [(1, "a b c"), (2, "d e f")])
    model = toxicity.train(docs, frame)
    assert model is None and {r["score"] for r in toxicity.score(docs, model).collect()} == {0.0}
    assert toxicity.train(documents(spark, []), frame) is None
    assert toxicity.score(documents(spark, []), None).count() == 0
