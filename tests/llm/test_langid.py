import random

import numpy as np
import pytest

from tarmac.llm import langid

from .helpers import documents, rows_of

SYLLABLES = {"aa": ["ba", "bo", "bi", "be"], "bb": ["ru", "ri", "ro", "rak"], "cc": ["sch", "zen", "lich", "ung"]}


def sentence(rng, lang, n=30):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(3)
    rows = [(i, sentence(rng, lang), lang) for i, lang in enumerate(list(SYLLABLES) * 20)]
    return langid.train(documents(spark, rows + [(500, None, "aa"), (501, "no language", None)]))


def test_languages_mixtures_and_edges(spark, model):
    rng = random.Random(4)
    rows = [(i, sentence(rng, lang)) for i, lang in enumerate(list(SYLLABLES) * 5)]
    rows += [(100, sentence(rng, "aa", 60) + " " + sentence(rng, "cc", 20)), (101, None), (102, ""), (103, "12 34 !?"), (104, "x"), (105, sentence(rng, "bb", 30_000)), (105, sentence(rng, "bb"))]
    out = langid.identify(documents(spark, rows), model)
    assert out.count() == len(rows)
    got = rows_of(out)
    assert [got[i]["lang_pred"] for i in range(15)] == list(SYLLABLES) * 5
    assert set(got[100]["langs"]) == {"aa", "cc"} and got[100]["lang_pred"] == "aa" and 0.5 < got[100]["score"] < 0.8
    assert abs(sum(got[100]["shares"]) - 1) < 1e-4
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (101, 102, 103))
    assert got[104]["lang_pred"] in SYLLABLES and got[105]["lang_pred"] == "bb"
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_counts_cover_all_rows(spark):
    rows = [(i, "abc abd", "aa") for i in range(40)] + [(i, "xyz", "bb") for i in range(7)]
    got = {(r.lang, r.slot): r.n for r in langid.count_grams(documents(spark, rows), "text", "lang", 4).collect()}
    want = {}
    for _, text, lang in rows:
        for s in langid.grams(text.encode(), 4):
            want[lang, s] = want.get((lang, s), 0) + 1
    assert got == want


def test_shares_raise_the_likelihood():
    rng = np.random.default_rng(5)
    p = rng.dirichlet(np.ones(50), 3).T.astype(np.float32)
    weights = rng.integers(1, 9, 50).astype(np.float32)
    reached = [langid.shares(p, weights, n)[1] for n in (1, 3, 10, 40)]
    assert reached == sorted(reached)
    grid = [(a, b, 1 - a - b) for a in np.linspace(0, 1, 41) for b in np.linspace(0, 1 - a, 41)]
    assert reached[-1] > max(float(weights @ np.log(p @ np.array(g, np.float32) + 1e-12)) for g in grid) - 0.5


def test_without_training_rows(spark):
    model = langid.train(documents(spark, [(1, "text", None)]))
    assert model.langs == []
    assert rows_of(langid.identify(documents(spark, [(1, "text")]), model))[1]["lang_pred"] == "und"
    assert langid.identify(documents(spark, []), model).count() == 0


def test_held_out_accuracy(spark):
    from tarmac.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    got = rows_of(QUERIES["op10_language_mixture"](spark, folder))
    truth = rows_of(spark.read.parquet(f"{folder}/documents.parquet"))
    held = [i for i, r in got.items() if r["held_out"]]
    assert len(got) == len(truth) and sum(got[i]["lang_pred"] == truth[i]["lang"] for i in held) > 0.95 * len(held)
