import random

import pytest

import corpus_pipeline
from .helpers import documents


@pytest.fixture()
def folder(spark, tmp_path):
    items = [(0, "which of these seven answers to the given question is the right one after all"), (1, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def rows():
    rng = random.Random(21)
    out = [(i, " ".join("".join(rng.choice(s) for _ in range(3)) for _ in range(40)), lang) for i, (s, lang) in enumerate([("abcd", "en"), ("wxyz", "de")] * 15)]
    planted = [
        (100, out[0][1] + " and one more", "en"), (101, out[0][1], "en"), (102, out[1][1] + " Which of these seven answers TO the given question is the right one after all", "de"),
        (103, out[2][1][::-1] + " password=hunter2hunter2", "en"), (104, "1234 5678 !!", "en"), (105, None, "en"), (106, "", None), (107, out[3][1][::-1], None), (107, out[3][1][::-1], None),
        (None, out[4][1][::-1], "en"), (None, out[5][1][::-1], "de"),
    ]
    return out + planted


def test_stages_on_planted_cases(spark, folder, tmp_path):
    docs = documents(spark, rows())
    docs.write.parquet(f"{folder}/documents.parquet")
    at = spark.read.parquet(f"{folder}/documents.parquet")
    clean = set(range(30))
    gone = [{104, 105, 106}, {100, 101}, {102}, set()]
    left = clean | {100, 101, 102, 103, 104, 105, 106, 107, None}
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, at, folder)
        assert out.columns == docs.columns and out.schema == at.schema
        out.write.parquet(f"{tmp_path}/stage{n}")
        at = spark.read.parquet(f"{tmp_path}/stage{n}")
        left -= gone[n]
        assert {r.doc_id for r in at.collect()} == left, n
    assert at.where("doc_id = 107").count() == 1 and at.where("doc_id IS NULL").count() == 2
    masked = at.where("doc_id = 103").first()
    assert masked.text.endswith(" [SECRET]") and masked.n_chars == len(masked.text)
    packed = corpus_pipeline.STAGES[-1][1](spark, at, folder)
    assert {r.doc_id for r in packed.collect()} == left
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == left


def test_empty_documents(spark, folder):
    empty = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_the_mixture_decides_which_rows_stay(spark, folder):
    rng = random.Random(23)
    alphabets = {"en": "abcdef", "de": "ghijkl", "fr": "mnopqr", "es": "stuvwx"}
    said = lambda lang, n: " ".join("".join(rng.choice(alphabets[lang]) for _ in range(4)) for _ in range(n))
    rows = [(i, said(lang, 60), lang) for i, lang in enumerate(list(alphabets) * 10)]
    thirds = " ".join(said(lang, 40) for lang in ("en", "de", "fr"))
    rows += [(100, thirds, None), (101, said("en", 80) + " " + said("de", 40), None), (102, said("es", 50), None), (103, "", "en"), (104, said("fr", 50) + " " + said("de", 20), None)]
    kept = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, documents(spark, rows), folder).collect()}
    assert set(kept) == {*range(40), 101, 102, 104}
    assert (kept[101], kept[102], kept[104]) == ("en", "es", "fr")


def test_the_mixture_is_inferred_once(spark, folder):
    documents(spark, rows()).write.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.identify_language(spark, spark.read.parquet(f"{folder}/documents.parquet"), str(folder))
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_columns_of_the_same_names(spark, folder):
    rows = [(0, "a clean text without any passage of the list", "en"), (1, "Which of these seven answers TO the given question is the right one after all", "en")]
    docs = documents(spark, rows).withColumnRenamed("kept", "_contaminated").withColumnRenamed("score", "_found")
    out = corpus_pipeline.drop_benchmark_passages(spark, docs, folder)
    assert out.columns == docs.columns and [r.doc_id for r in out.collect()] == [0]
    assert corpus_pipeline.identify_language(spark, docs, folder).columns == docs.columns


def test_near_duplicates_are_decided_by_row(spark, folder):
    rng = random.Random(22)
    a, b, c, d = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(40)) for x in "abcd")
    rows = [
        (1, a, "en"), (2, a + " x", "en"), (2, b, "en"),  # id 2: a copy of 1, and a text of its own
        (3, b + " y", "en"), (4, c, "en"), (4, d, "en"), (4, d, "en"),  # id 4: two texts, one of them twice
        (None, c + " z", "en"), (None, "e " * 9 + a[::-1], "en"), (None, "e " * 9 + a[::-1], "en"), (None, None, "en"), (None, None, "en"), (5, "", "en"),
    ]
    left = sorted((str(r.doc_id), str(r.text)) for r in corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), folder).collect())
    assert left == sorted([("1", a), ("2", b), ("4", c), ("4", d), ("None", "e " * 9 + a[::-1]), ("None", "None"), ("None", "None"), ("5", "")])
