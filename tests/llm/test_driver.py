"""What the text operators bring to the driver: models and summaries, whatever the number of documents."""

import pickle

import pytest
from pyspark.sql.classic.dataframe import DataFrame

import __spark_entry__

# rows and bytes that a query may fetch: histograms by length, words of the model, n-gram counts by language, the benchmark itself
MOST = {
    "op1_line_cleaning": (0, 0), "op4_secret_scan": (0, 0), "op5_length_buckets": (4097, 1 << 19), "op9_chat_windows": (0, 0),
    "op10_language_mixture": (100, 1 << 14), "op11_fill_in_middle": (0, 0), "op12_prefix_trie": (20, 1 << 14), "op13_byte_bpe": (0, 0),
    "op7_compression_toxicity": (10, 16 << 20), "op6_benchmark_windows": (1000, 4 << 20),
}


@pytest.mark.parametrize("name", MOST)
def test_little_reaches_the_driver(spark, monkeypatch, name):
    seen = []

    def noted(kind):
        real = getattr(DataFrame, kind)

        def call(self, *args, **options):
            got = real(self, *args, **options)
            rows = list(got) if kind != "first" else [r for r in [got] if r is not None]
            seen.extend(len(pickle.dumps(tuple(r))) for r in rows)
            return iter(rows) if kind == "toLocalIterator" else got

        monkeypatch.setattr(DataFrame, kind, call)

    for kind in ("collect", "toLocalIterator", "first"):
        noted(kind)
    monkeypatch.setattr(DataFrame, "toPandas", lambda self: pytest.fail("toPandas"))
    __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")
    rows, size = MOST[name]
    assert len(seen) <= rows and sum(seen) <= size, (len(seen), sum(seen))
