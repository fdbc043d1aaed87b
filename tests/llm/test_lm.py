import math
import random
from collections import Counter
from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from tarmac.llm import lm
from tarmac.session import materialise

from .helpers import WORD, ascii_lower, documents, rows_of

QUICK = replace(lm.Settings(), frequent=20, classes=3, burn=3, samples=4)


def tokens(text):
    return WORD.findall(ascii_lower(text or "")) + [""]


def check_base(rows, got, held):
    learned = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    total, kinds = sum(learned.values()), len(learned)
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((learned[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(w), sum(learned[x] > 0 for x in w), total, held(i))
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base)) and r["score"] < 0 and math.isfinite(r["score"])


def test_counts_and_base_agree_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 150)
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice(["the", "The", "of", "a"]) + " " + rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(0, 30)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "\n \x0b"), (203, "unseen words only"), (204, "ß İ é \u2003x")]
    held = lambda i: i % 5 == 1 or i == 203
    got = rows_of(lm.score_texts(documents(spark, rows), (F.col("doc_id") % 5 == 1) | (F.col("doc_id") == 203), settings=QUICK))
    assert len(got) == len(rows)
    check_base(rows, got, held)
    assert all(abs(r["perplexity"] - 10 ** (-r["score"] / r["n_tokens"])) < 1e-6 * r["perplexity"] for r in got.values())


def test_context_beats_the_base_on_held_out_texts(spark):
    rng = random.Random(13)
    rows = []
    for i in range(300):
        own, word = rng.choice([("der", "x"), ("the", "y")])
        rows.append((i, " ".join(own if rng.random() < 0.4 else f"{word}{int(rng.expovariate(0.02))}" for _ in range(60))))
    got = rows_of(lm.score_texts(documents(spark, rows), F.col("doc_id") % 3 == 0, settings=QUICK))
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    plain = rows_of(lm.score_texts(documents(spark, rows), F.col("doc_id") % 3 == 0, settings=replace(QUICK, frequent=0)))
    assert sum(r["score"] for r in held) > sum(plain[r["doc_id"]]["score"] for r in held)


def test_probabilities_sum_to_one(spark):
    rng = random.Random(14)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(20))) for i in range(30)]
    # one token after the start of a text: each word, the end, and a word never seen
    probes = [(1000 + n, w) for n, w in enumerate(["a", "b", "c", "d", "e", "f", "g", "h", "unseen", ""])]
    got = rows_of(lm.score_texts(documents(spark, rows + probes), F.col("doc_id") >= 1000, settings=replace(QUICK, frequent=0)))
    end = 10 ** got[1009]["score"]
    total = sum(10 ** got[1000 + n]["score"] / end for n in range(9)) + end
    assert abs(total - 1) < 1e-3


def test_seating_keeps_its_sums():
    rng = np.random.default_rng(15)
    c = rng.integers(0, 400, 50)
    a = rng.random(50) * 20
    seats = lm.Seats(c, a, 0.4, rng)
    for _ in range(60):
        seats.sweep(a)
        by = np.add.reduceat(np.append(seats.sizes, 0), seats.at)
        assert (seats.c == c).all() and (by == c).all() and (seats.sizes >= 0).all()
        assert (seats.t == [np.count_nonzero(seats.sizes[x : x + r]) for x, r in zip(seats.at, seats.room)]).all()


def test_gibbs_reaches_the_exact_distribution():
    """Tables of one dish with three customers: the weights of all seatings are known."""
    a, d, n = 0.8, 0.3, 4000
    seats = lm.Seats(np.full(n, 3), np.full(n, a), d, np.random.default_rng(16))
    seen = np.zeros(4)
    for i in range(60):
        seats.sweep(np.full(n, a))
        if i >= 20:
            seen += np.bincount(seats.t, minlength=4)
    weight = np.array([0, a * (1 - d) * (2 - d), 3 * a * a * (1 - d), a**3])
    assert np.abs(seen / seen.sum() - weight / weight.sum()).max() < 0.01


def test_without_training_rows_and_empty(spark):
    got = rows_of(lm.score_texts(documents(spark, [(1, "a b"), (2, None)]), F.lit(True), settings=QUICK))
    assert got[1]["train_tokens"] == 0 and got[1]["n_known"] == 0 and got[2]["n_tokens"] == 1
    assert lm.score_texts(documents(spark, []), F.lit(False), settings=QUICK).count() == 0
    twice = lm.score_texts(documents(spark, [(1, "a b"), (1, "a b"), (None, "c")]), F.lit(None).cast("boolean"), settings=QUICK).collect()
    assert len(twice) == 3 and all(r.train_tokens == 8 and not r.held_out for r in twice)


def table_weights(c, a, d, most):
    """The distribution of the number of tables, by the recursion over customers."""
    t = np.arange(most + 1)
    logs = np.where(t == 1, 0.0, -np.inf)
    with np.errstate(divide="ignore"):
        for n in range(1, c):
            logs = np.logaddexp(logs + np.log(np.maximum(n - d * t, 0)), np.concatenate([[-np.inf], logs[:-1]]))
    w = np.exp(logs + t * math.log(a) - np.max(logs + t * math.log(a)))
    return w / w.sum()


def test_a_sweep_seats_all_customers_of_large_dishes():
    """The count of tables of 100 000 customers follows its exact distribution from the first sweep on, whatever the start."""
    t, n = np.arange(401), 4000
    for c, a, d in ((100_000, 40.0, 0.5), (100_000, 0.3, 0.8), (3000, 2.0, 0.1), (200, 30.0, 0.4), (400, 5000.0, 0.6)):
        tables = lm.Tables(np.full(n, c), d, np.random.default_rng(17), np.full(n, c // 2))
        tables.sweep(np.full(n, a))
        w = table_weights(c, a, d, 400)
        mean = (w * t).sum()
        spread = math.sqrt((w * (t - mean) ** 2).sum())
        assert abs(tables.t.mean() - mean) < 5 * spread / math.sqrt(n), (c, a, d)
        assert abs(tables.t.std() / spread - 1) < 0.1, (c, a, d)


def test_rounds_continue_the_seating(spark):
    c = np.array([1, 5, 900, 20_000])
    held = lm.squeezed(b"a\nb\nc", np.array([0, 1, 2, 2], np.uint32), np.array([0, 0, 0, 1], np.uint8), c)
    vocabulary = spark.createDataFrame([(0, bytearray(held))], "bucket long, held binary")
    totals = lm.Totals(20_906, 3, 0.5, 0.5, np.array([906, 20_000]), np.array([300, 100]), 1.0)
    none = replace(lm.Settings(), burn=0, samples=0)
    first = materialise(lm.seated(vocabulary, None, totals, lm.Settings()))
    state = lm.opened(first.first().state)[0]
    again = lm.opened(lm.seated(vocabulary, first, totals, none).first().state)[0]
    assert (state == again).all() and (state >= 1).all() and (state <= c).all() and state[0] == 1


def test_the_preceding_word_is_a_context(spark):
    """Each rare word has a follower of its own; classes of frequent words cannot tell which."""
    rng = random.Random(18)
    rows = [(i, " ".join(f"of a{k} b{k}" for k in (rng.randrange(60) for _ in range(20)))) for i in range(120)]
    swapped = [(1000 + i, t.replace(" b", " c").replace(" a", " b").replace(" c", " a")) for i, t in rows[:10]]
    held = (F.col("doc_id") >= 1000) | (F.col("doc_id") % 4 == 0)
    got = rows_of(lm.score_texts(documents(spark, rows + swapped), held, settings=replace(QUICK, frequent=1)))
    for i in (0, 4, 8):
        # "of" and followers are certain, so a token in three is a choice of one in sixty
        assert got[i]["perplexity"] < 60 ** (1 / 3) * 1.25
        assert got[1000 + i]["score"] < got[i]["score"] - 20


def test_probabilities_sum_to_one_in_every_context(spark):
    """Predictive probabilities of all words and of an unseen one, in known and unknown restaurants, with many blocks and buckets."""
    rng = np.random.default_rng(19)
    words = [b"", *(f"w{i}".encode() for i in range(12))]

    def blob(word, seat, n):
        order = np.lexsort((seat, word))
        listed, sizes = np.unique(word[order], return_counts=True)
        names, where = np.unique(seat[order], return_inverse=True)
        return lm.squeezed(b"\n".join(words[i] for i in listed), sizes.astype(np.uint32), where.astype(np.uint32), n[order].astype(np.uint32), names.astype(np.uint64) + np.uint64(77), (names % 2).astype(np.uint8))

    asked = []
    for block in range(3):
        word, seat = (x.ravel() for x in np.meshgrid(np.arange(13), np.arange(8), indexing="ij"))
        # the last word and the last restaurant have no customers
        n = np.where((word == 12) | (seat == 7), 0, rng.poisson(1.0, len(word)) * rng.integers(1, 40, len(word)))
        for bucket in range(2):
            mine = word % 2 == bucket
            asked.append((bucket, block, bytearray(blob(word[mine], seat[mine], n[mine]))))
    asked = spark.createDataFrame(asked, "bucket long, block long, asked binary")
    vocabulary = materialise(lm.merged_words(asked, 2, 2))
    add = lambda df, c: np.array([r[c] for r in df.collect()]).sum(0)
    totals = lm.Totals(0, int(add(vocabulary, "kinds")), 0.4, 0.3, add(vocabulary, "customers"), add(vocabulary, "tables"), 1.0, 0.6)
    shares, seats = materialise(lm.pooled(vocabulary, 2)), None
    for _ in range(2):
        seats = materialise(lm.seated(vocabulary, seats, totals, lm.Settings(), shares))
        totals = replace(totals, customers=add(seats, "customers"), tables=add(seats, "tables"))
        shares = materialise(lm.pooled(seats, 2))
    known = vocabulary.select("bucket", "held", "blocks", "asks").join(seats.select("bucket", "seats"), "bucket").join(shares, "bucket")
    found = {(r.of, r.bucket): 10.0 ** lm.opened(r.answer)[1] for r in lm.answers(known, totals).collect()}
    for block in range(3):
        total = sum(found[block, b].reshape(-1, 8).sum(0) for b in range(2))
        assert np.abs(total - 1).max() < 1e-4
