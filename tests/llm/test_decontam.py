import random

from tarmac.llm import decontam

from .helpers import WORD, ascii_lower, documents


def weights(words):
    s = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    return {x: s.count(x) for x in s}


def brute(text, item):
    """The largest weighted Jaccard of any window of the item's length."""
    d, w = WORD.findall(ascii_lower(text or "")), WORD.findall(ascii_lower(item or ""))
    best = 0
    for i in range(len(d) - len(w) + 1 if w else 0):
        a, b = weights(d[i : i + len(w)]), weights(w)
        best = max(best, sum(min(c, a.get(s, 0)) for s, c in b.items()) / sum(max(a.get(s, 0), b.get(s, 0)) for s in a | b))
    return best


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "extra") for i, t in items], "item_id long, text string, similarity string")


def test_finds_agree_with_brute_force(spark):
    rng = random.Random(6)
    new = lambda n: [f"v{rng.randrange(3000)}" for _ in range(n)]
    items = [(i, " ".join(new(rng.choice([1, 3, 5, 12, 30, 60])))) for i in range(12)] + [(50, None), (51, ""), (52, "x y " * 20)]
    rows = [(0, None), (1, ""), (2, "x y " * 30)]
    for n in range(40):
        words = new(rng.randint(0, 80))
        for _ in range(rng.randint(0, 2)):
            part = (rng.choice(items[:12])[1]).upper().split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = part
        rows.append((10 + n, " ".join(words)))
    rows.append((10, rows[3][1]))
    docs = documents(spark, rows)
    got = decontam.matches(docs, benchmark(spark, items)).collect()
    found = {}
    for r in got:
        found[r.doc_id, r.item_id] = max(found.get((r.doc_id, r.item_id), 0), r.similarity)
    want = {(d, i): s for d, t in rows for i, x in items if x for s in [brute(t, x)] if s >= 0.8}
    assert set(found) == set(want) and all(abs(found[k] - want[k]) < 1e-9 for k in want)
    assert len(want) > 15
    flagged = {r.doc_id for r in decontam.contaminated(docs, benchmark(spark, items)).where("_contaminated").collect()}
    assert flagged == {d for d, _ in want}


def test_every_fingerprint_within_the_radius_is_found():
    rng = random.Random(7)
    texts = [" ".join(f"t{rng.randrange(999)}" for _ in range(20)).encode() for _ in range(30)]
    index = decontam.Items(texts, 5, 15)
    for _ in range(200):
        value = int(index.prints[rng.randrange(30)])
        for bit in rng.sample(range(64), rng.randint(0, 18)):
            value ^= 1 << bit
        want = [(i, d) for i, p in enumerate(index.prints) if (d := (value ^ int(p)).bit_count()) <= 15]
        assert list(index.near(value, 20)) == want


def test_blocks_of_a_large_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 40)
    items = [(i, " ".join(f"b{i}x{j}" for j in range(8))) for i in range(5)]
    docs = documents(spark, [(i, "so " + t + " on") for i, t in items] + [(9, "nothing of the kind in here")])
    assert {(r.doc_id, r.item_id, r.start_word) for r in decontam.matches(docs, benchmark(spark, items)).collect()} == {(i, i, 1) for i in range(5)}
    assert decontam.contaminated(docs, benchmark(spark, items)).where("NOT _contaminated").count() == 1


def test_empty_tables(spark):
    assert decontam.matches(documents(spark, []), benchmark(spark, [(1, "a b c d e f")])).count() == 0
    none = decontam.matches(documents(spark, [(1, "a b c d e f")]), benchmark(spark, []))
    assert none.count() == 0 and none.columns == ["doc_id", "item_id", "start_word", "n_words", "hamming", "similarity"]


def whole_brute(text, item):
    """As ``brute``, and a text shorter than the item is one window."""
    d, w = WORD.findall(ascii_lower(text or "")), WORD.findall(ascii_lower(item or ""))
    return max(brute(text, item), one_window(d, w) if 0 < len(d) < len(w) else 0)


def one_window(d, w):
    a, b = weights(d), weights(w)
    return sum(min(c, a.get(s, 0)) for s, c in b.items()) / sum(max(a.get(s, 0), b.get(s, 0)) for s in a | b)


def test_texts_shorter_than_the_item(spark):
    rng = random.Random(8)
    items = [(i, [f"s{rng.randrange(3000)}" for _ in range(n)]) for i, n in enumerate([4, 6, 12, 40, 40, 60])]
    rows = [(0, " ".join(items[3][1][:38]))]
    for n in range(60):
        words = list(rng.choice(items)[1])
        words = words[rng.randint(0, len(words) // 8) : len(words) - rng.randint(0, len(words) // 8)]
        if rng.random() < 0.3:
            words[rng.randrange(len(words))] = "changed"
        rows.append((1 + n, " ".join(words)))
    items = [(i, " ".join(w)) for i, w in items]
    docs = documents(spark, rows)
    got = {(r.doc_id, r.item_id): r for r in decontam.matches(docs, benchmark(spark, items)).collect()}
    want = {(d, i): s for d, t in rows for i, x in items for s in [whole_brute(t, x)] if s >= 0.8}
    assert set(got) == set(want) and all(abs(got[k].similarity - want[k]) < 1e-9 for k in want)
    assert (got[0, 3].start_word, got[0, 3].n_words) == (0, 38) and abs(got[0, 3].similarity - 34 / 36) < 1e-9
    flagged = {r.doc_id for r in decontam.contaminated(docs, benchmark(spark, items)).where("_contaminated").collect()}
    assert flagged == {d for d, _ in want}


def test_similar_windows_are_found_at_any_distance(spark):
    """With a radius of 0 and with fingerprints more than 15 bits apart: nothing that is similar enough is lost."""
    rng = random.Random(9)
    items = [(i, " ".join(f"d{rng.randrange(5000)}" for _ in range(rng.choice([13, 30, 45])))) for i in range(8)] + [(8, "x y " * 20), (9, "x y " * 20)]
    rows = [(0, "x y " * 30)]
    for n in range(60):
        part = rng.choice(items)[1].split()
        part[rng.choice([0, len(part) // 2, len(part) - 1])] = "changed"
        rows.append((1 + n, " ".join(["before"] * rng.randint(0, 5) + part + ["after"] * rng.randint(0, 5))))
    docs = documents(spark, rows)
    want = {(d, i) for d, t in rows for i, x in items if whole_brute(t, x) >= 0.8}
    for radius in (0, 15):
        got = decontam.matches(docs, benchmark(spark, items), radius=radius).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want and (radius or any(r.hamming > 0 for r in got))
    far = 0
    for _ in range(1500):
        words = [f"f{rng.randrange(10**6)}" for _ in range(23)]  # 19 shingles, of which 17 stay: 17/21
        item, text = " ".join(words).encode(), " ".join(["other", "other", *words[2:]]).encode()
        index = decontam.Items([item], 5, 15)
        found = index.search(text, decontam.WordHashes(), 80)
        assert len(found) == 1 and found[0]["similarity"] == 17 / 21
        far += found[0]["hamming"] > 15
    assert far > 0
