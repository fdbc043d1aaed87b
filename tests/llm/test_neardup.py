import random

import pytest

from tarmac.llm import neardup

from .helpers import documents, rows_of, shingles


def brute(rows, percent):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    name = {i: i for i, _ in sets}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                name[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets}


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**9)}"
    return out


@pytest.mark.parametrize("percent, pairwise, rows", [(85, 64, 1024), (60, 64, 1024), (85, 2, 7), (60, 0, 20)])
def test_components_agree_with_brute_force(spark, monkeypatch, percent, pairwise, rows):
    monkeypatch.setattr(neardup, "PAIRWISE", pairwise)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", rows)
    rng = random.Random(percent)
    rows, i = [], 100
    line = [f"w{rng.randrange(500)}" for _ in range(60)]
    for _ in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 5, 8, 40, 90, 200]))]
        for _ in range(rng.randint(1, 6)):
            rows.append((i, " ".join(edited(rng, base, rng.randint(0, 3)))))
            i += rng.randint(1, 3)
    chain = [f"c{n}" for n in range(300)]  # every link of the chain moves on a little, so its ends are far apart
    for n in range(8):
        rows.append((i + n, " ".join(chain[10 * n : 10 * n + 150])))
    i += 20
    for _ in range(40):  # a star of copies that are far from each other, all of one passage
        rows.append((i, " ".join(edited(rng, line, rng.randint(0, 6)))))
        i += 1
    rows += [(i + n, "same copy of one text for all of them") for n in range(30)]
    rng.shuffle(rows)
    got = rows_of(neardup.near_duplicates(documents(spark, rows), percent=percent))
    for i, (n, least) in brute(rows, percent).items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, least, i == least)


def test_edges(spark):
    rows = [(5, None), (6, ""), (7, " \n "), (8, "A b"), (9, "a  B"), (9, "a b"), (None, "a\tb"), (None, "alone in the world of texts"), (11, "long " * 20_000)]
    out = neardup.near_duplicates(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    got = {(r.doc_id, r.component_id, r.kept, r.n_shingles) for r in out}
    assert got == {(5, 5, True, 0), (6, 6, True, 0), (7, 7, True, 0), (8, 8, True, 1), (9, 8, False, 1), (None, 8, False, 1), (None, None, True, 2), (11, 11, True, 1)}
    assert neardup.near_duplicates(documents(spark, [])).count() == 0


def test_merged_components_of_graphs(spark):
    rng = random.Random(3)
    for nodes, links in ((60, 45), (60, 59), (40, 100)):
        edges = [(x, x + 1) for x in range(links)] if links == 59 else [tuple(rng.sample(range(nodes), 2)) for _ in range(links)]
        rng.shuffle(edges)
        name = list(range(nodes))
        for _ in range(nodes):
            for a, b in edges:
                name[a] = name[b] = min(name[a], name[b])
        comps = spark.createDataFrame([(i, i) for i in range(nodes)], "node long, comp long")
        got = neardup.merged(comps, spark.createDataFrame(edges, "a long, b long"))
        assert {r.node: r.comp for r in got.collect()} == dict(enumerate(name))


def test_size_bound_rules_out_no_link():
    rng = random.Random(9)
    for _ in range(3000):
        a, own, n_b = rng.randint(1, 60), rng.randint(0, 30), rng.randint(1, 90)
        own = min(own, a)
        shared = min(a - own, n_b)
        linked = 100 * shared >= 85 * (a + n_b - shared)
        assert not linked or n_b <= (a - own) * 185 // 85 - a


def test_sample_overlap_is_sure():
    assert neardup.surely_shared(64, 85) == 34 and neardup.surely_shared(64, 100) == 64
    assert neardup.surely_shared(64, 80) < neardup.surely_shared(64, 85)
