import itertools
import random
from collections import Counter, defaultdict

from tarmac.llm import packing

from .helpers import WORD, documents


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


def test_boundaries_are_optimal():
    rng = random.Random(8)
    for _ in range(80):
        lengths = sorted(rng.sample(range(0, 60), rng.randint(1, 8)))
        counts = [rng.randint(1, 9) for _ in lengths]
        k = rng.randint(1, 5)
        bounds = packing.boundaries(lengths, counts, k)
        assert len(bounds) <= k and bounds[-1] == lengths[-1] and bounds == sorted(set(bounds))
        options = (c + (lengths[-1],) for r in range(k) for c in itertools.combinations(lengths[:-1], r))
        assert padding(lengths, counts, bounds) == min(padding(lengths, counts, o) for o in options)
    assert packing.boundaries([], [], 4) == []


def test_batches(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_SHARD", 20)
    rng = random.Random(9)
    rows = [(i, "tok " * rng.randint(0, 40)) for i in range(150)] + [(900, None), (901, ""), (902, "w " * 95), (3, "again here"), (3, "again here"), (None, "no name")]
    out = packing.pack(documents(spark, rows), buckets=4, longest=30, token_budget=100).collect()
    tokens = Counter()
    batches = defaultdict(list)
    for r in out:
        tokens[r.doc_id] += r.n_tokens
        assert 0 <= r.n_tokens <= r.padded_length <= 30 and r.padding == r.padded_length - r.n_tokens and r.start_token == 30 * r.piece
        batches[r.bucket, r.batch].append(r)
    want = Counter()
    for i, t in rows:
        want[i] += len(WORD.findall(t or ""))
    assert all(tokens[i] == n for i, n in want.items())
    assert [r.n_tokens for r in sorted((r for r in out if r.doc_id == 902), key=lambda r: r.piece)] == [30, 30, 30, 5]
    last = {b: max(n for x, n in batches if x == b) for b, _ in batches}
    assert len(last) == 4
    for (bucket, batch), got in batches.items():
        room = max(1, 100 // max(got[0].padded_length, 1))
        assert sorted(r.slot for r in got) == list(range(len(got))) and len({r.padded_length for r in got}) == 1
        assert len(got) == room or batch == last[bucket] and len(got) < room
    assert packing.pack(documents(spark, [])).count() == 0
