import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tarmac.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, h string, pos string, part string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], SCHEMA)


def conversations():
    rng = random.Random(12)
    said = [("user", "hello"), ("assistant", "hé there"), ("user", ""), (None, None), ("system", "日本"), ("user", "hello")]
    rows = []
    for conv in [*range(150), *range(1000, 1400, 7), -6, -5, -4, -1, 10**12, 10**12 + 3]:
        rows += [(conv, t, *rng.choice(said)) for t in range(rng.choice([1, 1, 2, 3, 5, 8, 12]))]
    # groups of copies, repeated rows, ties, missing turn numbers, missing ids
    rows += [(5000 + c, t, "user", f"copy {t}") for c in range(60) for t in range(3)]
    rows += [(7, 0, "user", "hello")] * 3 + [(8, None, "user", "first"), (8, None, "assistant", "first"), (None, 0, "user", "no id"), (None, 1, None, None)]
    return rows


def brute(rows, group=5, most=9):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % most
        base = c - int(np.fmod(c, group))
        whole = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
    return sorted(
        (convs[0], len(path), members[path[:-1]][0] if path else None, len(convs), children[path], leaves[path], saved[path], hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest())
        for path, convs in members.items()
    ), members


def rows_of(df):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def test_equal_to_brute_force(spark, monkeypatch):
    monkeypatch.setattr(trie, "SLICE", 4)
    monkeypatch.setattr(trie, "PACKED", 7)
    rows = conversations()
    want, members = brute(rows)
    found = trie.prefix_trie(frame(spark, rows))
    assert rows_of(found) == want
    # the stored turn is the last one of the node
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    last = {(convs[0], len(path)): path[-1] for path, convs in members.items() if path}
    for r in found.where("depth > 0").collect():
        assert sorted(own[r.turn_conv])[r.turn_index - 1][2:] == last[r.conv_id, r.depth]


def test_a_long_conversation_and_a_long_chain(spark, monkeypatch):
    monkeypatch.setattr(trie, "SLICE", 16)
    rows = [(5, t, "user", f"t{t}") for t in range(200)]
    # each conversation of the chain leaves the path of the one before it one turn later
    rows += [(100 + 5 * c, t, "user", f"c{min(t, c)}") for c in range(20) for t in range(c + 2)]
    assert rows_of(trie.prefix_trie(frame(spark, rows))) == brute(rows)[0]


def test_other_heads(spark):
    rows = conversations()[:300]
    assert rows_of(trie.prefix_trie(frame(spark, rows), group=3, most=4)) == brute(rows, 3, 4)[0]


def test_turnless_and_empty(spark):
    lone = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(lone, 0, "user", "gone")]
    want = brute(rows)[0]
    assert len(want) == 1 and rows_of(trie.prefix_trie(frame(spark, rows))) == want
    assert trie.prefix_trie(frame(spark, [])).count() == 0
    assert trie.prefix_trie(frame(spark, [(None, 0, "user", "x")])).count() == 0


def test_collisions_are_noticed(spark, monkeypatch):
    monkeypatch.setattr(trie, "PRIMES", (11, 7, 5, 3))
    monkeypatch.setattr(trie, "TRIES", 1)
    with pytest.raises(RuntimeError, match="collide"):
        trie.prefix_trie(frame(spark, [(5 * c, t, "user", f"{c} {t}") for c in range(60) for t in range(9)]))


def test_powers_and_primes():
    for p in trie.PRIMES:
        assert all(pow(a, p - 1, p) == 1 for a in (2, 3, 5, 7, 11))
        e = np.array([0, 1, 2, 3, 9, 1000, 2**31 + 5])
        assert trie.power(12345, e, p).tolist() == [pow(12345, int(x), p) for x in e]
