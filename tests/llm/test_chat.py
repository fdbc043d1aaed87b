import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from tarmac.llm import chat

from .helpers import WORD

SCHEMA = "conv_id long, turn long, role string, text string, window string, t string, loss string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def conversations():
    rng = random.Random(10)
    bits = ["word ", "<|", "|>", "\\", "<\\|", "<|end|>", "<|turn|>", "<|text|>", "é", "日本 ", "\n", "### Assistant: ", "</turn>", "<"]
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 14)):
            role = "system" if turn == 0 and conv % 2 else rng.choice(["user", "assistant", "assistant", "a<|b\\"])
            rows.append((conv, turn, role, "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))))
    rows += [(100, 0, None, None), (100, None, "assistant", "first"), (100, 0, None, None), (101, 0, "assistant", None), (102, 0, "assistant", "w " * 5000), (102, 1, "user", "after"), (None, 0, "assistant", "no id")]
    rows += [(103, t, "assistant" if t % 2 else "user", f"turn {t} of many") for t in range(300)]
    return rows


def test_round_trip(spark):
    rows = conversations()
    got = {r.conv_id: r for r in chat.read_back(chat.windows(frame(spark, rows), budget=60, history_budget=20, most_history=2)).collect()}
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        target = "".join(t for _, r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(target), hashlib.sha256(target.encode()).hexdigest())


def test_windows_follow_the_budget(spark):
    budget, history, most = 60, 20, 2
    out = defaultdict(list)
    for r in chat.windows(frame(spark, conversations()), budget=budget, history_budget=history, most_history=most).orderBy("conv_id", "window").collect():
        out[r.conv_id].append(r)
    assert max(map(len, out.values())) > 5
    for rows in out.values():
        system = None
        for n, r in enumerate(rows):
            pieces = r.text.split(chat.END)[:-1]
            seen = [p for p in pieces if p.startswith(chat.SEEN)]
            new = [p for p in pieces if p.startswith(chat.NEW)]
            assert len(seen) + len(new) == len(pieces) and new and r.window == n
            count = lambda p: len(WORD.findall(p.split(chat.TEXT, 1)[1].replace("<\\|", "<|").replace("\\\\", "\\")))
            if n == 0:
                assert not seen
                system = pieces[0][len(chat.NEW) :] if pieces[0].startswith(chat.NEW + "system" + chat.TEXT) else None
            elif system is not None:
                assert seen[0] == chat.SEEN + system
            extra = len(seen) - (system is not None and n > 0)
            assert extra <= most and (extra == 0 or sum(map(count, seen[len(seen) - extra :])) <= history)
            assert r.n_tokens == sum(map(count, pieces))
            assert r.n_tokens <= budget or len(new) == 1
            # the mask covers the new assistant texts and nothing else
            masked = [r.text[m.start : m.start + m.length] for m in r.loss]
            assert masked == [p.split(chat.TEXT, 1)[1] for p in new if p.startswith(chat.NEW + "assistant" + chat.TEXT)]


def test_control_conversation_and_empty_table(spark):
    empty = chat.windows(frame(spark, []))
    assert empty.count() == 0 and chat.read_back(empty).count() == 0
    rows = chat.control_conversation(frame(spark, [])).collect()
    assert [(r.conv_id, r.turn, r.role, r.text) for r in rows] == [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def test_no_python_in_the_plan(spark):
    plan = chat.read_back(chat.windows(frame(spark, []).where(F.lit(True))))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_a_long_conversation(spark):
    """Windows do not carry their conversation: a text of 12 MB in 20 000 turns passes, and every turn comes back."""
    words = "word " * 120
    made = spark.range(20_000).selectExpr("9L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", f"concat(id, ' ', '{words}') AS text")
    made = made.unionByName(spark.createDataFrame([(9, None, "system", "first of all")], "conv_id long, turn long, role string, text string"))
    out = chat.windows(made)
    told = chat.read_back(out).first()
    assert told.n_turns == 20_001
    said = "system\nfirst of all\n" + "".join(f"{'assistant' if i % 2 else 'user'}\n{i} {words}\n" for i in range(20_000))
    assert told.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert out.agg(F.max(F.length("text"))).first()[0] < 20_000
