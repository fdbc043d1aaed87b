import hashlib
import random
import re

import numpy as np
import pytest

from tarmac.llm import fim

from .helpers import documents

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def texts():
    rng = random.Random(6)
    bits = ["word", " ", "\n", "\t\x0b", "é", "日本", "🙂", "\x1c", "\xa0", "\x85", "<", "P>", "<S", ">", "\\E", "."]
    out = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    return [*out, "", " ", " \n ", "a", "a <P> b", "<S>", "<M>", "<<P>>", "<P <S <M", "many words " * 30_000, "x" * 100_000]


def made(doc_id, text, percent=50, spm=80):
    """The transformation by slices of a list."""
    units = UNIT.findall(text)
    assert "".join(units) == text
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(x in text for x in fim.MARKS) or h3 % 100 >= percent:
        return len(units), "plain", None, None, text
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_skip_list_reaches_every_rank():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 5, 17, 300, 5000):
        widths = rng.integers(1, 9, n)
        units = fim.SkipList(widths)
        at = np.concatenate([[0], np.cumsum(widths)])
        assert [units.offset(r) for r in range(n + 1)] == at.tolist()
        for wide, long, _ in units.lanes:
            assert (wide.sum(), long.sum()) == (n, at[-1])
        assert n < 300 or len(units.lanes) > 3
        for bad in (-1, n + 1):
            with pytest.raises(IndexError):
                units.offset(bad)


def test_units_are_those_of_the_pattern():
    for text in texts():
        assert fim.unit_widths(text).tolist() == [len(u) for u in UNIT.findall(text)]


@pytest.mark.parametrize(("percent", "spm"), [(50, 80), (100, 50)])
def test_output_and_way_back(spark, percent, spm):
    rows = [(i, t) for i, t in enumerate(texts())] + [(7000, None), (None, "no id at all"), (5, "twice or more"), (5, "twice or more")]
    found = fim.transform(documents(spark, rows), percent=percent, spm_percent=spm).withColumn("back", fim.restored(fim.F.col("output"), fim.F.col("form")))
    got = sorted((str(r.doc_id), r.n, r.form, str(r.prefix_chars), str(r.middle_chars), r.output, r.back) for r in found.collect())
    want = []
    for i, t in rows:
        n, form, p, m, out = made(i, t or "", percent, spm)
        want.append((str(i), n, form, str(p), str(m), out, t or ""))
    assert got == sorted(want)
    assert {"spm", "psm", "plain"} == {r[2] for r in got}


def test_other_marks(spark):
    marks = ("[p|", "(s)", "\\m.")
    rows = [(i, f"one two {i} three (s four") for i in range(60)] + [(99, "has (s) inside")]
    found = fim.transform(documents(spark, rows), percent=100, marks=marks).withColumn("back", fim.restored(fim.F.col("output"), fim.F.col("form"), marks)).collect()
    assert all(r.back == dict(rows)[r.doc_id] for r in found)
    assert {r.doc_id for r in found if r.form == "plain"} == {99}


def test_empty_table(spark):
    out = fim.digests(fim.transform(documents(spark, [])))
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"] and out.count() == 0
