import random

from tarmac.llm import quality

from .helpers import WORD, documents, rows_of


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = {j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(1 for i, x in enumerate(lines) if x in lines[:i])
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_counts_agree_with_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice(["a", "bé", "#c", "日本", " ", "\n", "\x0b", " ", "d "]) for _ in range(rng.randint(0, 120)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, " \n\t "), (903, "word " * 30_000)]
    got = rows_of(quality.clean_lines(documents(spark, rows)))
    assert len(got) == len(rows)
    for i, text in rows:
        r = got[i]
        counts = (30_000, 120_000, 0, 0, 30_000) if i == 903 else brute(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts, text
        assert r["base_failed"] == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])


GOOD = "A sentence of some length that ends as it should.\nAnother one follows it, with other words in it!"


def test_lines_are_judged_first(spark):
    cases = {
        1: (GOOD, True, GOOD),
        2: (GOOD + "\nHome | News | About | Contact.", True, GOOD),
        3: (GOOD + "\nAll rights reserved by the owner.", True, GOOD),
        4: (GOOD + "\nno end here", True, GOOD),
        5: ("BUY!! THIS!! NOW!! AND!! THAT!! TOO!! IT!! IS!! CHEAP!! TODAY!! ONLY!!", False, ""),
        6: ("one two three four five six seven eight nine ten eleven", False, ""),
        7: (GOOD + "\nA short line.\nA short line.", True, GOOD + "\nA short line."),
        8: (None, False, ""),
    }
    got = rows_of(quality.clean_lines(documents(spark, [(i, c[0]) for i, c in cases.items()])))
    for i, (_, kept, clean) in cases.items():
        assert (got[i]["kept"], got[i]["clean_text"]) == (kept, clean), i


def test_a_document_that_loses_too_much_is_rejected(spark):
    text = GOOD + "\n" + "\n".join(f"menu{i} entry{i} number{i} without{i} an end" for i in range(20))
    got = rows_of(quality.clean_lines(documents(spark, [(1, text)])))
    assert not got[1]["kept"] and not got[1]["base_failed"] and got[1]["n_failed_lines"] == 20


def test_empty_table(spark):
    assert quality.clean_lines(documents(spark, [])).count() == 0
