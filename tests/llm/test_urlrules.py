import random

from tarmac.llm import urlrules

from .helpers import rows_of


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "<html>", "x", 1, "r") for i, u in rows], "page_id long, url string, html string, host string, key int, rule string")


def test_listed_rules_and_edges(spark):
    cases = {
        1: ("http://A.Example.NET/en/1?x#y", "a.example.net", "/en/1", "example.net/en/", "allow"),
        2: ("https://example.net/de/", "example.net", "/de/", "net/", "block"),
        3: ("https://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
        4: ("x://net", "net", "", None, "allow"),
        5: ("https://example.com/de", "example.com", "/de", None, "allow"),
        6: ("https://w.example.com/de/a://b", "w.example.com", "/de/a://b", "example.com/de/", "block"),
        7: ("http://é.org/fr/?q", "é.org", "/fr/", "org/fr/", "allow"),
        8: (None, "", "", None, "allow"),
        9: ("no scheme.net/", "", "", None, "allow"),
        10: ("", "", "", None, "allow"),
        11: ("://", "", "", None, "allow"),
        12: ("http://ÄB.net#/en/", "Äb.net", "", None, "allow"),
    }
    none = spark.createDataFrame([], "url string, verdict string")
    got = rows_of(urlrules.judge(pages(spark, [(i, c[0]) for i, c in cases.items()] + [(1, cases[1][0])]), labels=none), "page_id")
    for i, (_, *want) in cases.items():
        assert [got[i][c] for c in ("host", "path", "rule", "verdict")] == want, i
    assert urlrules.judge(pages(spark, [])).count() == 0


def test_mined_rules_agree_with_brute_force(spark):
    rng = random.Random(11)
    url = lambda: f"http://{rng.choice(['casino', 'blog', 'news', 'www'])}.{rng.choice(['a', 'b', 'c'])}.xyz/{rng.choice(['win', 'read'])}/{rng.randint(1, 99)}?{rng.choice(['id', 'ref', 'p'])}=1"
    labels = [(u, "block" if "casino" in u and "/win/" in u or rng.random() < 0.03 else "allow") for u in (url() for _ in range(400))]
    rows = [(i, url()) for i in range(120)]
    frame = spark.createDataFrame(labels, "url string, verdict string")
    got = rows_of(urlrules.judge(pages(spark, rows), rules=(), labels=frame, least_support=0.02, least_confidence=0.7), "page_id")

    def tokens(u):
        host, path = u.split("/")[2], u.split("/")[3:]
        return {"scheme=http", *("host=" + h for h in host.split(".")), "path=" + path[0], "path=0", "key=" + u.split("?")[1].split("=")[0]}

    known = [(tokens(u), v) for u, v in labels]
    for i, u in rows:
        own = sorted(tokens(u))
        best = (0, 0, 0, False, "allow")
        for mask in range(1, 1 << len(own)):
            part = {t for j, t in enumerate(own) if mask >> j & 1}
            held = [v for t, v in known if part <= t]
            for v in ("block", "allow"):
                n = held.count(v)
                if n and n / 400 >= 0.02 and n / len(held) >= 0.7:
                    best = max(best, (n / len(held), n / 400, -len(part), v == "block", v))
        assert got[i]["verdict"] == best[-1], u
        assert abs((got[i]["confidence"] or 0) - best[0]) < 1e-9
    assert {"block", "allow"} == {r["verdict"] for r in got.values()}


def test_without_labels_all_else_is_allowed(spark):
    got = rows_of(urlrules.judge(pages(spark, [(1, "http://a.b/c")]), rules=()), "page_id")
    assert got[1]["verdict"] == "allow" and got[1]["confidence"] is None


def test_shared_query_strings_do_not_multiply(spark):
    """Thirty keys that every URL carries, or none of them, count as one item."""
    shared = "&".join(f"utm{i}=x" for i in range(30))
    rows = [(i, f"https://a{i % 7}.net/p{i % 5}/x?{shared}") for i in range(200)] + [(1000 + i, f"https://b{i % 7}.org/fr/p{i % 5}?q=1") for i in range(200)]
    # judged by the keys alone: all of them, one of them, none
    rows += [(2000, f"https://c.info/zz?{shared}"), (2001, "https://c.info/zz?utm3=1"), (2002, "https://c.info/zz?other=1")]
    found = {r.page_id: r for r in urlrules.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert [found[i].verdict for i in (2000, 2001, 2002)] == ["block", "block", "allow"] and found[2001].confidence == 1.0
    assert len(found) == 403
