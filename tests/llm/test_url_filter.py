from __future__ import annotations

import pytest

from tickloom.llm.queries import URL_RULES
from tickloom.llm.url_filter import Rule, filter_urls

CASES = {
    "http://a.example.com/de/1?x=/fr/": ("a.example.com", "/de/1", "example.com/de/", "block"),
    "HTTP://WWW.Example.NET/en/x#y": ("www.example.net", "/en/x", "example.net/en/", "allow"),
    "http://example.net/fr/": ("example.net", "/fr/", "net/", "block"),
    "https://notexample.net/en/": ("notexample.net", "/en/", "net/", "block"),
    "http://x.org/fr/1": ("x.org", "/fr/1", "org/fr/", "allow"),
    "http://x.org/en/1": ("x.org", "/en/1", None, "allow"),
    "http://x.net": ("x.net", "", None, "allow"),
    "http://x.net?q=/": ("x.net", "", None, "allow"),
    "http://net/": ("net", "/", "net/", "block"),
    "x.net/": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "a://b://c.net/": ("b:", "//c.net/", None, "allow"),
    "http://ÄA.net/É\n/": ("Äa.net", "/É\n/", "net/", "block"),
    "http://..net/": ("..net", "/", "net/", "block"),
    "http://" + "a." * 500 + "net/" + "x" * 5000: ("a." * 500 + "net", "/" + "x" * 5000, "net/", "block"),
}


def test_cases(spark):
    rows = [(i, u, "old") for i, u in enumerate(CASES)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = filter_urls(df, URL_RULES).collect()
    assert len(got) == len(rows)
    want = list(CASES.values())
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == want[r.page_id]


def test_rules_of_any_kind(spark):
    df = spark.createDataFrame([(1, "http://a.b.c/xyz")], "page_id long, url string")
    verdict = lambda *rules: filter_urls(df, list(rules)).select("rule", "verdict").first()
    assert tuple(verdict(Rule("b.c", "/xy", "block"))) == ("b.c/xy", "block")
    assert tuple(verdict(Rule("c", "", "block"), Rule("b.c", "/xz", "allow"))) == ("c", "block")
    assert tuple(verdict(Rule("c", "/", "allow"), Rule("c", "/", "block"))) == ("c/", "block")
    assert tuple(verdict()) == (None, "allow")
    assert filter_urls(df.limit(0), URL_RULES).count() == 0


@pytest.mark.parametrize("n", [2, 3000])
def test_many_rules(spark, n):
    rules = [Rule(f"h{i}.x", "/", "block") for i in range(n)]
    df = spark.createDataFrame([(i, f"http://www.h{i}.x/") for i in range(5)], "page_id long, url string")
    assert filter_urls(df, rules).where("verdict = 'block'").count() == min(n, 5)
