"""URL verdicts against a plain search through all rules."""

import random
import re

from orderloom.llm import url_rules
from orderloom.llm.queries import URL_RULES


def plain(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in rules if host and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2]), default=None)
    return host, path, best[0] + best[1] if best else None, best[2] if best else "allow"


def check(spark, urls, rules):
    pages = spark.createDataFrame([(k, u, "x", 1) for k, u in enumerate(urls)], "page_id long, url string, host string, k int")
    got = url_rules.judge_urls(pages, url_rules.rules_frame(spark, rules))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(((k, *plain(u, rules)) for k, u in enumerate(urls)), key=lambda r: r[0])


EDGE = [
    None, "", "org", "://", "http://", "http://org", "http://org/", "http://ORG/x", "http://a.example.org/es/1?x#y", "http://example.org/es",
    "http://x.example.org/en/1", "http://x.example.org/en/19", "http://notexample.org/en/1", "http://a.b.c.com/de/", "http://com/fr/?q",
    "http://com:80/fr/", "http://..org/", "http://.org/", "http://org./", "x://y://org/", "http://a.com#/de/", "http://É.org/é", "http://a\n.org/b\nc",
    "http://" + "a." * 3000 + "org/" + "p" * 100_000,
]


def test_edge_urls(spark):
    check(spark, EDGE, URL_RULES)


def test_nested_and_rival_rules(spark):
    rng = random.Random(2)
    hosts = ["a", "b.a", "c.b.a", "d.c.b.a", "aa", "a.a", "b"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/xy", "/x/y/z"]
    rules = list({(h, p): (h, p, v) for h in hosts for p in paths for v in ["allow", "block"] if rng.random() < 0.4}.values())
    urls = [f"http://{s}{h}{p}{t}" for s in ["", "q.", "b."] for h in hosts for p in paths for t in ["", "?z", "w"]]
    check(spark, urls * 2, rules)


def test_no_rules_no_pages_and_contradictions(spark):
    check(spark, EDGE, [])
    check(spark, [], URL_RULES)
    pages = spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string")
    rules = url_rules.rules_frame(spark, [("b", "/", "allow"), ("B", "/", "block"), ("b", "/", "maybe"), (None, None, "block")])
    assert [tuple(r) for r in url_rules.judge_urls(pages, rules).collect()] == [(1, "a.b", "/", "b/", "block")]
