import random

import pytest

from ledgerlens.llm import url_filters as U

URLS = [
    None, "", "no scheme", "http://", "http://NET/", "https://www.example.net/en/1?x=/fr/", "https://example.net/de/", "http://xnet/",
    "http://a.org/fr/x#y", "http://org?fr/", "http://org/frx", "http://example.com/de/", "http://notexample.com/de/", "a://b://net/x",
    "http://example.net:80/en/", "http://example.net./en/", "http://.net/", "http://é.net/\nx", "HTTP://Sub.Example.COM/de/x", "http://net/" + "x" * 50_000,
]


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        at = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:at]), rest[at:]
        path = rest[: min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))]
    fits = [
        (-len(h + (p or "")), -len(h), h + (p or ""), v)
        for h, p, v in rules
        if h is not None and v is not None and (host == h or host.endswith("." + h) or h == "") and path.startswith(p or "")
    ]
    best = min(fits, default=None)
    return (host, path, best[2] if best else None, best[3] if best else default)


def run(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "keep", "html") for i, u in enumerate(urls)], "page_id long, url string, rule string, html string")
    got = U.judged(pages.repartition(4), spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert got.columns == ["page_id", "url", "html", "host", "path", "rule", "verdict"]
    rows = sorted(got.collect())
    assert [r["page_id"] for r in rows] == list(range(len(urls)))
    return [tuple(r)[3:] for r in rows]


@pytest.mark.parametrize("rules", [list(U.RULES), [], [("", "", "block"), ("net", None, "x"), ("net", None, "x"), (None, "/", "y"), ("org", "/", None)]])
def test_odd_urls(spark, rules):
    assert run(spark, URLS * 2, rules) == [brute(u, rules) for u in URLS * 2]


def test_many_nested_rules(spark):
    r = random.Random(2)
    host = lambda n: ".".join(r.choice("abc") for _ in range(n))
    rules = sorted({(host(r.randint(1, 5)), r.choice(["/", "/x/", "", "/x/y"]), r.choice(["allow", "block"])) for _ in range(200)})
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    urls = [f"http://{host(r.randint(1, 7))}{r.choice(['/', '/x/', '', '/x/yz', '/q'])}" for _ in range(3000)]
    urls += ["http://a.b.c/x/"] * 2000
    assert run(spark, urls, rules) == [brute(u, rules) for u in urls]


def test_empty(spark):
    assert run(spark, [], list(U.RULES)) == []
