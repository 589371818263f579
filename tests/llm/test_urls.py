"""URL rules against a slow version, in one trie and in several."""

import random

import pytest
from pyspark.sql import functions as F

from matchcast.llm import urls


def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for mark in "?#":
        rest = rest.split(mark, 1)[0] if rest.find(mark) >= 0 else rest
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def slow_judge(url, rules):
    host, path = slow_parts(url)
    fit = [(h.count("."), len(p), v == "allow", h + p, v) for h, p, v in rules if ("." + host).endswith("." + h) and path.startswith(p)]
    best = max(fit, default=None) if host else None
    return (host, path, best[3], best[4]) if best else (host, path, None, "allow")


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


PLANTED = [
    None, "", "no scheme", "http://", "://net/", "http://NET/", "http://Example.NET/en/a?b#c", "http://example.net/EN/", "http://example.net/en",
    "http://example.net/english/", "http://x.y.example.com/de/", "http://badexample.com/de/", "http://a.org/fr/x://y.net/", "http://a.org/fr", "http://net",
    "http://net?x=/", "http://net#/", "x://.net/", "x://a..net/a", "x://net./a", "x://a.net:80/", "x://u@net/", "http://ÄÖ.Net/ä/", "a\nb://n\n.net/\n/x", "http://e.net//en/",
]


def test_planted_urls(spark):
    rows = [(i, u) for i, u in enumerate(PLANTED)] + [(0, None), (5, "http://NET/")]
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    table = spark.createDataFrame(rows, "page_id long, url string")
    found = urls.judge(table, urls.entries(spark, ["net/", "example.com/de/"], ["example.net/en/", "org/fr/"]))
    assert told(found) == sorted([(i, u, *slow_judge(u, rules)) for i, u in rows], key=repr)


@pytest.mark.parametrize("most", [urls.MOST_CHARS, 400])
def test_many_rules_in_one_trie_and_in_several(spark, monkeypatch, most):
    monkeypatch.setattr(urls, "MOST_CHARS", most)
    draw = random.Random(5)
    hosts = ["net", "a.net", "b.a.net", "c", "b.c", "x.b.c"]
    paths = ["", "/", "/e", "/en", "/en/", "/en/u", "/en/u/", "/f"]
    rules = {(draw.choice(hosts), draw.choice(paths)): draw.choice(["allow", "block"]) for _ in range(30)}
    rows = [(i, f"http://{draw.choice(['', 'z.', 'q.'])}{draw.choice(hosts)}{draw.choice([*paths, '/english/x', '/en/u/v?w'])}") for i in range(400)]
    table = spark.createDataFrame(rows, "page_id long, url string")
    listed = spark.createDataFrame([(h.upper(), p, v) for (h, p), v in rules.items()] + [("", "/", "block"), (None, "/", "block"), ("c", None, "block")], "host string, path string, verdict string")
    both = listed.unionByName(listed.filter("verdict = 'allow' AND path IS NOT NULL AND host != ''").withColumn("verdict", F.lit("block")))
    slow = [(h, p, v) for (h, p), v in rules.items()]
    assert told(urls.judge(table, both)) == sorted([(i, u, *slow_judge(u, slow)) for i, u in rows], key=repr)


def test_keep_allowed_and_edges(spark):
    rows = [(1, "http://a.net/", "h", 1), (2, None, "g", 2), (3, "http://a.org/", "r", 3), (3, "http://a.org/", "r", 3)]
    table = spark.createDataFrame(rows, "page_id long, url string, host string, verdict int")
    rules = urls.entries(spark, ["net/"], [])
    assert told(urls.keep_allowed(table, rules)) == rows[1:]
    assert urls.keep_allowed(table, urls.entries(spark, [], [])).count() == 4
    assert urls.keep_allowed(table, rules, default="block").count() == 0
    assert urls.keep_allowed(table.limit(0), rules).count() == 0
    with pytest.raises(ValueError, match="there already"):
        urls.judge(table, rules)
