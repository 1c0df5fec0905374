import random
import time

import pytest
from pyspark.sql import functions as F

from lumbung.llm import urls
from lumbung.llm.urls import ALLOW, BLOCK, Entry, Trie, filter_urls, judged

ENTRIES = [
    Entry(BLOCK, "net", "/"), Entry(ALLOW, "example.net", "/en/"), Entry(BLOCK, "example.com", "/de/"),
    Entry(ALLOW, "org", "/fr/"), Entry(BLOCK, "a.example.com", ""), Entry(ALLOW, "example.com", "/de/x"),
    Entry(BLOCK, "example.com", "/de/xy"), Entry(BLOCK, "b.c", "/p"), Entry(ALLOW, "b.c", "/p"),
]


def by_hand(url, entries=ENTRIES, default=ALLOW):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [e for e in entries if (host == e.host or host.endswith("." + e.host)) and path.startswith(e.path)]
    best = max(fits, key=lambda e: (e.host.count("."), len(e.path), e.verdict == ALLOW), default=None)
    return host, path, best and best.name, best.verdict if best else default


URLS = [
    None, "", "no scheme", "http://", "http:///en/", "http://net", "http://net/", "HTTP://WWW.Example.NET/en/1?x#y",
    "https://example.net/en", "https://example.net/EN/", "http://xexample.com/de/", "http://example.com/de/xyz",
    "http://example.com/de/xa", "http://q.a.example.com", "http://a.example.com?x=/de/", "ftp://u:p@s.org:21/fr/a",
    "http://s.org/fr/a://b", "http://b.c/pq", "http://b.c/", "http://Ünet/", "http://example.com//de/", "://org/fr/",
]


def made(n=400):
    rng = random.Random(6)
    hosts = ["net", "example.net", "a.example.com", "example.com", "org", "x.y.org", "b.c", "", "com"]
    paths = ["", "/", "/en/", "/en", "/de/x", "/de/xyz/q", "/fr/a", "/p", "/pp", "//"]
    tails = ["", "?a=/en/", "#f", "?x#y"]
    return [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(tails)}" for _ in range(n)]


@pytest.mark.parametrize("most", [200_000, 0])
def test_longest_entry_wins_by_trie_and_by_join(spark, monkeypatch, most):
    monkeypatch.setattr(urls, "MOST_BROADCAST", most)
    given = URLS + made()
    pages = spark.createDataFrame([(n, u, "h") for n, u in enumerate(given)], "page_id long, url string, host string")
    entries = spark.createDataFrame([(e.verdict, e.host, e.path) for e in ENTRIES], "verdict string, host string, path string")
    found = filter_urls(spark, pages, entries).select("page_id", "host", "judged.*", F.col("judged.host").alias("h"))
    rows = sorted(filter_urls(spark, pages, entries).collect())
    assert len(rows) == len(given) and found.count() == len(given)
    for row in rows:
        assert tuple(row.judged) == by_hand(given[row.page_id]), given[row.page_id]
        assert row.host == "h"


def test_default_verdict_and_bad_entries(spark):
    pages = spark.createDataFrame([("http://q.com/",)], "url string")
    assert filter_urls(spark, pages, ENTRIES, default=BLOCK).first().judged.verdict == BLOCK
    with pytest.raises(ValueError):
        Trie([Entry(ALLOW, "", "/")])
    with pytest.raises(ValueError):
        Trie([Entry("maybe", "x", "/")])
    assert filter_urls(spark, pages.where("false"), ENTRIES).collect() == []


def test_a_long_list_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(urls, "MOST_BROADCAST", 3)
    with pytest.raises(ValueError):
        judged(spark, ENTRIES, F.lit("a"), F.lit("b"))


@pytest.mark.parametrize("most", [200_000, 0])
def test_columns_of_the_caller_stay(spark, monkeypatch, most):
    monkeypatch.setattr(urls, "MOST_BROADCAST", most)
    pages = spark.createDataFrame([("http://net/", 7, 8), (None, 9, 10)], "url string, Judged int, `a.b` int")
    entries = spark.createDataFrame([(e.verdict, e.host, e.path) for e in ENTRIES], "verdict string, host string, path string")
    found = filter_urls(spark, pages, entries)
    assert found.columns == ["url", "Judged", "a.b", "judged_"]
    rows = sorted(found.collect(), key=lambda row: row.Judged)
    assert [(r.Judged, r["a.b"], r.judged_.verdict) for r in rows] == [(7, 8, BLOCK), (9, 10, ALLOW)]


def test_many_paths_of_one_host():
    trie = Trie([Entry(BLOCK, "h.com", f"/{n:06d}") for n in range(100_000)] + [Entry(ALLOW, "h.com", "/0999")])
    start = time.perf_counter()
    for n in range(1000):
        found = trie.find("www.h.com", f"/{n + 99_500:06d}x")
        assert found.verdict == BLOCK if n < 500 else found is None
    assert time.perf_counter() - start < 0.5
    assert trie.find("h.com", "/0999").verdict == ALLOW and trie.find("h.com", "/099999").verdict == BLOCK
    assert trie.find("h.com", "/09") is None
