"""The url filter with lists of few and very many shapes, long urls and empty tables, against brute force."""

import random

import pytest

from corpusloom.llm import url_filter as uf

ENTRY = "host string, path string, verdict string, named boolean"


def plain(url, entries):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [e for e in entries if (host == e[0] or host.endswith("." + e[0])) and path.startswith(e[1]) and host]
    if not fits:
        return host, path, None, "allow"
    best = max(fits, key=lambda e: (e[3], len(e[0] + e[1]), len(e[0])))
    return host, path, best[0] + best[1] if best[3] else None, best[2]


@pytest.mark.parametrize("most_shapes", [4096, 3])
@pytest.mark.parametrize("n", [5, 400])
def test_lists(spark, n, most_shapes):
    rnd = random.Random(n)
    hosts = ["com", "example.com", "a.example.com", "net", "x.net", "b.c.d.org"]
    entries = sorted({(rnd.choice(hosts), "/" + "".join(rnd.choice("ab/") for _ in range(rnd.randrange(0, 1 + n // 20)))) for _ in range(n)})
    entries = [(*e, rnd.choice(["allow", "block"]), rnd.random() < 0.7) for e in entries]
    urls = [f"{rnd.choice(['http', 'x'])}://{rnd.choice(['', 'www.', 'A.B.', 'example'])}{rnd.choice(hosts)}{rnd.choice(['', '/', '?q', '#f', '/a/b/a?x', '/' + 'ab/' * rnd.randrange(9)])}" for _ in range(300)]
    urls += [None, "", "no scheme", "://", "http://x.net/" + "a" * 3000, "http://x.net/" + "ä" * 50, urls[0], urls[0]]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, rule string").repartition(3)
    got = uf.filter_urls(pages, spark.createDataFrame(entries, ENTRY), most_shapes=most_shapes)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert {r.page_id: tuple(r)[2:] for r in got.collect()} == {i: plain(u, entries) for i, u in enumerate(urls)}


def test_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    none = spark.createDataFrame([], ENTRY)
    assert [tuple(r) for r in uf.filter_urls(pages, none).collect()] == [(1, "http://a.com/x", "a.com", "/x", None, "allow")]
    assert uf.filter_urls(pages.where("FALSE"), spark.createDataFrame([("com", "/", "block", True)], ENTRY)).isEmpty()
