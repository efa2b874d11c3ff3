"""URL filter rules against a plain loop over all rules."""

import numpy as np
import pytest

from tissueloom.llm import urls

RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
    ("net", "/fr/", "block"), ("", "/x", "block"), ("b.com", "", "block"), ("a.b.com", "/", "allow"), ("com", "/b/cc", "block"),
    ("ORG", "/Up", "block"), ("org", "/Up", "allow"), (None, "/", "block"), ("org", None, "block"), ("org", "/", "maybe"), ("é.fr", "/ü", "block"),
]


def split(url):
    """Host and path by plain string search."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    path = rest[end:]
    stop = min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


def brute(url, rules):
    host, path = split(url)
    best = None
    for h, p, v in rules:
        if h is None or p is None or v not in ("allow", "block"):
            continue
        h = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in h)
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h) + len(p), len(h), h + p, v))
    return host, path, best and best[2], best[3] if best else "allow"


URLS = [
    None, "", "nonsense", "http://", "https://WWW.Example.COM/en/1?x=/fr/#t", "http://example.com/en", "http://example.com/en/", "x://example.com",
    "http://notexample.com/en/1", "http://a.b.com/b/cc", "http://x.a.b.com", "http://b.com?q=://c.net/es/", "http://q.net/es/?a", "http://q.net/fr/#",
    "http://net/fr/", "http://.com/a", "http://a..com/", "http:///x", "http://example.com/en/\nline", "http://k.ORG/Upper", "http://k.org/up",
    "http://é.fr/ü/1", "http://a\0b.com/", "ftp://a.com/b/c", "http://u@b.com:80/x", "http://b.com./", "http://" + "s." * 300 + "com/" + "p/" * 3000,
]


@pytest.mark.parametrize("file_bytes", [urls.FILE_BYTES, -1])
def test_equals_plain_loop(spark, file_bytes):
    rng = np.random.default_rng(9)
    some = ["".join(rng.choice(list("acom./?#:en"), rng.integers(0, 14))) for _ in range(400)]
    rows = list(enumerate(URLS + ["http://" + s for s in some])) + [(None, URLS[4]), (4, URLS[4])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "'x' AS host", "'y' AS rule", "'z' AS verdict")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = urls.judge(pages.repartition(3), rules, file_bytes)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = sorted(((i, *brute(u, RULES)) for i, u in rows), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


@pytest.mark.parametrize("file_bytes", [urls.FILE_BYTES, -1])
def test_empty(spark, file_bytes):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert urls.judge(pages.limit(0), rules, file_bytes).count() == 0
    assert [tuple(r) for r in urls.judge(pages, rules.limit(0), file_bytes).collect()] == [(1, "a.com", "/", None, "allow")]


def test_collisions_are_told_apart():
    few = lambda key: len(key) % 3  # nearly every digest collides
    rules = [(f"h{i}.com", f"/{j}", "block" if (i + j) % 2 else "allow") for i in range(40) for j in range(5)]
    packed = urls.Rules(urls.Rules.pack(rules, few))
    for h, p, v in rules:
        assert packed.judge(["x." + h], [p + "/more"], few) == [(h, p, v)]
    assert packed.judge(["h99.com", "h1.com"], ["/1", "/7"], few) == [None, None]
