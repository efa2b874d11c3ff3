"""Ranked lexical search against full scoring."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tissueloom.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k=50):
    """Rows (item_id, rank, doc_id, score) by scoring every document for every item."""
    bags = [(i, Counter(TERM.findall((t or "").translate(UPPER)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    total, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for doc, bag in bags:
            m = 100 - 50 + (50 * sum(bag.values()) * total) // length
            score = 0
            for t in set(TERM.findall((text or "").translate(UPPER))):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m))
            if score > 0:
                scores.append((-score, math.inf if doc is None else doc))
        for r, (s, doc) in enumerate(sorted(scores)[:k], 1):
            out.append((item, r, None if doc == math.inf else doc, -s))
    return sorted(out, key=repr)


def got(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS n", "'x' AS terms", "0 AS norm")
    i = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS item", "2 AS doc_id")
    return sorted((tuple(r) for r in lexical.rank(d.repartition(4), i, **options).collect()), key=repr)


def corpus(rng, n):
    words = [f"w{i}" for i in range(400)]
    share = 1 / np.arange(1, 401)
    share /= share.sum()
    return [(i, " ".join(rng.choice(words, rng.integers(1, 120), p=share))) for i in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_full_scoring(spark, monkeypatch, small):
    rng = np.random.default_rng(6)
    if small:  # many buckets and partitions, thresholds from few documents, two blocks of items
        monkeypatch.setattr(lexical, "BUCKET_ROWS", 50)
        monkeypatch.setattr(lexical, "PARTITION_ROWS", 200)
        monkeypatch.setattr(lexical, "FIRST_ROWS", 60)
        monkeypatch.setattr(lexical, "ITEMS", 10)
    docs = corpus(rng, 900)
    items = [(i, " ".join(docs[7 * i][1].split()[:25])) for i in range(16)]
    docs += [(2000 + i, items[3][1]) for i in range(450)]  # copies: a third of all rows, equal scores at the border
    docs += [(5, docs[5][1]), (None, items[3][1]), (None, None), (9000, ""), (9001, "*** !!!")]
    items += [(3, items[3][1]), (None, "w1 W1 w2"), (50, None), (51, "..."), (52, "unknown words")]
    assert got(spark, docs, items) == brute(docs, items)
    if small:
        assert got(spark, docs, items, k=3) == brute(docs, items, k=3)


def test_terms():
    rng = np.random.default_rng(7)
    for _ in range(2000):
        text = "".join(rng.choice(list("aZ09 _-\x00\x7f\x80éÉ漢😀\n'"), rng.integers(0, 20)))
        assert lexical.terms_of(text) == [t.encode() for t in TERM.findall(text.translate(UPPER))]


def test_empty(spark, empty, edge):
    items = spark.createDataFrame([(1, "shared line")], "item_id bigint, text string")
    assert lexical.rank(empty, items).count() == 0
    assert lexical.rank(edge, items.limit(0)).count() == 0
    assert [(r["rank"], r.doc_id) for r in lexical.rank(edge, items).orderBy("rank").collect()] == [(1, 6), (2, None), (3, 7)]


def test_bounds_skip(spark, monkeypatch):
    """Once a query has its best, buckets of short vectors are skipped and unlikely documents are not scored."""
    rng = np.random.default_rng(8)
    sizes = np.full(500, 10)
    terms = np.concatenate([rng.choice(60, 10, replace=False) for _ in range(500)])
    impact = rng.integers(1, 1000, 5000)
    norm = np.sqrt(np.bincount(np.repeat(np.arange(500), sizes), impact.astype(float) ** 2))
    bucket = lexical.Bucket(np.arange(500), norm, sizes, terms, impact)
    query = np.arange(0, 60, 3)
    member = np.isin(np.arange(60), query)
    full = np.bincount(np.repeat(np.arange(500), sizes), impact * member[terms]).astype(int)
    for least in (0, 500, 2000, 3500, int(full.max()), int(full.max()) + 1):
        found = bucket.search(query, member, least)
        want = np.flatnonzero(full >= max(least, 1))
        assert (found is None and not len(want)) or (found[0].tolist(), found[1].tolist()) == (want.tolist(), full[want].tolist())
    assert bucket.search(query, member, int(math.sqrt(20) * norm.max()) + 2) is None
