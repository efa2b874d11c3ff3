"""The top level of the M-tree: many subtrees, clusters, a mass of copies, lengths and odd rows, against brute force."""

import numpy as np
import pytest

from tissueloom.llm import mtree


def brute(rows, every, k):
    full = {i: np.floor(256 * np.asarray(v, float)).astype(np.int64) for i, v in rows}
    out = set()
    for q, qv in full.items():
        if q % every == 0:
            ranked = sorted((-int(qv @ v), i) for i, v in full.items() if i != q and len(v) == len(qv))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked)}
    return out


def clustered(n, dim, groups, seed):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(groups, dim))[rng.integers(0, groups, n)] * 2 + rng.normal(size=(n, dim)) * 0.1
    return [(i, x.tolist()) for i, x in enumerate(v)]


@pytest.mark.parametrize("kind", ["even", "clusters", "copies", "lengths"])
def test_many_subtrees_equal_brute_force(spark, kind):
    rng = np.random.default_rng(9)
    rows = clustered(1200, 8, 12, 1)
    if kind == "even":
        rows = [(i, x.tolist()) for i, x in enumerate(rng.normal(size=(1200, 8)))]
    if kind == "copies":  # a third is one vector: its subtree is dealt into blocks by hash, ties go by id
        rows = [(i, [0.5] * 8 if i % 3 == 0 else v) for i, v in rows]
    if kind == "lengths":  # one length with a top level, one without, a vector without components
        rows = [(i, v[:3] if i % 20 == 0 and i < 1000 else v) for i, v in rows] + [(5000, []), (5050, [])]
    data = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS block", "'x' AS dim", "2 AS subtree")
    _, routing = mtree.index(mtree.quantized(data, "vec_id", "embedding"), 100)
    assert all(8 <= len(level.objects) for level in routing.values()) and routing
    got = [tuple(r) for r in mtree.top_k(data, every=25, block_rows=100).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, 25, 5)


def test_clusters_spare_subtrees(spark):
    """With clusters a query meets a few subtrees, not all."""
    rows = clustered(3000, 16, 40, 2)
    rows = [(i, (np.array(v) / np.linalg.norm(v)).tolist()) for i, v in rows]
    table = mtree.quantized(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), "vec_id", "embedding")
    _, routing = mtree.index(table, 100)
    queries = table.filter("vec_id % 25 = 0").selectExpr("*", "cast(null AS bigint) AS floor")
    first = mtree.visits(queries, routing, 5, first=True)
    # own cluster's score: nearly the squared norm of 256
    again = mtree.visits(queries.selectExpr("vec_id", "dim", "v", "60000L AS floor"), routing, 5, first=False)
    per_query = (first.count() + again.count()) / queries.count()
    assert per_query <= 0.4 * len(routing[16].objects)
    every = mtree.visits(queries, routing, 5, first=False)  # no score to beat: all of them
    assert every.count() + first.count() == queries.count() * (routing[16].rows > 0).sum()


def test_repeated_ids_and_few_rows(spark):
    rows = [(0, [1.0, 0.0])] * 150 + [(1, [0.5, 0.5]), (2, None), (3, [float("nan"), 1.0]), (None, [1.0, 1.0])]
    data = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [tuple(r) for r in mtree.top_k(data, block_rows=40).collect()]
    assert got == [(0, 1, 1, 256 * 128)]
    assert mtree.top_k(data.limit(0)).count() == 0
