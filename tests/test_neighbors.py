"""Exactness of the neighbour join on every path: one block, many blocks, pivots, copies."""

import numpy as np
import pytest

from tissueloom.operators import neighbors


def brute(q, b, k, same=False):
    """{query id: [(base id, d2)…]} by (distance, id)."""
    out = {}
    for qi, qv in q.items():
        rows = sorted(
            (float(((qv - bv) ** 2).sum()), bi) for bi, bv in b.items() if not (same and bi == qi)
        )
        out[qi] = [(bi, d) for d, bi in rows[:k]]
    return out


def frame(spark, vectors, **extra):
    rows = [(i, v.tolist(), *extra.values()) for i, v in vectors.items()]
    return spark.createDataFrame(
        rows, "cell bigint, vec array<double>" + "".join(f", {c} string" for c in extra)
    )


def collected(df):
    out = {}
    for r in df.orderBy("src", "rank").collect():
        out.setdefault(r["src"], []).append((r["dst"], r["d2"]))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for key, rows in want.items():
        assert [r[0] for r in got[key]] == [r[0] for r in rows], key
        assert np.allclose([r[1] for r in got[key]], [r[1] for r in rows])


def vectors(n, dims, seed, start=0, clumps=None):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dims))
    if clumps:
        v = v * 0.05 + rng.normal(size=(clumps, dims))[rng.integers(0, clumps, n)] * 3
    return {start + i: v[i] for i in range(n)}


@pytest.mark.parametrize("dims,clumps", [(2, None), (3, 5), (10, 8)])
@pytest.mark.parametrize("block_rows", [20_000, 60])
def test_matches_brute_force(spark, dims, clumps, block_rows):
    b, q = vectors(400, dims, 1, clumps=clumps), vectors(150, dims, 2, start=1000, clumps=clumps)
    got = neighbors.knn_join(frame(spark, q), frame(spark, b), 4, block_rows=block_rows)
    same(collected(got), brute(q, b, 4))


def test_one_dense_lump_and_far_points(spark):
    """A third of all rows nearly on one spot: the lump is split, far points still find it."""
    b = vectors(100, 2, 3)
    b |= {1000 + i: v * 1e-3 for i, v in vectors(200, 2, 4).items()}
    got = neighbors.knn_join(frame(spark, b), frame(spark, b), 5, exclude_self=True, block_rows=40)
    same(collected(got), brute(b, b, 5, same=True))


def test_copies_of_one_vector(spark):
    """Many identical vectors: ties by id, and the reduction of copies changes nothing."""
    b = vectors(60, 3, 5)
    b |= {500 + i: np.array([1.0, 2.0, 3.0]) for i in range(150)}
    got = neighbors.knn_join(frame(spark, b), frame(spark, b), 3, exclude_self=True, block_rows=50)
    same(collected(got), brute(b, b, 3, same=True))


def test_integer_grid_ties(spark):
    b = {i * 12 + j: np.array([i, j], float) for i in range(12) for j in range(12)}
    for block in (20_000, 30):
        got = neighbors.knn_join(frame(spark, b), frame(spark, b), 6, exclude_self=True, block_rows=block)
        same(collected(got), brute(b, b, 6, same=True))


@pytest.mark.parametrize("block_rows", [20_000, 30])
def test_groups_stay_apart(spark, block_rows):
    left, right = vectors(120, 2, 7), vectors(90, 2, 8, start=500)
    b = frame(spark, left, g="a").union(frame(spark, right, g="b"))
    got = collected(neighbors.knn_join(b, b, 3, by=["g"], exclude_self=True, block_rows=block_rows))
    same(got, brute(left, left, 3, same=True) | brute(right, right, 3, same=True))


def test_fewer_rows_than_k_and_carried_columns(spark):
    b = vectors(3, 2, 9)
    got = neighbors.knn_join(
        frame(spark, vectors(5, 2, 10, start=50)), frame(spark, b, state="s"), 7, carry=["state"]
    ).collect()
    assert len(got) == 15 and {r["state"] for r in got} == {"s"}


def test_graph_is_symmetric_without_loops(spark):
    cells = frame(spark, vectors(80, 4, 11)).selectExpr("cell", "vec", "slice(vec, 1, 3) AS xyz")
    graph = neighbors.knn_graph(cells, 5, 2)
    assert graph.groupBy("src", "kind").count().filter("count <> if(kind = 'space', 2, 5)").count() == 0
    edges = {(r.i, r.j) for r in neighbors.symmetric_edges(graph).collect()}
    assert all((j, i) in edges and i != j for i, j in edges)


def test_visits_in_turns_give_the_same_neighbours(spark, monkeypatch):
    v = np.random.default_rng(21).normal(size=(400, 5)).round(1)
    cells = spark.createDataFrame([(i, i % 2, x.tolist()) for i, x in enumerate(v)], "cell bigint, half int, vec array<double>")
    key = lambda found: sorted(map(tuple, found.collect()))
    search = lambda: key(neighbors.knn_join(cells, cells, 4, by=["half"], exclude_self=True, block_rows=40))
    whole = search()
    sizes = []
    look = neighbors._block_join

    def noted(visits, *rest):
        sizes.append(visits.count())
        return look(visits, *rest)

    monkeypatch.setattr(neighbors, "_block_join", noted)
    monkeypatch.setattr(neighbors, "VISIT_ROWS", 150)
    assert search() == whole
    assert len(sizes) > 4 and max(sizes) < 400


@pytest.mark.parametrize("size", [1.0, 1e-30, 1e150, "mixed", "offset", "few", "same"])
def test_single_precision_only_sifts(size):
    """Ranks and distances are those of plain sums of squares, whatever the scale, with and without a bound."""
    rng = np.random.default_rng(5)
    draw = {
        "mixed": lambda s: rng.normal(size=s) * 10.0 ** rng.integers(-30, 30, s), "offset": lambda s: rng.normal(size=s) + 1e4,
        "few": lambda s: rng.integers(0, 3, s).astype(float), "same": np.ones,
    }.get(size, lambda s: rng.normal(size=s) * size)
    q, b, k = draw((40, 6)), draw((900, 6)), 7
    d2 = ((q[:, None] - b[None]) ** 2).sum(axis=2)
    order = np.argsort(d2, axis=1, kind="stable")[:, :k]
    for bound in (np.full(40, np.inf), np.take_along_axis(d2, order, 1)[:, -1], np.where(np.arange(40) % 2, np.inf, d2.max())):
        rows, cols, found = (np.concatenate(x) for x in zip(*neighbors._nearest_in_block(q, b, k, bound)))
        assert (cols.reshape(40, k) == order).all() and (rows == np.repeat(np.arange(40), k)).all()
        assert (found == d2[rows, cols]).all()
