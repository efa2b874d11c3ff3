"""Long principal components, numbered cells and grid neighbours against plain numpy."""

import numpy as np
import pytest

from tissueloom.operators import grid, longpca


@pytest.mark.parametrize("k", [3, 50])
def test_long_components_equal_dense_ones(spark, k):
    rng = np.random.default_rng(1)
    dense = rng.normal(size=(80, 4)) @ rng.normal(size=(4, 20)) * 3 + rng.normal(size=(80, 20)) + rng.normal(size=20) * 5
    dense[rng.random(dense.shape) < 0.4] = 0
    rows = [(f"s{i % 2}", i // 2, f"g{j}", float(dense[i, j])) for i in range(80) for j in range(20) if dense[i, j]]
    found = longpca.fit_pca_long(spark.createDataFrame(rows, "slice string, cell bigint, gene string, value double"), k, extra=4)
    centred = dense - dense.mean(axis=0)
    _, s, v = np.linalg.svd(centred, full_matrices=False)
    n = min(k, 20)
    assert found.settled and np.allclose(found.share, s[:n] ** 2 / (s**2).sum(), atol=1e-7)
    loadings = {r.gene: r.vec for r in found.loadings.collect()}
    load = np.array([loadings[f"g{j}"] for j in range(20)])
    assert np.allclose(load.T @ load, np.eye(n), atol=1e-8)
    assert np.allclose(load @ load.T, v[:n].T @ v[:n], atol=1e-3)
    scores = {(r.slice, r.cell): r.X_pca for r in found.scores.collect()}
    got = np.array([scores[f"s{i % 2}", i // 2] for i in range(80)])
    assert np.allclose(got, centred @ load, atol=1e-8)


def test_no_variance(spark):
    schema = "slice string, cell bigint, gene string, value double"
    flat = spark.createDataFrame([("a", i, "g", 2.0) for i in range(4)], schema)
    assert longpca.fit_pca_long(flat, 2).scores.count() == 4
    none = longpca.fit_pca_long(flat.limit(0), 2)
    assert none.scores.count() == 0 and len(none.share) == 0


def test_cell_ids_may_repeat(spark):
    scores = spark.createDataFrame([("a_S01", 7, [1.0]), ("a_S02", 7, [2.0])], "slice string, cell bigint, X_pca array<double>")
    cells = spark.createDataFrame([("a_S01", 7, 1.0, 2.0), ("a_S02", 7, 3.0, 4.0), ("a_S02", 8, 0.0, 0.0)], "slice string, cell bigint, x double, y double")
    rows = longpca.numbered_cells(scores, cells).collect()
    assert len({r.cell for r in rows}) == 2 and {tuple(r.xyz) for r in rows} == {(1.0, 2.0, 14.0), (3.0, 4.0, 28.0)}


def brute(points, k):
    for i, (g, p) in points.items():
        d = sorted((sum((a - b) ** 2 for a, b in zip(p, q)), j) for j, (h, q) in points.items() if h == g and j != i)
        for rank, (d2, j) in enumerate(d[:k], 1):
            yield g, i, j, rank, round(d2, 6)


@pytest.mark.parametrize("dims", [1, 2, 3])
def test_grid_neighbours(spark, dims):
    rng = np.random.default_rng(dims)
    spots = [rng.normal(size=dims) * 10.0**s for s in (-5, 0, 3) for _ in range(60)]  # densities far apart
    spots += [np.zeros(dims)] * 70 + [np.full(dims, 1e6)] + [rng.integers(-3, 4, dims).astype(float) for _ in range(80)]
    points = {i: ("a" if i % 3 else "b", p.tolist()) for i, p in enumerate(spots)}
    points |= {1000 + i: ("few", [float(i)] * dims) for i in range(3)} | {2000: ("one", [5.0] * dims)}
    rows = [(g, i, p) for i, (g, p) in points.items()] + [("a", None, [0.0] * dims), ("a", 3000, [None] * dims), ("a", 3001, None)]
    table = spark.createDataFrame(rows, "g string, cell bigint, xyz array<double>")
    got = grid.grid_knn(table, 4, by=["g"]).collect()
    assert sorted((r.g, r.src, r.dst, r["rank"], round(r.d2, 6)) for r in got) == sorted(brute(points, 4))
    assert grid.grid_knn(table.limit(0), 4, by=["g"]).count() == 0
