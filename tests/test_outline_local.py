"""Outlines, local brightness and lineage paths against plain loops."""

import numpy as np
import pytest

from tissueloom.operators import lineage, local, outline


def inside(x, y, rings):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and (x - x1) * (y2 - y1) * (1 if y2 > y1 else -1) < (y - y1) * (x2 - x1) * (1 if y2 > y1 else -1):
                odd = not odd
    return odd


@pytest.mark.parametrize("side", [3, 16])
def test_outline(spark, side):
    rng = np.random.default_rng(side)
    rings, points = {}, []
    for s in range(12):  # random rings cross themselves and each other; small numbers put points on edges and vertices
        rings[s] = [[tuple(map(int, p)) for p in rng.integers(-6, 24, (rng.integers(1, 7), 2))] for _ in range(rng.integers(1, 4))]
        points += [(f"s{s}", x, y) for x in range(-8, 27) for y in range(-8, 27)]
    rings[0] = [[(0, 0), (20, 0), (20, 20), (0, 20)], [(4, 4), (12, 4), (12, 14), (4, 14)]]
    points += [("none", 1, 1), ("s0", 1, 1), ("s0", 1, 1)]
    rows = [(f"s{s}", r, i, x, y) for s, own in rings.items() for r, ring in enumerate(own) for i, (x, y) in enumerate(ring)]
    table = spark.createDataFrame(rows, "slice string, ring int, seq int, x int, y int")
    spots = spark.createDataFrame(points, "slice string, x int, y int")
    got = sorted(map(tuple, outline.crop_to_outline(spots, table, side).collect()))
    edges = {f"s{s}": [r for r in own if len(set(r)) > 1] for s, own in rings.items()} | {"none": []}
    assert got == sorted(p for p in points if inside(p[1], p[2], edges[p[0]]))
    assert outline.crop_to_outline(spots, table.limit(0), side).count() == 0


def test_box_means_and_local_cut(spark, monkeypatch):
    monkeypatch.setattr(local, "TILE_SIDE", 8)
    rng = np.random.default_rng(3)
    board = {(s, x, y): int(rng.integers(0, 255)) for s in "ab" for x in range(-5, 22) for y in range(30) if rng.random() < 0.8}
    reach = {"a": 0, "b": 9}
    pixels = spark.createDataFrame([(*p, v, reach[p[0]]) for p, v in board.items()], "slice string, x int, y int, value int, reach int")

    def mean(values, p, r):
        near = [values[q] for q in values if q[0] == p[0] and abs(q[1] - p[1]) <= r and abs(q[2] - p[2]) <= r]
        return sum(near) / len(near)

    got = {(r.slice, r.x, r.y): r["mean"] for r in local.box_means(pixels).collect()}
    assert got.keys() == board.keys() and all(abs(got[p] - mean(board, p, reach[p[0]])) < 1e-9 for p in board)
    params = spark.createDataFrame([("a", 1.5, 2.0, 5), ("b", 0.0, 1.0, 3)], "slice string, amount double, radius double, block_size int")
    sharp = {(r.slice, r.x, r.y): r.value for r in local.sharpen(pixels.drop("reach"), params).collect()}
    amount, radius, block = {"a": 1.5, "b": 0.0}, {"a": 2, "b": 1}, {"a": 2, "b": 1}
    for p, v in board.items():
        want = min(max(v + amount[p[0]] * (v - mean(board, p, radius[p[0]])), 0), 255)
        assert abs(sharp[p] - want) < 1e-5
    above = {p for p in sharp if round(sharp[p], 6) > round(mean(sharp, p, block[p[0]]), 6)}
    table = spark.createDataFrame([(*p, v) for p, v in sharp.items()], "slice string, x int, y int, value double")
    assert {tuple(r) for r in local.local_foreground(table, params).collect()} == above


def test_every_parameter_of_a_slice_counts(spark):
    spot = {(20 + i, 20 + j): 200 for i in range(4) for j in range(4)} | {(60 + i, 60 + j): 140 for i in range(4) for j in range(4)}
    rows = [(s, x, y, spot.get((x, y), 40)) for s in ("a", "b") for x in range(80) for y in range(80)]
    image = spark.createDataFrame(rows, "slice string, x int, y int, value int")
    fields = "slice string, dilation_distance double, amount double, block_size int, radius double, otsu_class int, otsu_index int"
    params = spark.createDataFrame([("a", 0.0, 1.0, 9, 2.0, 2, 0), ("b", 2.0, 1.0, 9, 2.0, 2, 0)], fields)
    got = local.segment_cells_locally(image, params)
    assert got.count() == len(rows)
    sizes = {(r.slice, r.label): r["count"] for r in got.filter("label <> 0").groupBy("slice", "label").count().collect()}
    assert len(sizes) == 4 and [n for (s, _), n in sorted(sizes.items()) if s == "a"] == [16, 16]
    assert all(n == 16 + 4 * 4 * 2 + 4 for (s, _), n in sizes.items() if s == "b")  # grown by a disc of 2


def test_lineage_paths(spark):
    rng = np.random.default_rng(4)
    edges = [(f"n{a}", f"n{b}", float(rng.choice([0.5, 0.25, 1.0, 0.3]))) for a in range(9) for b in range(9) if rng.random() < 0.3]
    edges += [("n0", "n1", 0.1), ("x", "y", 0.0), ("y", "z", 2.0), (None, "n1", 0.5)]
    best = {}

    def walk(path, p):
        for a, b, q in edges:
            if a == path[-1] and b not in path and 0 < q <= 1:
                longer = [*path, b]
                rank = (-round(p * q, 12), len(longer), longer)
                best[path[0], b] = min(best.get((path[0], b), rank), rank)
                walk(longer, p * q)

    for i in range(9):
        walk([f"n{i}"], 1.0)
    got = lineage.lineage_paths(spark.createDataFrame(edges, "parent string, child string, prob double")).collect()
    assert {(r.src, r.dst): (-round(r.prob, 12), r.steps + 1, r.path) for r in got} == best
