"""Depths and touching cells against plain loops."""

import numpy as np
import pytest

from tissueloom.operators import pixels as px
from tissueloom.operators import touching

SCHEMA = "slice string, x int, y int"


def depths(board):
    """Breadth first from the places around the foreground."""
    steps = ((0, 1), (0, -1), (1, 0), (-1, 0))
    out, front, d = {}, [p for p in board if any((p[0] + i, p[1] + j) not in board for i, j in steps)], 1
    while front:
        for p in front:
            out[p] = d
        front = list({(p[0] + i, p[1] + j) for p in front for i, j in steps} & board - out.keys())
        d += 1
    return out


def split(board, rise):
    """Steepest ways up, then passes one by one from the highest."""
    depth = depths(board)
    low_x, low_y = min([0, *(p[0] for p in board)]), min([0, *(p[1] for p in board)])
    width = max(p[1] for p in board) + 1 - low_y
    number = {p: (p[0] - low_x) * width + p[1] - low_y for p in board}
    height = {p: (depth[p], -number[p]) for p in board}
    near = lambda p: [q for q in ((p[0] + 1, p[1]), (p[0] - 1, p[1]), (p[0], p[1] + 1), (p[0], p[1] - 1)) if q in board]

    def summit(p):
        while (q := max([p, *near(p)], key=height.get)) != p:
            p = q
        return p

    hill = {p: summit(p) for p in board}
    owner, joined = {t: t for t in hill.values()}, {t: t for t in hill.values()}

    def find(of, t):
        while of[t] != t:
            t = of[t]
        return t

    passes = []
    for p in board:
        for q in ((p[0] + 1, p[1]), (p[0], p[1] + 1)):
            if q in board and hill[p] != hill[q]:
                passes.append((-min(depth[p], depth[q]), number[p], number[q], hill[p], hill[q]))
    # ``owner`` follows which hills the passes so far connect, ``joined`` which of them became one cell
    for low, _, _, a, b in sorted(passes):
        up, down = sorted((find(owner, a), find(owner, b)), key=height.get, reverse=True)
        if up == down:
            continue
        if depth[down] + low < rise:
            joined[find(joined, a if find(owner, a) == down else b)] = find(joined, b if find(owner, a) == down else a)
        owner[down] = up
    label = {}
    for p in board:
        cell = find(joined, hill[p])
        label[cell] = min(label.get(cell, number[p]), number[p])
    return {p: label[find(joined, hill[p])] for p in board}


def discs(*centres):
    return {(x, y) for cx, cy, r in centres for x in range(cx - r, cx + r + 1) for y in range(cy - r, cy + r + 1)
            if (x - cx) ** 2 + (y - cy) ** 2 <= r * r}


def boards():
    rng = np.random.default_rng(8)
    noise = {(int(x), int(y)) for x, y in np.argwhere(rng.random((30, 34)) < 0.85) - 4}
    blobs = discs(*[(int(a), int(b), int(r)) for a, b, r in zip(rng.integers(-5, 40, 14), rng.integers(-5, 40, 14), rng.integers(2, 8, 14))])
    return {"two": discs((10, 10, 6), (20, 11, 6)), "noise": noise, "blobs": blobs, "block": {(x, y) for x in range(20) for y in range(9)}, "dot": {(3, 4)}}


def rows(found, column):
    out = {}
    for r in found.collect():
        out.setdefault(r.slice, {})[r.x, r.y] = r[column]
    return out


@pytest.mark.parametrize("side, rise", [(8, 2), (256, 2), (8, 1), (5, 3)])
def test_split(spark, monkeypatch, side, rise):
    monkeypatch.setattr(touching, "TILE_SIDE", side)
    monkeypatch.setattr(px, "TILE_SIDE", side)
    every = boards()
    table = spark.createDataFrame([(s, *p) for s, board in every.items() for p in board], SCHEMA)
    assert rows(touching.pixel_depths(table), "depth") == {s: depths(b) for s, b in every.items()}
    got = rows(touching.split_touching(table, rise), "label")
    assert got == {s: split(b, rise) for s, b in every.items()}
    assert len(set(got["two"].values())) == 2 and len(set(got["block"].values())) == 1


def test_nothing_and_bad_rise(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert touching.split_touching(none).count() == 0 and touching.pixel_depths(none).count() == 0
    with pytest.raises(ValueError):
        touching.split_touching(none, 0)
