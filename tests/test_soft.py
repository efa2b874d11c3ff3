"""Soft correspondences against plain numpy, and turns that hard matches of noisy vectors cannot find."""

import math

import numpy as np
import pytest

from tissueloom.operators import align, soft


def scaled(pairs, relax, rounds):
    """The same scaling on dictionaries."""
    k = {key: math.exp(-min(cost, 300.0)) for key, cost in pairs.items()}
    v = {d: 1.0 for _, d in k}
    for last in range(rounds + 1):
        u = {s: (1 / sum(w * v[d] for (t, d), w in k.items() if t == s)) ** relax for s, _ in k}
        if last < rounds:
            v = {d: (1 / sum(w * u[s] for (s, t), w in k.items() if t == d)) ** relax for _, d in k}
    return {(s, d): u[s] * w * v[d] for (s, d), w in k.items()}


@pytest.mark.parametrize("relax, rounds", [(0.5, 5), (0.8, 16)])
def test_scaling(spark, relax, rounds):
    rng = np.random.default_rng(4)
    pairs = {(int(s), int(d)): float(c) for s, d, c in zip(rng.integers(0, 8, 40), rng.integers(0, 6, 40), rng.random(40) * 6)}
    pairs[(99, 99)] = 1e6  # far beyond what the kernel tells apart
    pairs[(0, 98)] = 0.0
    rows = [(g, s, d, c) for g in ("a", "b") for (s, d), c in pairs.items() if g == "a" or s != 3]
    got = soft.scale_pairs(spark.createDataFrame(rows, "pair string, src int, dst int, cost double"), ["pair"], relax).collect()
    want = {"a": scaled(pairs, relax, rounds), "b": scaled({k: c for k, c in pairs.items() if k[0] != 3}, relax, rounds)}
    assert len(got) == len(rows)
    assert all(math.isclose(r.w, want[r.pair][r.src, r.dst], rel_tol=1e-9) for r in got)
    assert {(r.src, r.dst): r.cost for r in got if r.pair == "a"} == pairs


def test_scaling_settles(spark):
    """More rounds change next to nothing."""
    rng = np.random.default_rng(9)
    pairs = {(s, d): float(c) for s in range(6) for d, c in enumerate(rng.random(7) * 5)}
    few, many = scaled(pairs, 0.5, 5), scaled(pairs, 0.5, 60)
    assert max(abs(few[p] - many[p]) for p in pairs) < 1e-3


def test_scaling_of_nothing_and_bad_relax(spark):
    none = spark.createDataFrame([], "pair int, src int, dst int, cost double")
    assert soft.scale_pairs(none, ["pair"]).count() == 0
    for relax in (0.0, 1.0):
        with pytest.raises(ValueError):
            soft.scale_pairs(none, ["pair"], relax)


def slices(turns, noise, lost, seed=11):
    """A lattice with gaps, turned; vectors with noise, and a share of points whose vector tells nothing."""
    rng = np.random.default_rng(seed)
    base = np.array([(x, y) for x in range(0, 80, 4) for y in range(0, 60, 4) if (x * 7 + y * 3) % 11], float)
    rows = []
    for s, t in enumerate(turns):
        rot = np.array([[math.cos(t), -math.sin(t)], [math.sin(t), math.cos(t)]])
        for i, p in enumerate(base):
            if rng.random() < 0.1:
                continue  # no counterpart in the other slice
            x, y = rot @ p + [5 * s, -3 * s]
            vec = rng.random(2) * [80, 60] if rng.random() < lost else p + rng.normal(scale=noise, size=2)
            rows.append((f"S{s}", s, i, float(x), float(y), vec.tolist()))
    return rows


SCHEMA = "slice string, slice_idx int, cell bigint, x double, y double, vec array<double>"


def test_turn_from_noisy_vectors(spark):
    """The soft fit alone finds the turn where hard matches are far off."""
    cells = spark.createDataFrame(slices([0.0, 0.5], noise=6.0, lost=0.4), SCHEMA)
    got = {r.slice_idx: r for r in soft.register_softly(cells).collect()}
    assert (got[0].theta, got[0].tx, got[0].ty) == (0, 0, 0)
    back = np.array([[math.cos(0.5), math.sin(0.5)], [-math.sin(0.5), math.cos(0.5)]]) @ [-5, 3]
    assert math.isclose(got[1].theta, -0.5, abs_tol=0.01) and np.allclose([got[1].tx, got[1].ty], back, atol=0.5)
    moving = cells.filter("slice_idx = 1").withColumnRenamed("slice_idx", "pair")
    fixed = cells.filter("slice_idx = 0").selectExpr("slice_idx + 1 AS pair", "cell", "x", "y", "vec")
    step = soft.soft_steps(moving, fixed).first()
    hard = align.register_slices(cells, rounds=0).filter("slice_idx = 1").first()
    assert abs(step.theta + 0.5) < 1e-4 and abs(hard.theta + 0.5) > 0.02


def test_one_slice_alone(spark):
    cells = spark.createDataFrame(slices([0.0], 1.0, 0.0), SCHEMA)
    assert [tuple(r) for r in soft.register_softly(cells).collect()] == [(0, 0.0, 0.0, 0.0)]
