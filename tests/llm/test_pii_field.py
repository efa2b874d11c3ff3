"""The semi-Markov field against enumeration of all segmentations, and on planted numbers."""

import time

import numpy as np
import pytest

from tissueloom.llm import pii


def segmentations(n, at=0):
    """All lists of (start, end, type) that cover n tokens."""
    if at == n:
        yield []
        return
    for end in range(at + 1, min(n, at + pii.MAX_TOKENS) + 1):
        for kind in range(pii.OTHER + 1):
            if kind < pii.OTHER or end == at + 1:
                for rest in segmentations(n, end):
                    yield [(at, end, kind), *rest]


def score(model, tokens, path):
    total = sum(model.weight[t, pii.features(" ".join(tokens[a:b]), b - a)].sum() for a, b, t in path)
    return total + sum(model.step[x, y] for (_, _, x), (_, _, y) in zip(path, path[1:]))


@pytest.fixture
def model():
    rng = np.random.default_rng(0)
    own = pii.SemiMarkov()
    own.weight += rng.normal(size=own.weight.shape)
    own.step += rng.normal(size=own.step.shape)
    return own


def test_decoder_finds_the_best_segmentation(model):
    for tokens in (["+33", "1", "23"], ["a@b.c", "10.0.0.1", "x1", "9"], ["5"]):
        best = max(segmentations(len(tokens)), key=lambda p: score(model, tokens, p))
        assert model.decode(tokens) == [s for s in best if s[2] != pii.OTHER]


def test_learning_follows_the_gradient(model):
    tokens, gold = ["+33", "1", "23", "x9"], [(0, 3, 3), (3, 4, pii.OTHER)]
    paths = list(segmentations(4))
    weights = np.exp([score(model, tokens, p) for p in paths])
    weights /= weights.sum()
    weight, step = np.zeros_like(model.weight), np.zeros_like(model.step)
    for path, share in [*zip(paths, -weights), (gold, 1.0)]:
        for a, b, t in path:
            np.add.at(weight, (t, pii.features(" ".join(tokens[a:b]), b - a)), share)
        for (_, _, x), (_, _, y) in zip(path, path[1:]):
            step[x, y] += share
    before = model.weight.copy(), model.step.copy()
    model.learn(tokens, gold, 0.1)
    assert np.allclose(model.weight - before[0], 0.1 * weight) and np.allclose(model.step - before[1], 0.1 * step)


def test_long_forms_are_found(documents):
    model = pii.train(documents)
    for text, span in (("call 0 12 34 56 78 now", None), ("call 1 23 45 67 89 now", None)):
        spans = pii.all_spans(text, model)[1]
        assert all(text[a:b].strip() and k in range(4) for k, a, b in spans), span
    assert pii.all_spans("on 2024-01-02 at 10:30", model)[1] == []


def test_many_spans_in_linear_time(documents):
    model = pii.train(documents)
    text = "a.b@c.org " * 40_000
    start = time.process_time()
    base, every = pii.all_spans(text, model)
    assert len(base) == len(every) == 40_000 and time.process_time() - start < 10
    mixed = ("x " + "a.b@c.org 10.0.0.1 " * 3 + "y ") * 5_000
    start = time.process_time()
    assert len(pii.all_spans(mixed, model)[0]) == 30_000 and time.process_time() - start < 20
