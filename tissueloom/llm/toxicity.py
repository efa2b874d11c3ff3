"""Toxicity by a classifier chain: linear models in a row, each fed the earlier ones' probabilities.

The first model sees hashed words and word stems; the second also the first category's probability,
and so on.  Later models are trained with out-of-fold probabilities (each document's come from a model
that has not seen it), so they meet the same kind of input as in use.  Models are fitted on a bounded sample
of labelled documents; every document is scored with the broadcast weights.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueloom.llm.common import bounded_sample, map_texts

#: Feature buckets, labelled documents to train on, folds, gradient steps, words a worker remembers.
FEATURES, TRAIN_ROWS, FOLDS, STEPS, MEMORY = 1 << 16, 6_000, 3, 60, 300_000
STEMS = (4, 5, 6)
#: Documents and standard errors a bucket needs to get a weight; ridge penalty.
MIN_DOCS, MIN_Z, RIDGE = 5, 4.0, 1e-4
#: Categories in chain order, as SQL over the label columns.
CATEGORIES = {"poor": "quality = 0", "toxic": "toxic = 1"}

_KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)
)  # lower case; everything but letters and non-ASCII bytes is a gap


@lru_cache(maxsize=MEMORY)
def word_features(word: bytes) -> tuple[int, ...]:
    """A word and its stems: the first few letters."""
    crc = zlib.crc32
    stems = (b"%d:%b" % (n, word[:n]) for n in STEMS if len(word) > n)
    return (crc(word) % FEATURES, *(crc(s) % FEATURES for s in stems))


def features(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of a whole text, and its symbol and capital shares as three coarse buckets."""
    raw = (text or "").encode("utf-8")
    found = set()
    for word in set(raw.translate(_KEEP).split()):
        found.update(word_features(word))
    size = max(len(raw), 1)
    capitals = sum(map(raw.count, (b"A", b"E", b"I", b"N", b"O", b"R", b"S", b"T")))
    signs = sum(map(raw.count, (b"*", b"$", b"%", b"&", b"|", b"#", b"!")))
    found.add(zlib.crc32(b"capitals%d" % min(capitals * 40 // size, 9)) % FEATURES)
    found.add(zlib.crc32(b"signs%d" % min(signs * 40 // size, 9)) % FEATURES)
    return np.fromiter(sorted(found), np.int32, len(found))


class Rows:
    """Sparse 0/1 rows: bucket ids in a row after the other."""

    def __init__(self, items: list[np.ndarray]):
        self.at = np.r_[0, np.cumsum([len(x) for x in items])].astype(np.int64)
        self.ids = np.concatenate(items) if items else np.empty(0, np.int32)
        self.row = np.repeat(np.arange(len(items)), np.diff(self.at))

    def __len__(self):
        return len(self.at) - 1

    def only(self, wanted: np.ndarray) -> "Rows":
        """The same rows without the buckets that are not wanted."""
        keep, out = wanted[self.ids], Rows([])
        out.ids, out.row = self.ids[keep], self.row[keep]
        out.at = np.r_[0, np.cumsum(np.bincount(out.row, minlength=len(self)))].astype(np.int64)
        return out

    def times(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weight[self.ids], len(self))

    def back(self, error: np.ndarray) -> np.ndarray:
        return np.bincount(self.ids, error[self.row], FEATURES)


def fit_linear(rows: Rows, extra: np.ndarray, y: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression with per-weight step sizes (full gradient); rows with ``use`` 0 count nothing.

    Only buckets whose share differs between the classes by ``MIN_Z`` standard errors get a weight:
    a text holds hundreds of rare words, which would otherwise be learnt by heart.
    """
    weight, side = np.zeros(FEATURES), np.zeros(extra.shape[1] + 1)
    sum_w, sum_s = np.full(FEATURES, 1e-8), np.full(len(side), 1e-8)
    full = np.c_[extra, np.ones(len(y))]
    seen = max(use.sum(), 1)
    n1, n0 = rows.back(use * y), rows.back(use * (1 - y))
    all1, all0 = max((use * y).sum(), 1), max((use * (1 - y)).sum(), 1)
    share = (n1 + n0) / (all1 + all0)
    error_of = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / all1 + 1 / all0))
    telling = (n1 + n0 >= MIN_DOCS) & (np.abs(n1 / all1 - n0 / all0) >= MIN_Z * error_of)
    rows = rows.only(telling)
    balance = np.where(y == 1, 0.5 / max((use * y).sum() / seen, 1e-3), 0.5 / max((use * (1 - y)).sum() / seen, 1e-3))
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(rows.times(weight) + full @ side, -30, 30)))
        error = (p - y) * use * balance / seen
        g, s = rows.back(error) + RIDGE * weight, full.T @ error
        sum_w += g * g
        sum_s += s * s
        weight -= 0.3 * g / np.sqrt(sum_w)
        side -= 0.3 * s / np.sqrt(sum_s)
    return weight, side


def predict(rows: Rows, extra: np.ndarray, model) -> np.ndarray:
    weight, side = model
    return 1 / (1 + np.exp(-np.clip(rows.times(weight) + np.c_[extra, np.ones(len(rows))] @ side, -30, 30)))


def train_chain(items: list[np.ndarray], labels: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """One model per label column; later ones are trained on out-of-fold probabilities of earlier ones."""
    rows, n = Rows(items), len(items)
    fold = np.arange(n) % FOLDS
    extra, chain = np.zeros((n, 0)), []
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(float)
        chain.append(fit_linear(rows, extra, y, np.ones(n)))
        if c + 1 < labels.shape[1]:
            out = np.zeros(n)
            for f in range(FOLDS):
                part = fit_linear(rows, extra, y, (fold != f).astype(float))
                out[fold == f] = predict(rows, extra, part)[fold == f]
            extra = np.c_[extra, out]
    return chain


def score_chain(texts: list[str | None], chain) -> np.ndarray:
    """Probabilities, one column per category; each step sees the columns before it."""
    rows = Rows([features(t) for t in texts])
    extra = np.zeros((len(texts), 0))
    for model in chain:
        extra = np.c_[extra, predict(rows, extra, model)]
    return extra


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str] = CATEGORIES) -> list:
    """Chain fitted on about ``TRAIN_ROWS`` labelled documents (all, if fewer); null labels are left out."""
    marks = [F.expr(e).cast("int").alias(f"y{i}") for i, e in enumerate(categories.values())]
    marked = labels.select("doc_id", *marks).dropna().dropDuplicates(["doc_id"])
    sample = bounded_sample(marked, "doc_id", TRAIN_ROWS)
    names = [f"y{i}" for i in range(len(categories))]
    both = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most about TRAIN_ROWS narrow rows

    def build():
        return lambda texts: ([features(t) for t in texts],)

    got = map_texts(both, ["doc_id", *names], "ids array<int>", build).toArrow().sort_by("doc_id")
    items = [np.array(x, np.int32) for x in got.column("ids").to_pylist()]
    return train_chain(items, np.stack([got.column(n).to_numpy() for n in names], axis=1)) if items else []


def classify(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str] = CATEGORIES, threshold: float = 0.6
) -> DataFrame:
    """``doc_id``, ``p_<category>`` per category and ``toxic`` for every document.

    ``toxic``: probability of the last category at or above ``threshold``.  A null or empty text has
    probability 0 everywhere, as have all documents without any labelled one.  Repeated rows give repeated
    results, an empty table an empty one; other columns are not looked at.
    """
    chain = docs.sparkSession.sparkContext.broadcast(train(docs, labels, categories))

    def build():
        def work(texts):
            p = score_chain(texts, chain.value) if chain.value else np.zeros((len(texts), len(categories)))
            p[[not t for t in texts]] = 0.0
            return [*p.T, p[:, -1] >= threshold]

        return work

    ddl = ", ".join(f"p_{c} double" for c in categories) + ", toxic boolean"
    return map_texts(docs, ["doc_id"], ddl, build)
