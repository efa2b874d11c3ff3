"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams per language on a bounded sample of labelled documents; Spark sums
the counts and the driver receives at most ``languages x BUCKETS`` numbers.  The matrix of log
probabilities is broadcast, and every text is scored in numpy as a sparse row (its n-grams)
times that matrix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueloom.llm.common import bounded_sample, map_texts, rewrite

#: Hash buckets, n-gram lengths, labelled documents used for training, languages at most.
BUCKETS, GRAMS, TRAIN_ROWS, MAX_LANGUAGES = 1 << 16, (1, 2, 3), 8_000, 512
#: Characters scored at once; a longer text is a sum over such pieces (they overlap, nothing is left out).
PIECE = 400_000
UNDETERMINED = "und"


def gram_ids(codes: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each position."""
    h = codes[: len(codes) - n + 1].astype(np.uint32) + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
    for k in range(1, n):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) + codes[k : len(codes) - n + 1 + k]
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0xC2B2AE35)
    return (h >> np.uint32(16)).astype(np.int64)


def pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of lower-cased texts joined by two spaces, and the index of the text of each.

    Yields bounded pieces; a following piece repeats the last ``max(GRAMS) - 1`` characters with
    owner -1 for the n-grams that were already counted.
    """
    codes, owner, size = [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        own = np.frombuffer(("  " + text.lower() + "  ").encode("utf-32-le", "replace"), np.uint32)
        for at in range(0, len(own), PIECE):
            part = own[at : at + PIECE + max(GRAMS) - 1]
            codes.append(part)
            mark = np.full(len(part), i, np.int32)
            mark[PIECE:] = -1
            owner.append(mark)
            size += len(part)
            if size >= PIECE:
                yield np.concatenate(codes), np.concatenate(owner)
                codes, owner, size = [], [], 0
    if codes:
        yield np.concatenate(codes), np.concatenate(owner)


def in_training(doc_id):
    """Whether a document may be learnt from: crc32 of the id as text, modulo 5, is not 0."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5)) != 0


class Model:
    """Languages in order and the ``BUCKETS x languages`` log-probability matrix with the priors."""

    def __init__(self, names: list[str], table: np.ndarray, prior: np.ndarray):
        self.names, self.table, self.prior = names, table, prior

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Best language and its posterior probability per text."""
        total = np.zeros((len(texts), len(self.names)))
        letters = np.array([bool(t) and any(c.isalpha() for c in t) for t in texts])
        for codes, owner in pieces(texts) if self.names else ():
            for n in GRAMS:
                if len(codes) < n:
                    continue
                ids, own = gram_ids(codes, n), owner[: len(codes) - n + 1]
                starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                whose = own[starts]
                for k in range(len(self.names)):
                    sums = np.add.reduceat(self.table[k][ids], starts, dtype=np.float64)
                    np.add.at(total[:, k], whose[whose >= 0], sums[whose >= 0])
        if not self.names:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        total += self.prior
        best = total.argmax(axis=1)
        odds = np.exp(total - total.max(axis=1, keepdims=True))
        sure = np.where(letters, odds.max(axis=1) / odds.sum(axis=1), 0.0)
        return [self.names[b] if ok else UNDETERMINED for b, ok in zip(best, letters)], sure


def train(docs: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id") -> Model:
    """Fit on at most about ``rows`` labelled documents outside the held-out fifth.

    Rows with a null text or language teach nothing; without any, every text is undetermined.
    """
    labelled = docs.select(F.col(id_col).alias("doc_id"), "text", "lang").filter(
        in_training("doc_id") & F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    sample = bounded_sample(labelled, "doc_id", rows)

    def count(batches):
        seen: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for lang in set(langs):
                own = [t for t, g in zip(texts, langs) if g == lang]
                docs_of[lang] = docs_of.get(lang, 0) + len(own)
                into = seen.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for codes, owner in pieces(own):
                    for n in GRAMS:
                        if len(codes) >= n:
                            ids = gram_ids(codes, n)[owner[: len(codes) - n + 1] >= 0]
                            into += np.bincount(ids, minlength=BUCKETS)
        for lang, counts in seen.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": [lang] * (len(at) + 1),
                    "bucket": pa.array(np.r_[-1, at], pa.int32()),
                    "n": pa.array(np.r_[docs_of[lang], counts[at]], pa.int64()),
                }
            )

    counted = (
        sample.select("lang", "text")
        .mapInArrow(count, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names = sorted(set(counted.column("lang").to_pylist()))
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"{len(names)} languages; the matrix is planned for {MAX_LANGUAGES}")
    place = {name: i for i, name in enumerate(names)}
    counts, docs_per = np.zeros((len(names), BUCKETS)), np.zeros(len(names))
    row = np.array([place[x] for x in counted.column("lang").to_pylist()], int)
    bucket, n = counted.column("bucket").to_numpy(), counted.column("n").to_numpy()
    counts[row[bucket >= 0], bucket[bucket >= 0]] = n[bucket >= 0]
    docs_per[row[bucket < 0]] = n[bucket < 0]
    smooth = 0.5
    table = np.log((counts + smooth) / (counts.sum(axis=1, keepdims=True) + smooth * BUCKETS))
    prior = np.log(docs_per / docs_per.sum()) if names else docs_per
    return Model(names, table.astype(np.float32), prior)


def identify(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document.

    Null texts and texts without a letter are ``und`` with score 0.  A null ``doc_id`` counts as the
    empty string in the held-out rule.  Rows are never merged: repeated rows give repeated results;
    an empty table gives an empty result.  Other columns are not looked at.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, rows))

    def build():
        return model.value.score

    src = docs.select("doc_id", "text", (~in_training("doc_id")).alias("held_out"))
    return map_texts(src, ["doc_id", "held_out"], "lang_pred string, score double", build)


def keep_identified(docs: DataFrame, min_score: float = 0.5, rows: int = TRAIN_ROWS) -> DataFrame:
    """Documents whose language is known with at least ``min_score``; all columns stay."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, rows))

    def build():
        def work(texts):
            names, sure = model.value.score(texts)
            return [n != UNDETERMINED and s >= min_score for n, s in zip(names, sure)], None

        return work

    return rewrite(docs, build)
