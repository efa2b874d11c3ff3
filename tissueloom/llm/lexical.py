"""Ranked lexical search over impact vectors with norm buckets (LEMP).

A document is the vector of its integer impacts on the query terms, a query a vector of ones, so a score is
their inner product.  Documents are ordered by vector length and searched bucket by bucket, longest first.
A bucket whose longest vector cannot reach the query's threshold (Cauchy-Schwarz) is skipped.  Inside, only
the coordinates whose bucket maxima are needed to reach the threshold are read; a document they touch must
still be able to reach it by the length of its unread part.  Survivors are scored exactly in integers.

Every partition searches its own run of the order with its own running best; the longest vectors go first
and their best scores are the thresholds of all others.  Thresholds only skip what cannot be among the best.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueloom.llm.common import map_texts, release
from tissueloom.sources.storage import materialise

#: Items that are searched for together, documents in a bucket and in a partition, and the number of longest
#: documents that give the first thresholds.
ITEMS, BUCKET_ROWS, PARTITION_ROWS, FIRST_ROWS = 4_000, 4_096, 16_384, 16_384
#: Floating-point bounds are raised by this share, so rounding never rules a document out.
SLACK = 1 + 1e-9
NO_ID = (1 << 63) - 1

_KEEP = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all other characters from U+0080 on; A-Z are lower-cased."""
    return (text or "").encode().translate(_KEEP).split()


def weights(total: int, holding: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((2N + 2) / (2 df + 1)))`` for each term, as contracted in doubles."""
    return np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) for df in holding.tolist()], np.int64)


def item_blocks(items: DataFrame, id_col: str, text_col: str, size: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The items in blocks of at most ``size`` with their distinct terms."""
    block: list[tuple[int | None, list[bytes]]] = []
    for row in items.select(F.col(id_col).cast("bigint"), text_col).toLocalIterator():
        block.append((row[0], sorted(set(terms_of(row[1])))))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def tallies(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id, n, terms, tf``: length in terms and the counted vocabulary terms of every document that has a term."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def build():
        place = shared.value.get

        def work(texts):
            lengths, ids, tfs, sizes = [], [], [], [0]
            for text in texts:
                words = terms_of(text)
                lengths.append(len(words))
                own = np.array([i for i in map(place, words) if i is not None], np.int32)
                own, n = np.unique(own, return_counts=True)
                ids.append(own)
                tfs.append(n)
                sizes.append(len(own))
            cuts = pa.array(np.cumsum(sizes), pa.int32())
            flat = lambda parts, kind: pa.array(np.concatenate(parts).astype(kind) if parts else np.empty(0, kind))
            return lengths, pa.ListArray.from_arrays(cuts, flat(ids, np.int32)), pa.ListArray.from_arrays(cuts, flat(tfs, np.int64))

        return work

    keyed = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"), "text")
    return map_texts(keyed, ["doc_id"], "n bigint, terms array<int>, tf array<bigint>", build).filter("n > 0")


def impact_vectors(counted: DataFrame, total: int, length: int, weight: np.ndarray) -> DataFrame:
    """``doc_id, norm, terms, impact``: vectors with something in them, and their Euclidean length."""
    shared = counted.sparkSession.sparkContext.broadcast(weight)

    def run(batches):
        w = shared.value
        for batch in batches:
            n = batch.column("n").to_numpy()
            lists = batch.column("terms")
            sizes = lists.value_lengths().to_numpy()
            terms, tf = lists.flatten().to_numpy(), batch.column("tf").flatten().to_numpy()
            of = np.repeat(np.arange(len(n)), sizes)
            m = 100 - 50 + (50 * n * total) // length
            impact = w[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[of]))
            norm = np.sqrt(np.bincount(of, impact.astype(float) ** 2, len(n)))
            cuts = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
            columns = [batch.column("doc_id"), pa.array(norm), pa.ListArray.from_arrays(cuts, pa.array(terms, pa.int32()))]
            columns.append(pa.ListArray.from_arrays(cuts, pa.array(impact, pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "norm", "terms", "impact"]).filter(pa.array(norm > 0))
        release()

    return counted.mapInArrow(run, "doc_id bigint, norm double, terms array<int>, impact array<bigint>")


class Bucket:
    """Vectors of similar length, with the postings of each coordinate."""

    def __init__(self, ids: np.ndarray, norm: np.ndarray, sizes: np.ndarray, terms: np.ndarray, impact: np.ndarray):
        self.ids, self.norm, self.longest = ids, norm, float(norm.max(initial=0))
        self.begin, self.terms, self.impact = np.r_[0, np.cumsum(sizes)], terms, impact
        order = np.argsort(terms, kind="stable")
        self.rows, self.values = np.repeat(np.arange(len(ids)), sizes)[order], impact[order]
        self.present, first = np.unique(terms[order], return_index=True)
        self.first = np.r_[first, len(terms)]
        self.most = np.maximum.reduceat(self.values, first) if len(first) else np.empty(0, np.int64)

    def search(self, query: np.ndarray, member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Rows and exact scores of all documents that score at least ``least`` (more than 0).

        ``query``: ascending coordinates, ``member``: the same as a mask; ``None`` if the bucket is skipped.
        """
        if math.sqrt(len(query)) * self.longest * SLACK < least:
            return None
        at = np.searchsorted(self.present, query)
        at = at[at < len(self.present)]
        at = at[member[self.present[at]]]
        at = np.unique(at)
        at = at[np.argsort(-self.most[at], kind="stable")]
        bound = np.r_[np.cumsum(self.most[at][::-1])[::-1], 0]  # what the coordinates from here on can add
        read = int((bound >= max(least, 1)).sum())  # without the first ``read`` ones nothing reaches the threshold
        if not read:
            return None
        spans = [slice(self.first[k], self.first[k + 1]) for k in at[:read]]
        rows = np.concatenate([self.rows[s] for s in spans])
        values = np.concatenate([self.values[s] for s in spans]).astype(float)
        partial = np.bincount(rows, values, len(self.ids))
        touched = np.flatnonzero(partial)
        if read < len(at):
            unread = np.sqrt(np.maximum(self.norm[touched] ** 2 * SLACK - np.bincount(rows, values**2, len(self.ids))[touched], 0))
            reach = partial[touched] + np.minimum(unread * math.sqrt(len(at) - read) * SLACK, bound[read])
            touched = touched[reach * SLACK >= least]
        if not len(touched):
            return touched, touched
        sizes = self.begin[touched + 1] - self.begin[touched]
        own = np.arange(sizes.sum()) + np.repeat(self.begin[touched] - np.cumsum(sizes) + sizes, sizes)
        score = np.add.reduceat(self.impact[own] * member[self.terms[own]], np.cumsum(sizes) - sizes)
        good = score >= max(least, 1)
        return touched[good], score[good]


def search_runs(vectors: DataFrame, queries: list[np.ndarray], width: int, least: np.ndarray, k: int) -> DataFrame:
    """``item, doc_id, score``: the ``k`` best of each partition for each query, none below ``least``.

    Partitions hold runs of descending length and are read in buckets of ``BUCKET_ROWS``.
    """
    shared = vectors.sparkSession.sparkContext.broadcast((queries, least))

    def run(batches):
        asked, limits = shared.value
        limits = limits.copy()
        member = np.zeros(width, bool)
        best: list = [None] * len(asked)
        for bucket in buckets(batches):
            for q, query in enumerate(asked):
                member[query] = True
                found = bucket.search(query, member, int(limits[q]))
                member[query] = False
                if found is None or not len(found[0]):
                    continue
                ids, scores = bucket.ids[found[0]], found[1]
                if best[q] is not None:
                    ids, scores = np.r_[best[q][0], ids], np.r_[best[q][1], scores]
                order = np.lexsort((ids, -scores))[:k]
                best[q] = ids[order], scores[order]
                if len(order) == k:
                    limits[q] = max(limits[q], scores[order[-1]])
        rows = [(q, *own) for q, own in enumerate(best) if own is not None]
        if rows:
            item = np.repeat([r[0] for r in rows], [len(r[1]) for r in rows])
            columns = [pa.array(item, pa.int32()), *(pa.array(np.concatenate([r[j] for r in rows]), pa.int64()) for j in (1, 2))]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])
        release()

    return vectors.mapInArrow(run, "item int, doc_id bigint, score bigint")


def buckets(batches) -> Iterator[Bucket]:
    """Buckets from batches of ``doc_id, norm, terms, impact``; a document is never divided."""
    held: list[pa.RecordBatch] = []

    def joined():
        columns = [np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("doc_id", "norm")]
        sizes = np.concatenate([b.column("terms").value_lengths().to_numpy() for b in held])
        flat = [np.concatenate([b.column(c).flatten().to_numpy() for b in held]) for c in ("terms", "impact")]
        return Bucket(*columns, sizes, *flat)

    count = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, BUCKET_ROWS - count)
            batch = batch.slice(part.num_rows)
            held.append(part)
            count += part.num_rows
            if count == BUCKET_ROWS:
                yield joined()
                held, count = [], 0
    if count:
        yield joined()


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of each item by descending score, then ascending ``doc_id``."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def first_cut(vectors: DataFrame, rows: int) -> float:
    """A length that about ``rows`` of the vectors reach, from a histogram in steps of about 2 %."""
    step = F.floor(F.log2("norm") * 32)
    sizes = vectors.groupBy(step.alias("k")).count().collect()  # lengths below 2^63 * 2^32: at most some 3,000 rows
    held, cut = 0, math.inf
    for key, n in sorted(((r.k, r["count"]) for r in sizes), reverse=True):
        if held >= rows:
            break
        held, cut = held + n, 2.0 ** (key / 32)
    return cut * (1 - 1e-9)


def rank_block(docs: DataFrame, block: list[tuple[int | None, list[bytes]]], k: int) -> DataFrame:
    """``item_id, rank, doc_id, score`` for one block of items."""
    spark = docs.sparkSession
    vocabulary = sorted({t for _, terms in block for t in terms})
    place = {t: i for i, t in enumerate(vocabulary)}
    queries = [np.array([place[t] for t in terms], np.int64) for _, terms in block]
    counted = materialise(tallies(docs, vocabulary), "tallies")
    total, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(vocabulary), np.int64)
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most the block's terms
        holding[r.t] = r["count"]
    vectors = impact_vectors(counted, total, max(length, 1), weights(total, holding))
    parts = total // PARTITION_ROWS + 1
    # the row number parts vectors of equal length, such as thousands of copies, among partitions
    vectors = vectors.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(parts, F.desc("norm"), "_row")
    vectors = materialise(vectors.sortWithinPartitions(F.desc("norm"), "_row").drop("_row"), "impacts")
    cut = first_cut(vectors, FIRST_ROWS)
    none = np.zeros(len(block), np.int64)
    longest = materialise(best_of(search_runs(vectors.filter(F.col("norm") >= cut), queries, len(vocabulary), none, k), k), "longest")
    for r in longest.filter(F.col("rank") == k).select("item", "score").collect():  # one row an item
        none[r["item"]] = r["score"]
    others = search_runs(vectors.filter(F.col("norm") < cut), queries, len(vocabulary), none, k)
    ranked = best_of(longest.drop("rank").unionByName(others), k)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], "item int, item_id bigint")
    return ranked.join(names, "item").select("item_id", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score")


def rank(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0.

    Terms, weights and scores are those of the module's contract; all statistics run over all documents.  Null
    texts, and texts without a term, have no terms: such documents count nowhere, such items get no rows.
    Equal scores go by ascending ``doc_id``, a null one last.  Repeated documents rank one by one; repeated
    items (also of one id, or of a null one) are answered one by one.  Empty tables give no rows.  Other
    columns are not looked at.  Items beyond ``ITEMS`` are searched for in further blocks.
    """
    blocks = [rank_block(docs, block, k) for block in item_blocks(items, id_col, text_col, ITEMS)]
    if not blocks:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, blocks)
