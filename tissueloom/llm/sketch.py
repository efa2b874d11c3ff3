"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A sketch has ``COORDINATES`` cells.  In round ``i`` every shingle is thrown into one cell by the
round's hash and the cell keeps the smallest (round, value); cells filled in an earlier round are not
changed by later ones.  Rounds go on until every cell is filled; from round ``COORDINATES`` on, a round
throws all shingles into one fixed cell, so twice that many rounds always fill the sketch.

Bands of the sketch give buckets.  The members of a bucket meet with their full shingle sets in one task,
which finds all exact links among them and returns only the edges of a spanning forest: a group of
thousands of near copies never becomes pairs of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueloom.llm.common import map_texts, mix, release, slices
from tissueloom.sources.storage import materialise

#: Words in a shingle, cells of a sketch, cells in a band, members of a bucket that meet in one piece, and their shingles.
WORDS, COORDINATES, BAND, BLOCK, BLOCK_SHINGLES = 5, 160, 5, 2_000, 4_000_000
_P = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; with fewer words, of the whole sequence."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z only, white space of the contract
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.array([digest(w) for w in words], np.uint64)
    n = min(WORDS, len(h))
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = mix(out * _P + h[k : len(h) - n + 1 + k])
    return np.unique(mix(out, n))


def sketch(items: np.ndarray, cells: int = COORDINATES) -> np.ndarray:
    """The filled sketch of a non-empty set; equal cells are a vote for equal sets."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(cells, empty, np.uint64)
    for i in range(2 * cells):
        h = mix(items, i + 1)
        key = (np.uint64(i) << np.uint64(40)) | (h >> np.uint64(24))
        if i < cells:
            where = ((h & np.uint64(0xFFFFFF)) * np.uint64(cells) >> np.uint64(24)).astype(np.intp)
            np.minimum.at(out, where, key)
        elif out[i - cells] == empty:
            out[i - cells] = key.min()
        if out.max() != empty:
            break
    return out


def band_keys(cells: np.ndarray, size: int = BAND) -> np.ndarray:
    groups = cells.reshape(-1, size)
    key = np.arange(len(groups), dtype=np.uint64)
    for k in range(size):
        key = mix(key * _P + groups[:, k])
    return key


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_id, cells``: size and 128-bit hash of the set, 32 bits of each cell."""

    def build():
        def work(texts):
            sizes, ids, cells = [], [], []
            for text in texts:
                items = shingles(text)
                sizes.append(len(items))
                ids.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
                cells.append(mix(sketch(items)).astype(np.uint32).view(np.int32) if len(items) else None)
            return sizes, ids, cells

        return work

    return map_texts(docs, ["doc_id"], "n_shingles bigint, set_id binary, cells array<int>", build)


def _bands(reps: DataFrame) -> DataFrame:
    """``key, rep`` for every band of every representative."""

    def run(batches):
        for batch in batches:
            cells = np.stack(batch.column("cells").to_pylist()).astype(np.int32).view(np.uint32) if batch.num_rows else None
            if cells is None:
                continue
            keys = [band_keys(c.astype(np.uint64)) for c in cells]
            columns = [pa.array(np.concatenate(keys).view(np.int64))]
            columns += [pa.array(np.repeat(batch.column(c).to_numpy(), len(keys[0]))) for c in ("rep", "n_shingles")]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "rep", "n_shingles"])

    return reps.select("rep", "n_shingles", "cells").mapInArrow(run, "key bigint, rep bigint, n_shingles bigint")


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` (smallest node reachable) of an undirected graph ``a, b``; single nodes are absent.

    Labels are hung lower in rounds: every node takes the smallest label among its neighbours' and its
    own, then the label of that label.  Each round is written, so a lost executor costs one round.
    """
    both = materialise(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near")
        )
        low = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        step = materialise(
            low.join(jump, "low").select("node", "label", F.least("low", "far").alias("next")), "labels"
        )
        if not step.filter("label <> next").limit(1).count():
            return step.select("node", "label")
        labels = step.select("node", F.col("next").alias("label"))


def forest(items: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges that span the components of all exact links among the sets, as positions in ``items``.

    Intersections come from a 0/1 matrix of the elements that two or more sets hold, some columns at a time.
    """
    m = len(items)
    size = np.array([len(x) for x in items])
    if m == 2:
        shared = len(np.intersect1d(items[0], items[1], assume_unique=True))
        return [(0, 1)] if 100 * shared >= percent * (size.sum() - shared) else []
    value = np.concatenate(items)
    order = np.argsort(value, kind="stable")
    value, who = value[order], np.repeat(np.arange(m), size)[order]
    starts = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
    count = np.diff(np.r_[starts, len(value)])
    held = np.repeat(count > 1, count)
    column = np.repeat(np.cumsum(count > 1) - 1, count)[held]
    who, shared = who[held], np.zeros((m, m), np.float32)
    step = max(1, 8_000_000 // m)
    for low in range(0, int((count > 1).sum()), step):
        a, b = np.searchsorted(column, [low, low + step])
        part = np.zeros((m, min(step, int(column[-1]) + 1 - low)), np.float32)
        part[who[a:b], column[a:b] - low] = 1
        shared += part @ part.T
    linked = 100.0 * shared >= percent * (size[:, None] + size - shared.astype(np.float64))
    todo, edges = np.ones(m, bool), []
    while todo.any():
        front = np.flatnonzero(todo)[:1]
        todo[front] = False
        while len(front):
            near = linked[front] & todo
            new = np.flatnonzero(near.any(axis=0))
            edges += zip(front[near[:, new].argmax(axis=0)].tolist(), new.tolist())
            todo[new] = False
            front = new
    return edges


def bucket_links(docs: DataFrame, reps: DataFrame, bands: DataFrame, percent: int) -> DataFrame:
    """``a, b``: edges that span, bucket by bucket, all exact links of documents that share a bucket.

    Buckets with the same members are looked at once.  A bucket of more than ``BLOCK`` members, or more than
    ``BLOCK_SHINGLES`` shingles in all of its members, is cut into blocks that meet pairwise, each meeting a task's work of its own, so a bucket of any size is whole.
    """
    member = F.xxhash64("rep")
    keys = bands.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(member).alias("x"), F.bit_xor(F.xxhash64(member, F.lit(9))).alias("y"),
        F.sum("n_shingles").alias("all"),
    ).filter("n > 1")
    # no more blocks than members
    blocks = F.least(F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("all") / BLOCK_SHINGLES)), "n")
    keys = keys.groupBy("n", "x", "y").agg(F.min("key").alias("key"), F.first("all").alias("all")).select("key", blocks.alias("blocks"))
    members = materialise(bands.drop("n_shingles").join(keys, "key"), "members")
    wanted = materialise(
        members.select("rep").distinct().join(reps.select("rep", F.col("doc").alias("doc_id"), "set_id"), "rep"), "wanted"
    )
    # the same join at every size: the wanted documents are a share of all
    sets = materialise(_sets(docs.join(wanted.hint("merge"), "doc_id")), "sets")
    # block i of a bucket takes part in the meetings (i, j) and (j, i)
    own = F.pmod(F.xxhash64("rep", F.lit(5)), F.col("blocks"))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.least(j, own) * F.col("blocks") + F.greatest(j, own)
    )
    groups = members.select("rep", "key", F.explode(meets).alias("meeting"))
    rows = groups.join(sets, "rep").select("key", "meeting", "rep", "items")
    rows = rows.repartition("key", "meeting").sortWithinPartitions("key", "meeting", "rep")

    def run(batches):
        now, ids, items = None, [], []
        found: tuple[list, list] = ([], [])

        def close():
            for i, j in forest(items, percent) if len(items) > 1 else ():
                found[0].append(ids[i])
                found[1].append(ids[j])

        for batch in batches:
            data = batch.column("items")
            for k, group in enumerate(zip(batch.column("key").to_pylist(), batch.column("meeting").to_pylist())):
                if group != now:
                    close()
                    now, ids, items = group, [], []
                ids.append(batch.column("rep")[k].as_py())
                items.append(np.frombuffer(data[k].as_py(), np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["a", "b"])
            found = ([], [])
        close()
        release()
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["a", "b"])

    return materialise(rows.mapInArrow(run, "a bigint, b bigint").distinct(), "links")


def _sets(texts: DataFrame) -> DataFrame:
    """``rep, items``: the sorted shingle hashes of each wanted text."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                items = [shingles(t).tobytes() for t in part.column("text").to_pylist()]
                # rows that share a doc_id but not the text are not the wanted one
                same = [xxhash.xxh3_128_digest(x) == s for x, s in zip(items, part.column("set_id").to_pylist())]
                out = pa.RecordBatch.from_arrays([part.column("rep"), pa.array(items, pa.binary())], names=["rep", "items"])
                yield out.filter(pa.array(same, pa.bool_()))
        release()

    return texts.select("rep", "text", "set_id").mapInArrow(run, "rep bigint, items binary").dropDuplicates(["rep"])


def _relabel(base: DataFrame, links: DataFrame) -> DataFrame:
    """``rep, label`` for all of ``base``."""
    found = components(links)
    return base.select("rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "rep", F.coalesce("label", "rep").alias("label")
    )


def linked_components(docs: DataFrame, percent: int) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``: links at ``percent`` Jaccard.

    Documents without a shingle (null, empty, white space) are linked with nothing.  A row with a null
    ``doc_id`` is linked with nothing, has a null component and is kept.  Rows that share a ``doc_id`` are one
    document, whose texts belong together.  A component is named by its smallest document, so ties cannot
    occur.  Empty tables give empty results; other columns are not looked at.  Equal sets are one
    node from the start; copies are never paired.
    """
    docs = docs.select("doc_id", "text")
    signed = materialise(signatures(docs), "signatures")
    usable = signed.filter("n_shingles > 0 and doc_id is not null")
    # a set is known by its 128-bit hash; the number of its node is given when the table is written
    reps = usable.groupBy("set_id").agg(
        F.min_by(F.struct(F.col("doc_id").alias("doc"), "n_shingles", "cells"), "doc_id").alias("s")
    )
    reps = materialise(reps.select("set_id", "s.*", F.monotonically_increasing_id().alias("rep")), "reps")
    numbers = reps.select("set_id", "rep")
    bands = materialise(_bands(reps), "bands")
    links = bucket_links(docs, reps, bands, percent)
    # texts of one document belong together
    several = usable.groupBy("doc_id").agg(F.collect_set("set_id").alias("s")).filter("size(s) > 1")
    texts = several.select("doc_id", F.explode("s").alias("set_id")).join(numbers, "set_id")
    texts = texts.groupBy("doc_id").agg(F.collect_set("rep").alias("r"))
    links = links.unionByName(texts.select(F.array_min("r").alias("a"), F.explode("r").alias("b")).filter("a <> b"))
    state = materialise(_relabel(reps, links).join(reps.select("rep", "set_id", "doc"), "rep"), "state")
    named = state.select("set_id", "label").join(
        state.groupBy("label").agg(F.min("doc").alias("least")), "label"
    )
    found = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_id")).alias("set_id"))
    return found.join(named.select("set_id", "least"), "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_per_group(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that a kept one stands for; all columns stay."""
    gone = materialise(
        linked_components(docs, percent).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct(), "gone"
    )
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
