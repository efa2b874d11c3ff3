"""Tokens of two tokenizers aligned by the bytes they cover.

Both sides of a batch of documents become frames of token starts.  ``pandas.merge_asof``, keyed by document,
finds for every token the token of the other side that covers its start; the union of both directions is
every overlapping pair.  Byte offsets where tokens of both sides end cut a document into groups.

How often an id pair is linked in the whole corpus is summed by Spark.  The most frequent pairs, at most
``HEAD_PAIRS``, are sent to the tasks; the rarer ones meet the documents in a keyed join.  Both ways give
the same sums, so the bound only decides what is shuffled.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tissueloom.llm.common import map_texts, release
from tissueloom.sources.storage import materialise

#: Most frequent id pairs that are sent to every task (17 bytes each).
HEAD_PAIRS = 1 << 20
#: Characters of distinct chunks that a worker remembers from task to task, and chunks encoded in one call
#: (longer ones than ``LONG`` characters alone).
MEMORY_CHARS, TOGETHER, LONG = 10_000_000, 256, 1_000
#: Characters aligned at once (a longer text alone), and links that are counted together inside a task.
ALIGNED_CHARS, COUNTED = 1_000_000, 2_000_000
SPACE = "▁"
#: A space that no token of either side crosses: both neighbours are no white space.
CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Numbers(dict):
    """Chunk to number; a new chunk gets the next one and is noted."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.fresh.append(chunk)
        return number


class Store:
    """Ids of numbered chunks: chunk ``k`` has ``size[k]`` ids from ``ids[begin[k]]`` on; ``sound``: they spell it."""

    def __init__(self):
        self.ids, self.begin, self.size, self.sound = np.empty(0, np.int32), np.empty(0, int), np.empty(0, int), np.empty(0, bool)

    def extend(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], chunks: int) -> None:
        """Add parts of (place among the new chunks, ids of all, size of each, sound)."""
        begin, size, sound = np.zeros(chunks, int), np.zeros(chunks, int), np.zeros(chunks, bool)
        base = len(self.ids)
        for where, ids, sizes, ok in parts:
            begin[where], size[where], sound[where] = base + np.cumsum(sizes) - sizes, sizes, ok
            base += len(ids)
        self.ids = np.concatenate([self.ids, *(p[1] for p in parts)])
        self.begin, self.size, self.sound = np.r_[self.begin, begin], np.r_[self.size, size], np.r_[self.sound, sound]

    def gather(self, chunks: np.ndarray, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks in order, and the document of each."""
        size = self.size[chunks]
        shift = np.repeat(self.begin[chunks] - np.cumsum(size) + size, size)
        return self.ids[np.arange(len(shift)) + shift], np.repeat(documents, size)


class Batch:
    """Tokens and links of a list of texts; arrays run over all texts in order.

    ``a, b``: ids; ``a_doc, b_doc``: the text of each; ``a_start, b_start``: byte offsets over all texts;
    ``a_group, b_group``: group numbers over all texts; ``link_a, link_b``: indices of overlapping tokens.
    """

    def __init__(self, a, a_doc, b, b_doc, a_size: np.ndarray, b_size: np.ndarray):
        self.a, self.a_doc, self.b, self.b_doc = a, a_doc, b, b_doc
        a_end, b_end = np.cumsum(a_size[a], dtype=np.int64), np.cumsum(b_size[b], dtype=np.int64)
        self.a_start, self.b_start = a_end - a_size[a], b_end - b_size[b]
        left = pd.DataFrame({"doc": a_doc, "at": self.a_start, "i": np.arange(len(a))})
        right = pd.DataFrame({"doc": b_doc, "at": self.b_start, "j": np.arange(len(b))})
        over_a = pd.merge_asof(left, right, on="at", by="doc")["j"].to_numpy(np.int64)  # the b token over each a start
        over_b = pd.merge_asof(right, left, on="at", by="doc")["i"].to_numpy(np.int64)
        new = self.a_start[over_b] != self.b_start  # equal starts are linked by the other direction already
        self.link_a = np.r_[np.arange(len(a)), over_b[new]]
        self.link_b = np.r_[over_a, np.flatnonzero(new)]
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        self.a_cut, self.b_cut = a_cut, b_cut = np.isin(a_end, ends), np.isin(b_end, ends)
        self.a_group, self.b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut


class Aligner:
    """Tokenizes and aligns texts.

    A text is cut at single spaces between characters that are no white space: the splitting pattern of side
    A starts a match there, and no piece of side B holds a space after another character.  Equal chunks are
    encoded once per worker.
    """

    def __init__(self, a_spec: str, b_model: bytes):
        self.tokenizer = Tokenizer.from_str(a_spec)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in letters for c in token)
            self.a_bytes[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.b_bytes, crossing = [], False
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            crossing |= SPACE in piece.lstrip(SPACE)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.cuttable = not crossing
        self.a_size, self.b_size = (np.array([len(x) for x in own], np.int64) for own in (self.a_bytes, self.b_bytes))
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.names = [f"{i}{mark}" for i in range(most) for mark in ",|;"]
        self.clear()

    def clear(self) -> None:
        self.numbers, self.a, self.b, self.odd, self.chars = Numbers(), Store(), Store(), np.empty(0, bool), 0

    def _each(self, where: np.ndarray, chunks: list[str], encode, table: list[bytes]) -> tuple:
        """Chunks encoded one by one, as a part of ``Store.extend``."""
        ids = [np.array(x, np.int32) for x in encode(chunks)]
        sound = [b"".join(map(table.__getitem__, x.tolist())) == (" " + c).encode() for x, c in zip(ids, chunks)]
        return where, np.concatenate(ids), np.array([len(x) for x in ids]), np.array(sound)

    def _together(self, where: np.ndarray, chunks: list[str], encode, table: list[bytes], sizes: np.ndarray):
        """Parts of ``Store.extend``: many chunks are one text, told apart by the bytes that their tokens cover."""
        for at in range(0, len(chunks), TOGETHER):
            own, places = chunks[at : at + TOGETHER], where[at : at + TOGETHER]
            text = " ".join(own)
            whole = np.array(encode([text])[0], np.int32)
            ends = np.cumsum(sizes[whole])
            bytes_of = np.fromiter(map(len, own), int) if text.isascii() else np.array([len(c.encode()) for c in own])
            want = np.cumsum(bytes_of + 1)
            upto = np.searchsorted(ends, want) + 1
            spelled = b"".join(map(table.__getitem__, whole.tolist())) == (" " + text).encode()
            if spelled and (ends[upto - 1] == want).all():
                yield places, whole, np.diff(upto, prepend=0), np.ones(len(own), bool)
            else:  # a side does not spell some chunk
                yield self._each(places, own, encode, table)

    def _learn(self) -> None:
        """Encode the chunks that were met for the first time."""
        fresh = self.numbers.fresh
        if not fresh:
            return
        self.numbers.fresh = []
        self.chars += sum(map(len, fresh))
        odd = np.array([not c or c[0].isspace() or c[-1].isspace() for c in fresh])
        self.odd = np.r_[self.odd, odd]
        alone = odd | (np.fromiter(map(len, fresh), int) > LONG) | (not self.cuttable)
        plain, single = np.flatnonzero(~alone), np.flatnonzero(alone)

        def encode_a(texts):
            return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

        def encode_b(texts):
            return self.pieces.encode(texts, num_threads=1)

        for store, encode, table, sizes in ((self.a, encode_a, self.a_bytes, self.a_size), (self.b, encode_b, self.b_bytes, self.b_size)):
            parts = list(self._together(plain, [fresh[k] for k in plain.tolist()], encode, table, sizes))
            if len(single):
                parts.append(self._each(single, [fresh[k] for k in single.tolist()], encode, table))
            store.extend(parts, len(fresh))

    def batch(self, texts: list[str | None]) -> Batch:
        """Tokens of all texts; null, empty and misspelled ones (see ``align``) have none."""
        if self.chars > MEMORY_CHARS:
            self.clear()
        number = self.numbers.__getitem__
        split = [t.split(" ") if self.cuttable else [t] for t in (t or "" for t in texts)]
        found = [list(map(number, chunks)) if texts[i] else [] for i, chunks in enumerate(split)]
        self._learn()
        again = [i for i, own in enumerate(found) if own and self.cuttable and self.odd[own].any()]
        for i in again:
            found[i] = list(map(number, CUT.split(texts[i])))
        self._learn()
        chunks = np.fromiter(chain.from_iterable(found), np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(own) for own in found])
        bad = np.bincount(owner, ~(self.a.sound & self.b.sound)[chunks], len(texts)) > 0
        chunks, owner = chunks[~bad[owner]], owner[~bad[owner]]
        return Batch(*self.a.gather(chunks, owner), *self.b.gather(chunks, owner), self.a_size, self.b_size)

    def spelled(self, found: Batch, n: int) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        mark = np.r_[np.where(found.a_cut, 1, 0), np.where(found.b_cut, 2, 0)]
        code = np.r_[found.a, found.b].astype(np.int64) * 3 + mark
        order = np.argsort(np.r_[2 * found.a_group, 2 * found.b_group + 1], kind="stable")
        parts = list(map(self.names.__getitem__, code[order].tolist()))
        each = np.bincount(found.a_doc, minlength=n) + np.bincount(found.b_doc, minlength=n)
        ends = np.cumsum(each).tolist()
        return ["".join(parts[start:end])[:-1] for start, end in zip([0, *ends], ends)]


@lru_cache(maxsize=1)
def aligner(a_spec: str, b_model: bytes) -> Aligner:
    """One per Python worker: chunks it has met serve the worker's next tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Aligner(a_spec, b_model)


def shared_aligner(docs: DataFrame, a_path: str, b_path: str):
    """A function for tasks that returns the worker's aligner; the vocabulary files are sent out once."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        shared = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))
    return lambda: aligner(*shared.value)


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list column: ``counts[i]`` of the values for row ``i``."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(values, pa.int32()))


def token_groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, start, end, a_ids, b_ids``: the groups of every document, byte offsets within space+text."""
    get = shared_aligner(docs, a_path, b_path)

    def build():
        own = get()

        def work(texts):
            found = own.batch(texts)
            n, groups = len(texts), int(found.a_cut.sum())
            of = found.a_doc[found.a_cut]
            base = np.full(n, 0)
            first = np.r_[True, found.a_doc[1:] != found.a_doc[:-1]] if len(found.a) else np.empty(0, bool)
            base[found.a_doc[first]] = found.a_start[first]
            end = (found.a_start + own.a_size[found.a])[found.a_cut]
            start = found.a_start[np.r_[True, found.a_cut[:-1]]] if groups else end
            a = lists(found.a, np.bincount(found.a_group, minlength=groups))
            b = lists(found.b, np.bincount(found.b_group, minlength=groups))
            rows = pa.StructArray.from_arrays(
                [pa.array(start - base[of], pa.int64()), pa.array(end - base[of], pa.int64()), a, b], ["start", "end", "a_ids", "b_ids"]
            )
            return [pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(of, minlength=n))], pa.int32()), rows)]

        return work

    ddl = "groups array<struct<start: bigint, end: bigint, a_ids: array<int>, b_ids: array<int>>>"
    return map_texts(docs, ["doc_id"], ddl, build, most_chars=ALIGNED_CHARS).select("doc_id", F.explode("groups").alias("g")).select("doc_id", "g.*")


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document the counts, the digest of its groups and its distinct linked id pairs with their number."""
    get = shared_aligner(docs, a_path, b_path)

    def build():
        own = get()
        wide = len(own.b_bytes)
        area = len(own.a_bytes) * wide

        def work(texts):
            n = len(texts)
            found = own.batch(texts)
            doc = found.a_doc[found.link_a]
            pairs, times = np.unique(doc * area + found.a[found.link_a].astype(np.int64) * wide + found.b[found.link_b], return_counts=True)
            each = np.bincount(pairs // area, minlength=n)
            a, b = np.divmod(pairs % area, wide)
            digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in own.spelled(found, n)]
            counts = (np.bincount(x, minlength=n) for x in (found.a_doc, found.b_doc, found.a_doc[found.a_cut], doc))
            return *counts, digests, lists(a, each), lists(b, each), lists(times, each)

        return work

    ddl = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, a array<int>, b array<int>, times array<int>"
    return map_texts(docs, ["doc_id"], ddl, build, most_chars=ALIGNED_CHARS)


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``a, b, count, best``: how many links of all documents hold a pair, and whether no pair of its ``b`` has more."""

    def add(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def sums():
            pairs, where = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            n = np.bincount(where, np.concatenate([t for _, t in held])).astype(np.int64)
            columns = [pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(n)]
            return pa.RecordBatch.from_arrays(columns, names=["a", "b", "n"])

        for batch in batches:
            held.append((_flat(batch, "a") << 32 | _flat(batch, "b"), _flat(batch, "times")))
            size += len(held[-1][0])
            if size >= COUNTED:
                yield sums()
                held, size = [], 0
        if size:
            yield sums()
        release()

    partial = rows.select("a", "b", "times").mapInArrow(add, "a int, b int, n bigint")
    counts = partial.groupBy("a", "b").agg(F.sum("n").alias("count"))
    counts = materialise(counts, "pairs")
    top = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(top, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def head_bound(counts: DataFrame, most: int) -> int:
    """The smallest power of two such that at most ``most`` pairs have that count or more."""
    sizes = counts.groupBy(F.floor(F.log2("count")).alias("k")).count().collect()  # at most 63 rows
    bound, held = 64, 0
    for k, n in sorted(((r.k, r["count"]) for r in sizes), reverse=True):
        if held + n > most:
            break
        bound, held = k, held + n
    return 1 << min(bound, 62)


def align(docs: DataFrame, a_path: str, b_path: str, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every document.

    Side A (a byte-level tokenizer file) encodes space+text, side B (a sentencepiece model) the text, to
    which it adds the space.  Texts that are null, empty, or that the tokens of a side do not spell byte for
    byte have no tokens: zeros and an empty digest, and nothing of them counts.  Repeated rows (also of one
    ``doc_id``, or of a null one) count and are returned one by one; an empty table gives no rows; other
    columns are not looked at.  Equal highest counts are all best.  Texts are never cut off; memory
    follows the longest text.
    """
    rows = materialise(aligned(docs, a_path, b_path).withColumn("_row", F.monotonically_increasing_id()), "aligned")
    counts = materialise(pair_counts(rows), "counts")
    bound = head_bound(counts, head_pairs)
    head = counts.filter(F.col("count") >= bound).toArrow()
    key = head.column("a").to_numpy().astype(np.int64) << 32 | head.column("b").to_numpy()
    order = np.argsort(key)
    shared = docs.sparkSession.sparkContext.broadcast(
        (key[order], head.column("count").to_numpy()[order], head.column("best").to_numpy(zero_copy_only=False).astype(bool)[order])
    )
    keep = ["_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    ddl = f"_row bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
    rest = "rest array<struct<a: int, b: int, times: int>>"

    def look_up(batches):
        keys, count, best = shared.value
        for batch in batches:
            n = batch.num_rows
            pairs, times = _flat(batch, "a") << 32 | _flat(batch, "b"), _flat(batch, "times")
            of = np.repeat(np.arange(n), batch.column("a").value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            own, at, t = of[known], at[known], times[known]
            sums, bests = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(sums, own, count[at] * t)
            np.add.at(bests, own, best[at] * t)
            other = np.flatnonzero(~known)
            parts = [pa.array((pairs[other] >> 32).astype(np.int32)), pa.array((pairs[other] & 0xFFFFFFFF).astype(np.int32))]
            structs = pa.StructArray.from_arrays([*parts, pa.array(times[other].astype(np.int32))], ["a", "b", "times"])
            cuts = pa.array(np.r_[0, np.cumsum(np.bincount(of[other], minlength=n))], pa.int32())
            columns = [*(batch.column(c) for c in keep), pa.array(sums), pa.array(bests), pa.ListArray.from_arrays(cuts, structs)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "head_sum", "head_best", "rest"])
        release()

    scored = rows.select(*keep, "a", "b", "times").mapInArrow(look_up, f"{ddl}, head_sum bigint, head_best bigint, {rest}")
    scored = materialise(scored, "scored")
    rare = scored.select("_row", F.explode("rest").alias("r")).select("_row", "r.*").join(counts, ["a", "b"])
    rare = rare.groupBy("_row").agg(
        F.sum(F.col("count") * F.col("times")).alias("rare_sum"),
        F.sum(F.col("best").cast("bigint") * F.col("times")).alias("rare_best"),
    )
    none = F.lit(0).cast("bigint")
    return scored.join(rare, "_row", "left").select(
        *keep[1:-1],
        (F.col("head_best") + F.coalesce("rare_best", none)).alias("n_best"),
        (F.col("head_sum") + F.coalesce("rare_sum", none)).alias("count_sum"),
        "groups_sha256",
    )
