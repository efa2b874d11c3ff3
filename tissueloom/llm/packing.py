"""Packing tokenized documents: Martello-Toth dominance reduction, then best fit.

Lengths are whole numbers up to the capacity, so the instance is a histogram of at most ``capacity``
rows, whatever the corpus.  The reduction and the best fit work on that histogram and give *patterns*
(which lengths share a sequence, how many sequences are alike).  Spark then numbers the pieces of
each length and looks their place up in the patterns; pieces never meet in one task.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right
from dataclasses import dataclass, field
from functools import lru_cache
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from tissueloom.llm.common import release, slices
from tissueloom.sources.storage import materialise

#: Tokens in a sequence, and the id that ends a document.
CAPACITY, END_ID = 2048, 0
#: Bytes of chunks and their ids that a worker remembers from task to task; a chunk longer than this many bytes is not
#: kept.
MEMORY, LONGEST_KEPT = 24_000_000, 64
#: Texts whose chunks are numbered together, and their characters, unless a single text has more.
ROWS_TOGETHER, CHARS_TOGETHER = 2_048, 2_000_000
#: Last character of the blocks whose letters are single code points that lower-casing and NFC treat alone.
LATIN_END = "\u024f"
#: Pieces of one (length, bucket) group that are numbered together.
GROUP_ROWS = 50_000


class Known:
    """Ids of chunks met before, as Arrow arrays without a Python object for each chunk.

    Once they take more than ``MEMORY`` bytes, chunks not met since the last time are forgotten, or all, if those met
    leave no room.
    """

    def __init__(self):
        self._hold(pa.array([], pa.string()), pa.array([], pa.list_(pa.uint32())))

    def _hold(self, chunks: pa.StringArray, ids: pa.ListArray) -> None:
        self.chunks, self.ids, self.met = chunks, ids, np.zeros(len(chunks), bool)

    def find(self, chunks: pa.StringArray) -> np.ndarray:
        """Place of each of these distinct chunks; -1 where it is unknown."""
        at = pc.fill_null(pc.index_in(self.chunks, value_set=chunks), -1).to_numpy()
        own = np.flatnonzero(at >= 0)
        place = np.full(len(chunks), -1, np.int32)
        place[at[own]] = own
        self.met[own] = True
        return place

    def learn(self, chunks: pa.StringArray, ids: pa.ListArray) -> None:
        """Takes chunks that are not known yet, and their ids."""
        short = pc.less_equal(pc.binary_length(chunks), LONGEST_KEPT)
        chunks, ids = chunks.filter(short), ids.filter(short)
        room = MEMORY - chunks.nbytes - ids.nbytes
        if room < 0:
            return
        if self.chunks.nbytes + self.ids.nbytes > room:
            met = pa.array(self.met)
            self._hold(self.chunks.filter(met), self.ids.filter(met))
            if self.chunks.nbytes + self.ids.nbytes > room:
                self.__init__()
        self.chunks, self.ids = pa.concat_arrays([self.chunks, chunks]), pa.concat_arrays([self.ids, ids])
        self.met = np.r_[self.met, np.ones(len(chunks), bool)]


class ChunkTokenizer:
    """Ids of whole texts, tokenized chunk by chunk between spaces and line ends.

    The tokenizer maps white space to a separator that no token crosses, so a text's ids are those
    of its chunks in order; equal chunks are tokenized once.  It also splits letters from other
    characters, so ``word,`` is ``word`` and ``,``.
    """

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        # words that are already as the normalizer would leave them need neither it nor the splitting
        self.plain = Tokenizer.from_str(spec)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.known = Known()
        self._marks: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _ids(self, texts: list[str], tokenizer: Tokenizer | None = None) -> list[bytes]:
        encoded = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _words(self, words: list[str], tokenizer: Tokenizer) -> dict[str, bytes]:
        """Ids of words of letters: many in one text, told apart by the ids that end a word."""
        out = {}
        for at in range(0, len(words), 2000):
            own = words[at : at + 2000]
            ids = np.frombuffer(self._ids([" ".join(own)], tokenizer)[0], "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(own):
                raw, cuts = ids.tobytes(), [0, *(ends * 4).tolist()]
                out.update((w, raw[a:b]) for w, a, b in zip(own, cuts, cuts[1:]))
            else:  # a word that is more than one after normalization
                out.update(zip(own, self._ids(own)))
        return out

    def _fresh(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks that are not known yet, in their order, then of words in them that are not known either."""
        marks = ".,!?;:"
        parts, others, plain, cased = [], [], set(), set()
        for c in chunks:
            word, tail = (c[:-1], c[-1]) if c and c[-1] in marks else (c, "")
            if not word.isalpha():
                others.append(c)
            elif word.isascii() or (max(word) <= LATIN_END and word.lower().isalpha()):
                parts.append((c, word := word.lower(), tail))
                plain.add(word)
            elif normalize("NFC", word).lower().isalpha():  # still letters as the tokenizer sees it
                parts.append((c, word, tail))
                cased.add(word)
            else:
                others.append(c)
        remembered = self._remembered([*plain, *(cased - plain)])
        ids = dict(remembered)
        ids |= self._words([w for w in plain if w not in ids], self.plain)
        ids |= self._words([w for w in cased if w not in ids], self.tokenizer)
        tails = self._marks
        if not tails:
            tails.update(zip(["", *marks], [b"", *self._ids(list(marks))]))
        out = dict.fromkeys(chunks)
        out.update(zip(others, self._ids(others)) if others else ())
        for c, word, tail in parts:
            out[c] = ids[word] + tails[tail]
        return out | {w: own for w, own in ids.items() if w not in remembered}

    def _remembered(self, words: list[str]) -> dict[str, bytes]:
        place = self.known.find(pa.array(words, pa.string()))
        own = np.flatnonzero(place >= 0)
        ids = self.known.ids.take(pa.array(place[own]))
        raw, cuts = ids.values.to_numpy().tobytes(), (ids.offsets.to_numpy() * 4).tolist()
        return {words[i]: raw[a:b] for i, a, b in zip(own.tolist(), cuts, cuts[1:])}

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's ids end.

        Arrow splits the texts, numbers the distinct chunks and finds those known; Python looks at each other one once.
        """
        parts = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        chunks, offsets = parts.flatten().dictionary_encode(), parts.offsets.to_numpy()
        del parts
        code, chunks = chunks.indices, chunks.dictionary
        place, ids = self.known.find(chunks), self.known.ids
        new = np.flatnonzero(place < 0)
        if len(new):
            once = self._fresh(chunks.take(pa.array(new)).to_pylist())
            place[new] = np.arange(len(ids), len(ids) + len(new))
            cuts = np.r_[0, np.cumsum(np.fromiter(map(len, once.values()), np.int64, len(once)) // 4)]
            found = np.frombuffer(b"".join(once.values()), "<u4")
            found = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(found))
            ids = pa.concat_arrays([ids, found])
            self.known.learn(pa.array(list(once), pa.string()), found)
        ids = ids.take(pa.array(place).take(code))  # of each chunk in the texts
        return ids.values.to_numpy(), ids.offsets.to_numpy()[offsets[1:] - offsets[0]].astype(np.int64)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        ids, ends = self.encode_batch(pa.array(texts, pa.string()))
        return [own.tobytes() for own in np.split(ids, ends[:-1])] if len(ends) else []


@lru_cache(maxsize=1)
def chunk_tokenizer(spec: str) -> ChunkTokenizer:
    """One per Python worker: what it has learnt serves the worker's next tasks."""
    release()
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return ChunkTokenizer(spec)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``): documents cut at the capacity only.

    Every document is its ids and the end id, so an empty or null text is one piece of length 1.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        chunks = chunk_tokenizer(shared.value)
        for batch in batches:
            for part in slices(batch, "text", CHARS_TOGETHER, ROWS_TOGETHER):
                ids, ends = chunks.encode_batch(part.column(1))
                ids = np.insert(ids, ends, END_ID)  # every document's end id
                ends = ends + np.arange(1, len(ends) + 1)
                begin = np.r_[0, ends[:-1]]
                pieces = -(-(ends - begin) // capacity)
                of = np.repeat(np.arange(len(ends)), pieces)
                number = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = number * capacity
                length = np.minimum(ends[of] - begin[of] - start, capacity)
                at, raw = (begin[of] + start) * 4, memoryview(ids.astype("<u4", copy=False)).cast("B")
                crc = [zlib.crc32(raw[i:j]) for i, j in zip(at.tolist(), (at + length * 4).tolist())]
                columns = [part.column(0).take(pa.array(of)), pa.array(number, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:  # pieces stand end to end
                    cuts = pa.array(np.r_[0, np.cumsum(length)], pa.int32())
                    columns.append(pa.ListArray.from_arrays(cuts, pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                release()

    ddl = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, ddl)


@dataclass
class Patterns:
    """``n`` alike sequences at a time: ``lengths`` lists (length, how often) in placing order."""

    capacity: int
    rows: list[tuple[int, list[tuple[int, int]]]] = field(default_factory=list)

    @property
    def sequences(self) -> int:
        return sum(n for n, _ in self.rows)

    def add(self, n: int, *lengths: int) -> None:
        counted: dict[int, int] = {}
        for x in lengths:
            counted[x] = counted.get(x, 0) + 1
        self.rows.append((n, list(counted.items())))


def largest_at_most(left: list[int], counts: dict[int, int], room: int, but: dict[int, int]) -> int:
    """Largest length that fits ``room`` and is still there once ``but`` is taken; 0 if none."""
    i = bisect_right(left, room) - 1
    while i >= 0 and counts[left[i]] <= but.get(left[i], 0):
        i -= 1
    return left[i] if i >= 0 else 0


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> Patterns:
    """Fix sets that dominate every alternative for their largest length; ``counts`` loses them.

    For a length ``w`` with ``room = capacity - w``:

    * nothing fits beside it: ``{w}``;
    * a partner fills the room exactly: ``{w, partner}``;
    * no two lengths fit together: ``{w, largest that fits}``;
    * at most two fit together and the largest single one is at least as long as the longest pair
      that fits: ``{w, largest}``.

    Each rule fixes as many alike sequences as the counts allow.  Passes repeat until one of them
    fixes nothing, as every removal can make further rules apply.
    """
    found = Patterns(capacity)
    changed = True
    while changed:
        changed = False
        for w in sorted(counts, reverse=True):
            while counts.get(w, 0) > 0:
                left = sorted(x for x, n in counts.items() if n > 0)
                room = capacity - w
                best = largest_at_most(left, counts, room, {w: 1})
                if not best:
                    found.add(n := counts[w], w)
                    counts[w] -= n
                    changed = True
                    continue
                if best != room and not _single_dominates(left, counts, w, room, best):
                    break
                # alike sequences as long as the rule certainly holds: exact fits at once, others
                # until the partner is used up (removals only shrink what could compete)
                n = counts[w] // 2 if best == w else min(counts[w], counts[best])
                found.add(n, w, best)
                counts[w] -= n
                counts[best] -= n
                changed = True
    for x in [x for x, n in counts.items() if n <= 0]:
        del counts[x]
    return found


def _single_dominates(left: list[int], counts: dict[int, int], w: int, room: int, best: int) -> bool:
    """Whether ``{w, best}`` dominates all feasible sets that hold ``w``."""
    small: list[int] = []  # the three smallest lengths that could stand beside w
    for x in left:
        small += [x] * min(counts[x] - (x == w), 3 - len(small))
        if len(small) == 3:
            break
    if len(small) < 2 or small[0] + small[1] > room:
        return True
    if len(small) == 3 and sum(small) <= room:
        return False
    longest, hi = 0, len(left) - 1
    have = lambda x: counts[x] - (x == w)
    lo = 0
    while lo <= hi:  # longest pair that fits, from both ends
        a, b = left[lo], left[hi]
        if have(a) < 1 or (lo < hi and have(b) < 1):
            lo, hi = (lo + 1, hi) if have(a) < 1 else (lo, hi - 1)
        elif a + b > room:
            hi -= 1
        else:
            if lo < hi or have(a) > 1:
                longest = max(longest, a + b)
            lo += 1
    return best >= longest


def best_fit(counts: dict[int, int], capacity: int, found: Patterns) -> None:
    """Best fit, longest first: each length goes to the fullest kind of open sequence that takes it.

    Open sequences of the same filling and content are one entry with a count.
    """
    open_kinds: dict[int, list[tuple[int, tuple[int, ...]]]] = {}  # room -> (how many, lengths)
    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n > 0:
            room = min((r for r in open_kinds if r >= w), default=None)
            if room is None:
                each = capacity // w
                if n >= each:
                    kind, take = (w,) * each, n // each
                    n -= take * each
                else:
                    kind, take, n = (w,) * n, 1, 0
                open_kinds.setdefault(capacity - w * len(kind), []).append((take, kind))
                continue
            many, kind = open_kinds[room].pop()
            if not open_kinds[room]:
                del open_kinds[room]
            each = room // w  # the fullest sequence stays the fullest while it takes more of w
            if n >= each:
                take = min(many, n // each)
                n -= take * each
            else:
                take, each, n = 1, n, 0
            if many > take:
                open_kinds.setdefault(room, []).append((many - take, kind))
            open_kinds.setdefault(room - each * w, []).append((take, kind + (w,) * each))
    for kinds in open_kinds.values():
        for many, kind in kinds:
            found.add(many, *kind)


def plan(counts: dict[int, int], capacity: int) -> Patterns:
    """Patterns for a histogram of lengths; every length must be between 1 and the capacity."""
    left = {w: n for w, n in counts.items() if n > 0}
    found = reduce_by_dominance(left, capacity)
    best_fit(left, capacity, found)
    return found


def places(found: Patterns) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first number of each run, pieces per sequence, first sequence, first offset."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for n, lengths in found.rows:
        offset = 0
        for w, each in lengths:
            out.setdefault(w, []).append((used.get(w, 0), each, sequence, offset))
            used[w] = used.get(w, 0) + n * each
            offset += w * each
        sequence += n
    return {w: tuple(np.array(c, np.int64) for c in zip(*runs)) for w, runs in out.items()}


def number_within(pieces: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Adds ``_number`` from 0 within each value of ``key``; no group meets in one task.

    Rows are dealt into buckets by a hash; a window numbers one (value, bucket) group, whose size is
    bounded on average, and the bucket's start is a running sum over counts.
    """
    buckets = pieces.count() // GROUP_ROWS + 1
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(key, "_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(key, "_bucket", "_start")
    )
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    return (
        dealt.join(starts, [key, "_bucket"])
        .withColumn("_number", F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_bucket", "_start")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length``) plus ``sequence_id, offset``; sequences are gapless from 0."""
    pieces = materialise(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shared = pieces.sparkSession.sparkContext.broadcast(places(plan(histogram, capacity)))
    names = pieces.columns
    order = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in names]

    def put(batches):
        at = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            number = batch.column("_number").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for w in np.unique(length):
                own = np.flatnonzero(length == w)
                first, each, seq, off = at[int(w)]
                run = np.searchsorted(first, number[own], side="right") - 1
                more = number[own] - first[run]
                sequence[own] = seq[run] + more // each[run]
                offset[own] = off[run] + more % each[run] * w
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return number_within(pieces, "length", order).mapInArrow(put, f"{ddl}, sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every document.

    Null and empty texts are a single end id.  Repeated rows are packed as often as they occur; ties
    between equal pieces are broken by ``doc_id``.  An empty table gives no pieces.  Other columns
    are not looked at.  A null ``doc_id`` stays null.
    """
    return pack(token_pieces(docs, tokenizer_path, capacity, keep_ids), capacity)
