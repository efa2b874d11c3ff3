"""Byte-level BPE with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte ranges.  Every mergeable neighbour pair sits in the bucket of
its merge rank; three levels of 64-bit words record which buckets hold something, so find-first-set
gives the lowest rank in three steps whatever the length.  A merge kills one list node and files
the two new pairs; entries that no longer describe the list are skipped when they surface.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import regex
from pyspark.sql import DataFrame

from tissueloom.llm.common import map_texts

#: Encoded pre-tokens that a worker remembers from task to task; a pre-token longer than this many bytes is not kept.
MEMORY, LONGEST_KEPT = 1_500_000, 64


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes and their rank from the content of a rank file: one base64 pair a line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}


BIT = [1 << k for k in range(64)]


class Encoder:
    """Encodes pre-tokens by ranks and decodes ids.

    The queue's state is the bitmap (``low``: one bit per rank, ``mid``: one per word of ``low``, and
    a local ``top``: one per word of ``mid``) and the buckets, heaps of positions.  It is empty
    between pre-tokens.  Its steps stand inside ``merge``, as calls would cost more than they do.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.text_of = {r: str(r) for r in ranks.values()}
        most = max(ranks.values(), default=0)
        self.low, self.mid = [0] * ((most >> 6) + 1), [0] * ((most >> 12) + 1)
        self.buckets: dict[int, list[int]] = {}
        self.known: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token: always the lowest rank next, leftmost first."""
        found = self.ranks.get
        whole = found(piece)
        if whole is not None:
            return (whole,)
        low, mid, buckets, top, bit = self.low, self.mid, self.buckets, 0, BIT
        size = len(piece)
        # node i covers bytes i .. after[i]; pair[i] is the rank of the pair that starts there, or -1
        after, before, pair = list(range(1, size + 1)), list(range(-1, size)), [-1] * size
        for i in range(size - 1):
            rank = found(piece[i : i + 2])
            if rank is None:
                continue
            pair[i] = rank
            if rank in buckets:
                buckets[rank].append(i)  # ascending, so still a heap
                continue
            buckets[rank] = [i]
            a = rank >> 6
            if not low[a]:
                mid[a >> 6] |= bit[a & 63]
                top |= bit[a >> 6]
            low[a] |= bit[rank & 63]
        while top:
            b = (top & -top).bit_length() - 1
            word = mid[b]
            a = (b << 6) + (word & -word).bit_length() - 1
            word = low[a]
            rank = (a << 6) + (word & -word).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                low[a] = word = word & (word - 1)
                if not word:
                    mid[b] = word = mid[b] & (mid[b] - 1)
                    if not word:
                        top &= top - 1
            if pair[i] != rank:
                continue  # stale
            j = after[i]
            end = after[i] = after[j]
            pair[j] = -1
            if end < size:
                before[end] = i
            for k in (i, before[i]):
                if k < 0:
                    continue
                middle = after[k]
                rank = found(piece[k : after[middle]]) if middle < size else None
                if rank is None:
                    pair[k] = -1
                    continue
                pair[k] = rank
                if rank in buckets:
                    heappush(buckets[rank], k)
                    continue
                buckets[rank] = [k]
                a = rank >> 6
                if not low[a]:
                    mid[a >> 6] |= bit[a & 63]
                    top |= bit[a >> 6]
                low[a] |= bit[rank & 63]
        ids, i = [], 0
        while i < size:
            end = after[i]
            ids.append(found(piece[i:end]))
            i = end
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        words = self.split(text)
        found = list(map(self.known.get, words))
        if None in found:
            once: dict[str, tuple[int, ...]] = {}
            for k, ids in enumerate(found):
                if ids is None:
                    word = words[k]
                    if word not in once:
                        once[word] = self.merge(word.encode("utf-8"))
                    found[k] = once[word]
            if len(self.known) + len(once) > MEMORY:
                self.known.clear()
            self.known.update((w, ids) for w, ids in once.items() if len(w) <= LONGEST_KEPT)
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=1)
def encoder(raw: bytes, pattern: str) -> Encoder:
    """One per Python worker: pre-tokens it has met serve the worker's next tasks."""
    return Encoder(read_ranks(raw), pattern)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``, if wanted) for every document.

    The rank file is read on the driver and sent out once (its size is fixed by the vocabulary).
    A null text is the empty text: no ids, the hashes of nothing.  Repeated rows give repeated
    results, an empty table an empty result; other columns are not looked at.  Texts are never cut.
    """
    with open(ranks_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def build():
        coder = encoder(shared.value, pattern)
        names = coder.text_of.__getitem__

        def work(texts):
            out: tuple[list, ...] = ([], [], []) + (([],) if keep_ids else ())
            for text in texts:
                ids = coder.encode(text or "")
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(",".join(map(names, ids)).encode()).hexdigest())
                out[2].append(hashlib.sha256(coder.decode(ids)).hexdigest())
                if keep_ids:
                    out[3].append(ids)
            return out

        return work

    ddl = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")
    return map_texts(docs, ["doc_id"], ddl, build)
