"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans.

The field segments *windows*: runs of tokens that hold a digit or an at sign.  A segment is one
other token or an entity of at most ``MAX_TOKENS`` tokens; features describe the whole span (its shape,
digits, checks), weights are per type, and types of neighbouring segments have a weight.  Training is
by stochastic gradient on the conditional likelihood (forward-backward), decoding by the same bounded
dynamic programme with maxima.  Training windows come from a bounded sample of documents; pattern matches are their
labels, and each is also shown in altered forms (a phone number without its country code stays one;
a card or address whose check fails is none), so that shape counts and not only the patterns.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left, bisect_right
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueloom.llm.common import bounded_sample, map_texts, rewrite, with_length

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
#: Tokens in an entity: a phone number's 15 digits in pairs, or a card number's 19 in groups of three.
MAX_TOKENS = 8
#: Feature buckets, documents and windows to train on, passes.
FEATURES, TRAIN_DOCS, TRAIN_WINDOWS, PASSES = 1 << 12, 4_000, 1_500, 4

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Starting only at the head of a digit run gives the same leftmost matches in linear time.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT_RUN, TOKEN, MARKED = re.compile(r"[0-9]+"), re.compile(r"\S+"), re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(DIGIT_RUN.findall(s))


def part_ok(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= 255


def emails(text: str):
    """Leftmost matches around each at sign, in linear time: the longest local part that is still free."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
        else:
            free = at + 1  # no later match can reach back over an at sign
        at = text.find("@", max(free, at + 1))


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """``(kind number, start, end)`` of the fixed patterns, by kind and start."""
    if not text or not MARKED.search(text):
        return []
    found = [(0, a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(map(part_ok, m[0].split("."))):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = only_digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(only_digits(m[0])) <= 15:
            found.append((3, *m.span()))
    return found


def windows(text: str | None) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring tokens (without closing punctuation) that hold a digit or an at sign."""
    if not text or not MARKED.search(text):
        return []
    out: list[list[tuple[int, int]]] = []
    last = None
    for k, m in enumerate(TOKEN.finditer(text)):
        if not MARKED.search(m[0]):
            continue
        end = m.start() + len(m[0].rstrip(".,;:!?\"'"))
        if last is not None and last == k - 1:
            out[-1].append((m.start(), end))
        else:
            out.append([(m.start(), end)])
        last = k
    return out


def features(span: str, tokens: int) -> list[int]:
    """Hashed whole-span features."""
    digits = only_digits(span)
    fine = DIGIT_RUN.sub(lambda m: str(min(len(m[0]), 9)), re.sub(r"[^\W\d_]+", "a", span))
    coarse = re.sub(r"[1-9]", "d", fine)
    parts = span.split(".")
    names = [
        "b",
        f"f{fine}",
        f"c{coarse}",
        f"n{len(digits)}",
        f"t{tokens}",
        f"@{min(span.count('@'), 2)}",
        f"l{luhn(digits) and len(digits)}",
        f"o{len(parts) == 4 and all(p.isdigit() and part_ok(p) for p in parts if p.isascii())}",
        f"+{span[:1] == '+'}{any(c in '()-' for c in span)}",
        f"x{bool(re.search(r'[^0-9@A-Za-z ().+_%-]', span))}",
    ]
    return [zlib.crc32(n.encode()) % FEATURES for n in names]


class SemiMarkov:
    """Weights ``type x feature`` and ``type before x type``; the other type has one-token segments only."""

    def __init__(self):
        self.weight = np.zeros((OTHER + 1, FEATURES))
        self.step = np.zeros((OTHER + 1, OTHER + 1))

    def lattice(self, spans: list[str]) -> list[list[tuple[list[int], np.ndarray]]]:
        """Per end position, for each segment length: its features and its score by type."""
        out = []
        for end in range(1, len(spans) + 1):
            row = []
            for n in range(1, min(MAX_TOKENS, end) + 1):
                ids = features(" ".join(spans[end - n : end]), n)
                score = self.weight[:, ids].sum(axis=1)
                if n > 1:
                    score[OTHER] = -np.inf
                row.append((ids, score))
            out.append(row)
        return out

    def learn(self, spans: list[str], gold: list[tuple[int, int, int]], rate: float) -> None:
        """One gradient step on the log-likelihood of ``gold``: ``(start, end, type)`` in tokens."""
        grid, n = self.lattice(spans), len(spans)
        first = np.zeros(OTHER + 1)
        ahead = np.full((n + 1, OTHER + 1), -np.inf)
        for end in range(1, n + 1):
            for k, (_, score) in enumerate(grid[end - 1], 1):
                before = first if end == k else _lse(ahead[end - k][:, None] + self.step)
                ahead[end] = np.logaddexp(ahead[end], before + score)
        after = np.full((n + 1, OTHER + 1), -np.inf)
        after[n] = 0
        for start in range(n - 1, 0, -1):
            for k in range(1, min(MAX_TOKENS, n - start) + 1):
                score = grid[start + k - 1][k - 1][1]
                after[start] = np.logaddexp(after[start], _lse((self.step + score + after[start + k]).T))
        total = _lse(ahead[n])
        truth = {(a, b): t for a, b, t in gold}
        step = np.zeros_like(self.step)
        for end in range(1, n + 1):
            for k, (ids, score) in enumerate(grid[end - 1], 1):
                if end == k:
                    share = np.exp(first + score + after[end] - total)
                else:
                    both = np.exp(ahead[end - k][:, None] + self.step + score + after[end] - total)
                    step -= both
                    share = both.sum(axis=0)
                share = -share
                if (t := truth.get((end - k, end))) is not None:
                    share[t] += 1
                np.add.at(self.weight, (slice(None), ids), rate * share[:, None])
        for (_, _, x), (_, _, y) in zip(gold, gold[1:]):
            step[x, y] += 1
        self.step += rate * step

    def decode(self, spans: list[str]) -> list[tuple[int, int, int]]:
        """Best segmentation: entities only, as ``(start, end, type)`` in tokens."""
        grid, n = self.lattice(spans), len(spans)
        best = np.full((n + 1, OTHER + 1), -np.inf)
        back: list[list[tuple[int, int]]] = [[(0, 0)] * (OTHER + 1) for _ in range(n + 1)]
        for end in range(1, n + 1):
            for k, (_, score) in enumerate(grid[end - 1], 1):
                if end == k:
                    before, came = np.zeros(OTHER + 1), np.zeros(OTHER + 1, int)
                else:
                    through = best[end - k][:, None] + self.step
                    before, came = through.max(axis=0), through.argmax(axis=0)
                for t in np.flatnonzero(before + score > best[end]):
                    best[end][t] = before[t] + score[t]
                    back[end][t] = (k, int(came[t]))
        out, end, t = [], n, int(best[n].argmax())
        while end:
            k, before = back[end][t]
            if t != OTHER:
                out.append((end - k, end, t))
            end, t = end - k, before
        return out[::-1]


def _lse(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=0)
    return top + np.log(np.exp(x - np.where(np.isfinite(top), top, 0)).sum(axis=0)) if np.isfinite(top).all() else np.logaddexp.reduce(x, axis=0)


def _labelled(text: str) -> list[tuple[list[str], list[tuple[int, int, int]]]]:
    """Windows of a text as token strings with the pattern matches as segments, and altered forms."""
    base = base_spans(text)
    out = []
    for window in windows(text):
        starts, ends = {a: i for i, (a, _) in enumerate(window)}, {b: i + 1 for i, (_, b) in enumerate(window)}
        tokens, taken, gold = [text[a:b] for a, b in window], set(), []
        for kind, a, b in base:
            if b <= window[0][0] or a >= window[-1][1]:
                continue
            if a not in starts or b not in ends or ends[b] - starts[a] > MAX_TOKENS or taken & set(range(starts[a], ends[b])):
                break  # not on token bounds, too long, or two kinds claim it
            taken |= set(range(starts[a], ends[b]))
            gold.append((starts[a], ends[b], kind))
        else:
            gold += [(i, i + 1, OTHER) for i in range(len(window)) if i not in taken]
            out.append((tokens, sorted(gold)))
            for a, b, kind in gold:
                own = tokens[a:b]
                if kind == KINDS.index("phone") and b - a > 2 and len(own[0]) <= 3:
                    out.append((own[1:], [(0, b - a - 1, kind)]))
                elif kind == KINDS.index("card"):
                    wrong = own[-1][:-1] + str((int(own[-1][-1]) + 1) % 10)
                    out.append(([*own[:-1], wrong], [(i, i + 1, OTHER) for i in range(b - a)]))
                elif kind == KINDS.index("ip") and b - a == 1:
                    out.append(([f"9{own[0]}"] if len(own[0].split(".")[0]) == 3 else [f"999{own[0]}"], [(0, 1, OTHER)]))
    return out


def train(docs: DataFrame) -> SemiMarkov:
    """Fit on windows of at most about ``TRAIN_DOCS`` documents that hold a digit or an at sign."""
    holding = docs.select("doc_id", "text").filter(F.col("text").rlike("[0-9@]"))
    sample = bounded_sample(holding, F.coalesce(F.col("doc_id"), F.lit(0)), TRAIN_DOCS)

    def build():
        def work(texts):
            return [[[f"{' '.join(w)}\t{' '.join(f'{a}.{b}.{t}' for a, b, t in g)}" for w, g in _labelled(x)] for x in texts]]

        return work

    found = map_texts(sample, [], "w array<string>", build).select(F.explode("w").alias("w"))
    # equal windows teach the same; the hash order makes the choice repeatable
    rows = found.distinct().orderBy(F.xxhash64("w"), "w").limit(TRAIN_WINDOWS).collect()
    model = SemiMarkov()
    for k in range(PASSES):
        for (row,) in rows:
            words, marks = row.split("\t")
            gold = [tuple(map(int, m.split("."))) for m in marks.split(" ")]
            model.learn(words.split(" "), gold, 0.3 / (1 + k))
    return model


def all_spans(text: str | None, model: SemiMarkov) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans: the field adds those that touch no base span."""
    base = base_spans(text)
    more = list(base)
    busy = sorted((a, b) for _, a, b in base)
    begins = [a for a, _ in busy]
    reach = list(accumulate((b for _, b in busy), max))  # the furthest end of the spans up to each
    for window in windows(text):
        if all((k := bisect_right(begins, s)) and reach[k - 1] >= e for s, e in window):
            continue  # nothing is left to find
        for i, j, kind in model.decode([text[a:b] for a, b in window]):
            a, b = window[i][0], window[j - 1][1]
            k = bisect_left(begins, b)
            if a < b and not (k and reach[k - 1] > a):
                more.append((kind, a, b))
    return base, sorted(more)


def _written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` for every document.

    Counts and hash are those of the fixed patterns; ``spans`` also has what the field adds (``n_added``).
    A null or empty text has none.  Overlaps of different kinds are all reported.  Repeated rows give
    repeated results, an empty table an empty one; other columns are not looked at.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs))

    def build():
        def work(texts):
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            for text in texts:
                base, every = all_spans(text, model.value)
                for kind in range(len(KINDS)):
                    out[kind].append(sum(k == kind for k, _, _ in base))
                out[4].append(hashlib.sha256(_written(base).encode()).hexdigest())
                out[5].append(_written(every))
                out[6].append(len(every) - len(base))
            return out

        return work

    ddl = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    return map_texts(docs, ["doc_id"], ddl, build)


def masked(text: str | None, spans) -> str | None:
    """The text with each span (overlapping ones as one, named by the first) replaced by its kind."""
    if not spans:
        return text
    out, done, edges = [], 0, sorted((a, b, k) for k, a, b in spans)
    for i, (a, b, k) in enumerate(edges):
        if a < done and i:
            if b > done:
                done = b
            continue
        out += [text[done:a], f"[{KINDS[k].upper()}]"]
        done = b
    return "".join([*out, text[done:]])


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans masked in ``text``; the other columns stay."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))

    def build():
        def work(texts):
            return None, [masked(t, all_spans(t, model.value)[1]) for t in texts]

        return work

    return with_length(rewrite(docs, build))
