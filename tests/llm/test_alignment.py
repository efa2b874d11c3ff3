"""Cross-tokenizer alignment against plain loops over tokens and bytes."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import sentencepiece
from tokenizers import Tokenizer

from tissueloom.llm import alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TOKENIZER = Tokenizer.from_file(A)
TOKENIZER.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B)


def spans(text):
    """(id, first byte, end) of both sides, or nothing where a side does not spell the text."""
    letters = alignment.byte_letters()
    raw = (" " + text).encode()
    sides = []
    ids = TOKENIZER.encode(" " + text, add_special_tokens=False).ids
    for tokens in (
        [(i, bytes(letters[c] for c in TOKENIZER.id_to_token(i))) for i in ids],
        [(i, bytes([int(PIECES.id_to_piece(i)[3:5], 16)]) if PIECES.is_byte(i) else PIECES.id_to_piece(i).replace("▁", " ").encode())
         for i in PIECES.encode(text)],
    ):
        at, own = 0, []
        for i, x in tokens:
            own.append((i, at, at + len(x)))
            at += len(x)
        if b"".join(x for _, x in tokens) != raw:
            return [], []
        sides.append(own)
    return sides


def brute(rows):
    """The result rows of (doc_id, text) rows."""
    docs, counts = [], Counter()
    for doc, text in rows:
        a, b = spans(text) if text else ([], [])
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        parts = [
            "|".join(",".join(str(i) for i, s, e in side if lo <= s and e <= hi) for side in (a, b)) for lo, hi in zip([0, *ends], ends)
        ]
        counts.update(links)
        docs.append((doc, a, b, links, parts))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    for doc, a, b, links, parts in docs:
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""
        best = sum(counts[p] == most[p[1]] for p in links)
        yield doc, len(a), len(b), len(parts), len(links), best, sum(counts[p] for p in links), digest


ODD = [
    "", None, " ", "  a  b ", "\nline\n\n two\t x \n", "a <|endoftext|> b <s> </s> <0x41>", "▁marked", "漢字😀 ü ﬁne Å", "x y   z\x1c q",
    "don't  stop", "w" * 3000, "the cat sat. " * 400, "a ́b", "1,000.50 $%& ''s", "� \x00 nul",
]


def expected(rows):
    return sorted(brute(rows), key=repr)


def got(df, **options):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in alignment.align(df, A, B, **options).select(*names).collect()), key=repr)


def test_equals_plain_loops_with_and_without_rare_pairs(spark):
    rng = np.random.default_rng(5)
    letters = list("ab \n\t'1é漢😀▁ .ﬁ")
    rows = list(enumerate(ODD)) + [(None, "same text"), (3, "same text"), (3, "same text")]
    rows += [(100 + i, "".join(rng.choice(letters, rng.integers(0, 40)))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS a", "2 AS times", "3 AS _row").repartition(3)
    want = expected(rows)
    assert got(df) == want
    assert got(df, head_pairs=3) == want and got(df, head_pairs=0) == want


def test_given_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    some = [r for r in rows if r[1] and len(r[1]) < 2500][:60]
    assert got(spark.createDataFrame(some, "doc_id bigint, text string")) == expected(some)


def test_edge_tables(edge, empty):
    assert alignment.align(empty, A, B).count() == 0
    result = alignment.align(edge, A, B).collect()
    assert len(result) == 10
    blank = [r for r in result if r.doc_id in (1, 2)]
    assert all(r.n_a == r.n_links == r.count_sum == 0 and r.groups_sha256 == "" for r in blank)
    assert len({r.groups_sha256 for r in result if r.doc_id == 4}) == 1


def test_groups_cover_the_bytes(edge):
    text = edge.filter("doc_id = 6").first().text
    rows = alignment.token_groups(edge.filter("doc_id in (6, 7)"), A, B).collect()
    own = sorted((r.start, r.end) for r in rows if r.doc_id == 6)
    assert own[0][0] == 0 and own[-1][1] == len(text.encode()) + 1
    assert all(a[1] == b[0] for a, b in zip(own, own[1:]))
    decoded = [bytes(alignment.byte_letters()[c] for i in r.a_ids for c in TOKENIZER.id_to_token(i)) for r in rows if r.doc_id == 6]
    assert sorted(decoded) == sorted((" " + text).encode()[s:e] for s, e in own)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(alignment, "MEMORY_CHARS", 20)
    own = alignment.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    for text in ("one two three four five six", "two two seven eight nine", "one more"):
        found = own.batch([text, None, text])
        a, b = spans(text)
        assert found.a.tolist() == [x[0] for x in a] * 2 and found.b.tolist() == [x[0] for x in b] * 2
