"""Quality rules: a threshold table compiled into one projection of text ratios (DataFrame operations only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tissueloom.llm.common import SPACES

WORD_BREAK = "[ \t-\r]+"
#: Words in a window, words that a text needs, percent of words in repeated windows that it may have.
WINDOW, MIN_WORDS, MAX_REPEAT = 5, 10, 20

# Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": ["the", "be", "to", "of", "and", "that", "have", "with", "is", "in", "for", "are", "was", "on", "as"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "est", "pour", "que", "dans", "qui"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "ein"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "una"],
}

#: Rule, measure, smallest and largest value allowed (None: open).
RULES: list[tuple[str, str, float | None, float | None]] = [
    ("word_length", "mean_word_chars", 1.5, 20.0),
    ("symbols", "symbols_per_word", None, 0.3),
    ("stop_words", "stop_word_share", 0.02, None),
    ("repeated_lines", "dup_line_share", None, 0.5),
    ("bullet_lines", "bullet_line_share", None, 0.9),
    ("cut_lines", "cut_line_share", None, 0.3),
]
#: Lines that begin with a bullet, and lines that break off.
BULLET, CUT = "^[ \t-\r]*[-*•]", "(\\.\\.\\.|…)[ \t-\r]*$"


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and what the rules need.

    Windows are compared by a 64-bit hash first: different hashes prove that no window repeats.  Only
    texts with equal hashes are compared word by word, so the count is exact.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    staged = docs.withColumn("_words", F.filter(F.split(body, WORD_BREAK), lambda w: w != "")).withColumn(
        "_lines", F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    )
    staged = staged.withColumns(
        {"_n": F.size("_words"), "_hash": F.transform("_words", lambda w: F.xxhash64(w))}
    )
    last = F.col("_n") - WINDOW
    window_hash = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get("_hash", i + k) for k in range(WINDOW)])
    )
    empty = F.array().cast("array<bigint>")
    staged = staged.withColumn("_windows", F.when(last >= 0, window_hash).otherwise(empty))
    suspect = F.size("_windows") > F.size(F.array_distinct("_windows"))
    # (window, start) in order of the window: a window repeats if a neighbour is equal
    window = lambda i: F.array_join(F.slice("_words", i + 1, WINDOW), " ")
    ordered = F.array_sort(F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(window(i).alias("w"), i.alias("i"))))
    staged = staged.withColumn("_ordered", F.when(suspect, ordered))
    starts = F.filter(
        F.transform(
            "_ordered",
            lambda x, k: F.when(
                (x["w"] == F.get("_ordered", k - 1)["w"]) | (x["w"] == F.get("_ordered", k + 1)["w"]), x["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    staged = staged.withColumn("_starts", F.array_sort(starts))
    covered = F.aggregate(
        F.transform(
            "_starts",
            lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - s, F.lit(WINDOW))),
        ),
        F.lit(0),
        lambda a, n: a + n,
    )
    stop = sorted({w for words in STOP_WORDS.values() for w in words})
    long = lambda c: c.cast("bigint")
    return staged.withColumns(
        {
            "n_words": long(F.col("_n")),
            "word_chars": long(F.char_length(F.translate(body, SPACES, ""))),
            "n_symbols": long(F.regexp_count(body, F.lit(r"[#*$%&|<>]"))),
            "n_dup_lines": long(F.size("_lines") - F.size(F.array_distinct("_lines"))),
            "n_repeat_words": long(F.when(F.size("_starts") > 0, covered).otherwise(0)),
            "_n_lines": long(F.size("_lines")),
            "_n_stop": long(F.size(F.filter("_words", lambda w: F.lower(w).isin(stop)))),
            "_n_bullet": long(F.size(F.filter("_lines", lambda x: x.rlike(BULLET)))),
            "_n_cut": long(F.size(F.filter("_lines", lambda x: x.rlike(CUT)))),
        }
    )


def compiled(rules=RULES) -> dict[str, Column]:
    """One boolean column per rule of the table; a text that a measure does not apply to passes."""
    ratio = {
        "mean_word_chars": F.expr("try_divide(word_chars, n_words)"),
        "symbols_per_word": F.expr("try_divide(n_symbols, n_words)"),
        "dup_line_share": F.expr("try_divide(n_dup_lines, _n_lines)"),
        "stop_word_share": F.expr("try_divide(_n_stop, n_words)"),
        "bullet_line_share": F.expr("try_divide(_n_bullet, _n_lines)"),
        "cut_line_share": F.expr("try_divide(_n_cut, _n_lines)"),
    }
    out = {}
    for name, measure, low, high in rules:
        ok = F.lit(True)
        if low is not None:
            ok = ok & (ratio[measure] >= low)
        if high is not None:
            ok = ok & (ratio[measure] <= high)
        out[name] = F.coalesce(ok, F.lit(True))
    return out


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """``doc_id``, the counts, ``base_failed, kept`` and ``failed`` (the names of the rules not met).

    A null text has no words and fails the base.  Repeated rows give repeated results, an empty table an
    empty one; other columns are not looked at.
    """
    m = measures(docs.select("doc_id", "text"))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    tests = compiled(rules)
    failed = F.filter(
        F.array(*[F.when(~ok, F.lit(name)) for name, ok in tests.items()]), lambda x: x.isNotNull()
    )
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return m.select(
        *counts,
        base.alias("base_failed"),
        (~base & reduce(lambda a, b: a & b, tests.values(), F.lit(True))).alias("kept"),
        F.array_join(failed, ",").alias("failed"),
    )
