"""The ratios of the quality rules on texts made for each of them."""

from tissueloom.llm import quality

PLAIN = "the cat sat on the mat and looked at a bird that sang in the old tree by day"


def failed(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "1 AS _lines", "2 AS n_words")
    return [r.failed for r in quality.judge(docs).orderBy("doc_id").collect()]


def test_line_and_stop_word_ratios(spark):
    listed = "\n".join(f"{mark} {i} {PLAIN}" for i, mark in enumerate("-*•-*•-*•-"))
    cut = "\n".join(f"{i} {PLAIN}" + ("... " if i < 4 else "") for i in range(10))
    few = "the " + " ".join(f"word{i}" for i in range(60))
    assert failed(spark, PLAIN, listed, "0 " + listed[2:] + "\nlast line", cut, cut.replace("...", "…"), few, "", None) == [
        "", "bullet_lines", "", "cut_lines", "cut_lines", "stop_words", "", "",
    ]
    assert failed(spark, "THE  cat\r\n" + PLAIN, PLAIN + "...\n" + PLAIN + "\n" + PLAIN + " x\n" + PLAIN + " y") == ["", ""]
