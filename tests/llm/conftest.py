import pytest

EDGE = [
    (1, "", "en", "s", 0, "x"),
    (2, None, None, None, None, None),
    (3, " \t\r\n ", "en", "s", 5, "x"),
    (4, "The same words in the same order are here. The same words in the same order are here.", "en", "s", 1, "x"),
    (4, "The same words in the same order are here. The same words in the same order are here.", "en", "s", 1, "x"),
    (5, "the SAME words in the same order are here. The same words in the same order are here.", "en", "s", 1, "x"),
    (None, "mail a.b@c.example.org or +1 (716) 555-8176\nshared line of text", "fr", "s", 1, "x"),
    (6, "mail a.b@c.example.org 10.0.0.1 and 4355962923076149\nshared line of text", "fr", "s", 1, "x"),
    (7, "shared line of text\n" + "w" * 300_000 + " idiot\n\n" + "a b c d e " * 2000, "de", "s", 1, "x"),
    (8, "*** ### 123 !!!", "de", "s", 1, "x"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, `lines` string"


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, repeated rows, and an extra column whose name an operator uses inside."""
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
