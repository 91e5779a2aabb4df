import pytest
from pyspark.sql import Row

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, score string"
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from the bear", "en", "a", 70, 7, "x"),
    (2, "the quick brown fox jumps over the lazy dog and runs away from the bear", "en", "a", 70, 7, "x"),
    (2, "the quick brown fox jumps over the lazy dog and runs away from the bear", "en", "a", 70, 7, "x"),
    (3, None, None, None, None, None, None),
    (4, "", "en", "b", 0, 0, ""),
    (5, " \t\n ", "en", "b", 4, 0, ""),
    (6, "one", "en", "b", 3, 1, None),
    (None, "a text without an id MIT License", "en", None, 30, 6, None),
    (7, "word " * 30000, "en", "c", 150000, 30000, None),
    (8, "Éé ß 日本語 \U0001d4b3 x" * 3, "xx", "c", 20, 4, None),
    (9, "line\nline\nline\n\nother line", "en", "c", 20, 5, None),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like results."""
    return spark.createDataFrame([Row(*r) for r in ROWS], DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
