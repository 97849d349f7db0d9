"""Small tables that every operator has to survive."""

import pytest

LONG = "lorem ipsum dolor " * 30_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names the operators use themselves."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "copies", 1),
        (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", None, 2),
        (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", None, 2),
        (3, None, "fr", "x", 3),
        (4, "", None, "x", 4),
        (5, " \n\t ", "en", "x", 5),
        (6, LONG, "la", "x", 6),
        (None, "a row without an id", "en", "x", 7),
        (8, "x", "en", "x", None),
        (9, "日本語のテキスト — déjà vu \U0001f600", None, "x", 9),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens long").withColumnRenamed("source", "c0")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (2, 1, 0), (5, 0, 0), (6, 0, 1), (8, 0, 1), (None, 1, 1), (9, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
