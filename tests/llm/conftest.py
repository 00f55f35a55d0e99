from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, _n int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, and clashing column names."""
    words = " ".join(f"word{i % 97} other{i % 31}," for i in range(9000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43, 0.1, 1),
        (2, "The QUICK brown fox jumps over the lazy dog", "en", "b", 43, 0.1, 1),
        (3, None, None, None, None, None, None), (None, "no id here at all", "en", "a", 17, 0.2, 2),
        (4, "", "en", "a", 0, 0.3, 3), (5, " \n\t ", "de", "b", 4, 0.4, 4),
        (6, words, "en", None, len(words), 0.5, 5), (6, words, "en", None, len(words), 0.5, 5),
        (7, "12345 67890 !!", "fr", "c", 14, 0.6, 6), (8, "two words", None, "c", 9, None, None),
        (8, "two words", None, "c", 9, None, None), (9, "ein Satz mit Wörtern und Umläuten", "de", "b", 33, 0.7, 7),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (50, [1.0, 0.0, 0.0], 1), (100, [1.0, 0.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 2), (4, [0.9, 0.1, 0.0], 2),
        (5, [0.0, 1.0, 0.0], None), (6, None, 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 0.0], 1),
        (9, [1.0, nan, 0.0], 1), (10, [1.0, inf, 0.0], 1), (None, [1.0, 0.0, 0.0], 1),
        (11, [0.0, 0.95, 0.05], 1), (12, [1.0, 1.0], 1), (150, [2.0, 2.0], 1), (13, [], 1),
        (5, [0.0, 1.0, 0.0], None),
    ]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
