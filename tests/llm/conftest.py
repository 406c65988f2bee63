from __future__ import annotations

import pytest

LONG = "ein sehr langer text über nichts " * 20_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, repeats, and columns whose names
    operators use themselves."""
    rows = [
        (1, None, "en", "s", 0, 1, 2),
        (2, "", None, None, None, 1, 2),
        (None, "no id but a text of some words", "en", "s", 3, 1, 2),
        (None, "no id but a text of some words", "en", "s", 3, 1, 2),
        (3, LONG, "de", "s", 4, None, None),
        (4, "the same row twice over and over", "en", "s", 5, 1, 2),
        (4, "the same row twice over and over", "en", "s", 5, 1, 2),
        (5, " \t\r\n\x0b\x0c ", "en", "s", 6, 1, 2),
        (6, "1234 5678 ... !!!", "en", "s", 7, 1, 2),
        (7, "x", "fr", "s", 8, 1, 2),
    ]
    names = "doc_id long, text string, lang string, source string, n_chars long, bits long, n_words long"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
