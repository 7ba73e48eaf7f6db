from __future__ import annotations

import pytest

#: Nulls, empty and long texts, ties, repeated rows, and columns named like working columns.
ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t\x0b "),
    (4, "one"),
    (4, "one"),
    (4, "another text with the same id"),
    (None, "a text without an id"),
    (None, None),
    (5, "é漢😀 <|im_end|> & ünï " * 40),
    (6, "word " * 30_000),
    (7, "x" * 20_000),
]


@pytest.fixture
def odd_docs(spark):
    """Odd rows with extra columns that clash with working columns and results."""
    rows = [(i, text, "k", 1, "r", None, "en") for i, text in ODD_TEXTS]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, key string, first int, `row` string, out string, `odd.name` string",
    )


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, key string")
