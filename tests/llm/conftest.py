import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = " ".join(f"word{i}" for i in range(60_000))
BASE = " ".join(f"alpha{i % 37} beta{i}" for i in range(60))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, long, repeated and tied rows, and columns whose names clash with inner ones."""
    rows = [
        (1, BASE, "x"),
        (2, BASE.replace("beta7 ", "gamma "), "x"),
        (2, BASE.replace("beta7 ", "gamma "), "x"),
        (3, None, None),
        (4, "", "x"),
        (5, " \n\t ", None),
        (6, LONG, "x"),
        (7, LONG + " end", "x"),
        (8, "one two", "x"),
        (9, "One TWO", "x"),
        (None, BASE, "x"),
        (10, BASE.upper(), "x"),
        (11, "Licensed under the Apache License, Version 2.0.\nother line with several words in it", "x"),
        (12, "\x00\x1c odd é中\U0001f600 signs <|endoftext|>", "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    extra = {c: df["lang"] for c in ("row", "found", "key", "n", "class_id", "score", "html", "_hash", "lines", "removed", "gone")}
    return df.withColumns(extra)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
