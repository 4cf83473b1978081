import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Columns whose names the operators use themselves.
CLASHES = ["n_words", "kept", "row", "id", "others", "marks", "score", "hits", "_key", "node", "verdict", "Rule", "licences", "n_bytes", "text_"]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, equal rows, and columns with clashing names."""
    long = " ".join(f"w{i % 977} x{i * i % 1009}" for i in range(60_000))
    rows = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, None), (3, ""), (None, "a b c d e f g h i"), (None, None), (4, " \n\t "), (5, long), (6, long),
            (7, "é" * 500), (8, "z " * 300), (9, "Line one\nLine one\nLine two")]
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(i, t, None if k % 3 == 0 else "s", *["v"] * len(CLASHES)) for k, (i, t) in enumerate(rows)], schema)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
