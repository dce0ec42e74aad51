from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A function that makes a table of documents out of (doc_id, text) pairs or full rows."""

    def make(rows):
        return spark.createDataFrame([tuple(row) + ("en", "src", 1)[len(row) - 2 :] if len(row) < 5 else row for row in rows], DOCUMENTS)

    return make


def roots(n, pairs):
    """Smallest member of the component of each of n items."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


#: Texts that no operator may stumble over.
ODD = ["", None, " ", "\n\n", "\t \r\n", "a", "é", "x" * 5000, "ab " * 3000, "漢字 かな", "😀", "null", "\u0000", "a\u0000b", "Σ ΑΣ"]
