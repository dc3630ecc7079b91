from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of (doc_id, text) pairs."""

    def make(rows, extra: bool = False):
        df = spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], SCHEMA)
        if extra:  # names that the operators use themselves
            for c in ("id", "n", "cid", "gid", "pos", "token", "start", "base", "spans", "ids", "seq", "part", "kind", "url", "m"):
                df = df.selectExpr("*", f"'x' AS {c}")
        return df

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank, very long, tied and repeated rows."""
    words = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, words), (5, "one"), (6, "one two"), (7, "one two three"),
        (7, "one two three"), (8, "one two three"), (None, "a null id with some words"), (None, None), (9, "x" * 50_000),
    ]
