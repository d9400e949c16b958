import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, stock=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(stock)}" for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows of (doc_id, text[, source])"""
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]))
            for r in rows
        ]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty, blank, very long and repeated rows."""
    long = prose(5, 60_000)
    return [
        (None, "no id here at all, only a text"), (1, None), (2, ""), (3, "  \t\n "),
        (4, long), (5, long), (6, "one"), (6, "one"), (7, "x" * 300_000), (8, prose(8, 40)),
        (8, prose(8, 40)), (9, "é ß 日本 ñandú " * 5), (10, None),
    ]


@pytest.fixture(scope="session")
def clash(spark):
    """Adds columns whose names differ only in case from the needed ones, or equal inner names."""

    def widen(frame):
        names = frame.columns
        wide = frame.selectExpr("*", "'a' AS TEXT", "1 AS Doc_Id", "2 AS block", "3 AS _0", "4 AS queue", "5 AS rep")
        assert len(wide.columns) == len(names) + 6
        return wide

    return widen
