import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with extra columns whose names clash with inner ones."""

    def make(rows):
        rows = [(i, t, "a", "b", "c", 1) for i, t in rows]
        return spark.createDataFrame(
            rows,
            "doc_id bigint, text string, row string, mentions string, id string, size int",
        )

    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


LONG = " ".join(f"word{k % 977}x{k}" for k in range(60_000))
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, LONG), (6, LONG), (6, LONG),
    (None, "a row without an id"), (None, None), (8, "été \U0001f600 Δ"), (9, "one"),
]
