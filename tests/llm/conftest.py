from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names that the operators use inside
CLASHES = ["id", "row", "node", "group", "score", "text_hash", "key", "word", "class", "root", "tile", "item", "__hash"]


@pytest.fixture(scope="session")
def table(spark):
    """Documents from (doc_id, text) pairs, with more columns of clashing names."""

    def make(rows, lang="en"):
        from pyspark.sql import functions as F

        frame = spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t in rows], SCHEMA)
        return frame.repartition(3).withColumns({c: F.lit("x") for c in CLASHES})

    return make


@pytest.fixture(scope="session")
def prose():
    """Texts of random words; the same for the same seed."""

    def make(seed: int, n: int, vocabulary: int = 2000) -> str:
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))

    return make


ODD = [
    (None, "no id at all"), (1, None), (2, ""), (3, "   \n\t "), (4, "x"), (5, "same text here"), (5, "same text here"),
    (6, "same text here"), (7, "Ünïcode ▁ 日本語 \x00  two  spaces"), (8, "w" * 300_000), (9, "long " * 60_000),
]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
