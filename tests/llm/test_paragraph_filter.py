"""Which pairs of paragraphs are compared."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from waybill.llm import paragraphs
from waybill.llm.paragraphs import PERCENT, Paragraphs, alone


def test_no_similar_pair_is_lost_and_no_other_number_is_let_through(spark):
    both = {r.n: r.most for r in spark.range(2, 53).select(F.col("id").alias("n"), alone(F.col("id").cast("int")).alias("most")).collect()}
    for a in range(1, 27):
        for b in range(1, 27):
            similar = [a + b - 2 * c for c in range(1, min(a, b) + 1) if 100 * c >= PERCENT * (a + b - c)]
            assert max(similar, default=-1) <= both[a + b]
            if a == b:
                assert max(similar) == both[a + b]
    assert both[52] == 4


def test_number_of_different_shingles():
    words = [f"w{i}" for i in range(40)]
    found = Paragraphs(pa.array([" ".join(words[:30]), " ".join(["a"] * 30)]))
    counts = found.distinct(np.arange(len(found.at)))
    assert counts.tolist() == [paragraphs._SIZE, 1]
