"""Bounded choices of rows that do not depend on how the rows are partitioned."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_STEPS = 1 << 40


def hashed_sample(rows: DataFrame, key: str, most: int, text: str | None = None, n: int | None = None) -> DataFrame:
    """One row of each key and text, if there are at most ``most``, else of about that many: those of least hash.

    Null and repeated keys are dealt by their texts. ``n``, where known, says how many to choose among; if it counts
    repeated rows, fewer are chosen.
    """
    at = F.xxhash64(*[F.col(f"`{c}`") for c in (key, text) if c is not None])
    hashed = rows.select(at.alias("at"), F.struct("*").alias("row"))
    n = hashed.select("at").distinct().count() if n is None else n
    if n > most:
        hashed = hashed.where(F.expr(f"pmod(at, {_STEPS}L)") < int(most / n * _STEPS))
    return hashed.groupBy("at").agg(F.min("row").alias("row")).select("row.*")


def most_counted(counts: DataFrame, count: str, most: int) -> DataFrame:
    """The rows counted at least 2^k times, for the least k that leaves at most ``most`` rows. ``counts`` is written."""
    steps = counts.groupBy(F.floor(F.log2(count)).alias("k")).agg(F.count("*").alias("n")).collect()
    left, cut = 0, 64
    for step in sorted(steps, key=lambda r: -r.k):
        if left + step.n > most:
            break
        left, cut = left + step.n, step.k
    return counts.where(F.col(count) >= float(2**cut))
