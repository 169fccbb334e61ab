"""Joins to a side that has one row per key, planned by the measured size of that side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def fits_broadcast(dim: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Rows and bytes as text, by a plain aggregate: each task sends one row."""
    size = F.sum(F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in dim.columns]))))
    found = dim.agg(F.count(F.lit(1)).alias("rows"), size.alias("bytes")).head()
    return found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str = "left",
    *,
    null_safe: bool = False,
    derived: bool = False,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join facts to a reference table with one row per key.

    Reference keys are few and uneven (one charge name may be a third of all rows), so shuffling the
    facts on them is avoided while the table is measured small: then it is broadcast. A larger one is
    joined by equality; adaptive execution splits the partitions of hot keys.

    ``derived`` marks a table that is itself computed from the facts: it is written first, so that
    measuring and joining it do not compute it twice.
    """
    if derived:
        dim = written(dim, "lookup")
    return _join(facts, F.broadcast(dim) if fits_broadcast(dim, max_rows) else dim, keys, how, null_safe)


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, keys, how)
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition: Column | None = None
    for key in keys:
        same = left[key].eqNullSafe(renamed[f"__r_{key}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])
