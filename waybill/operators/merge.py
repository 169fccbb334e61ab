"""Idempotent append, keyed upsert and joined update, each as a function of whole snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import fold


class DuplicateKeys(ValueError):
    """Rows that a unique key of the model does not allow."""


def append_new(new: DataFrame, existing: DataFrame, keys: list[str], *, text_keys: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``new`` whose key is not in ``existing`` (NULLs compare equal)."""
    known = existing.select(*[_key(c, text_keys).alias(f"__e_{c}") for c in keys])
    condition = None
    for c in keys:
        same = _key(c, text_keys).eqNullSafe(F.col(f"__e_{c}"))
        condition = same if condition is None else condition & same
    return new.join(known, condition, "left_anti")


def _key(column: str, text_keys: tuple[str, ...], name: str | None = None) -> Column:
    return fold(F.col(column)) if (name or column) in text_keys else F.col(column)


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], *, refresh: list[str], insert_only: list[str],
    text_keys: tuple[str, ...] = (),
) -> DataFrame:
    """Source rows are inserted; matched ones overwrite ``refresh`` columns where they have a value.

    ``insert_only`` columns are set once and never change.
    """
    t, s = target.alias("t"), source.alias("s")
    condition = None
    for k in keys:
        same = _key(f"t.{k}", text_keys, k).eqNullSafe(_key(f"s.{k}", text_keys, k))
        condition = same if condition is None else condition & same
    known = F.col("t.__in").isNotNull()
    return (
        t.withColumn("__in", F.lit(True)).alias("t")
        .join(s, condition, "full_outer")
        .select(
            *[F.when(known, F.col(f"t.{k}")).otherwise(F.col(f"s.{k}")).alias(k) for k in keys],
            *[F.when(known, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in insert_only],
            *[F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c) for c in refresh],
        )
    )


def joined_update(target: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Overwrite ``columns`` of the rows that have an update; ``updates`` has one row per key."""
    u = updates.select(key, F.struct(*columns).alias("__u"))
    hit = F.col("__u").isNotNull()
    return target.join(u, key, "left").select(
        *[
            F.when(hit, F.col(f"__u.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def require_unique(rows: DataFrame, keys: list[str], what: str) -> DataFrame:
    sample = duplicate_keys(rows, keys).limit(1).collect()
    if sample:
        raise DuplicateKeys(f"{what}: several rows for one ({', '.join(keys)}), e.g. {sample[0].asDict()}")
    return rows
