"""Group-wise work that stays spread out when one group holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A group larger than this is joined by broadcast. Over N rows there are at most N / HOT_ROWS such
# groups (40,000 in 10^11 rows), which bounds the broadcast.
HOT_ROWS = 2_500_000
SPREAD = 1024

_HOT, _COLD, _SPREAD = "__hot", "__cold", "__spread"


def attach_group_values(
    rows: DataFrame,
    keys: list[str],
    groups: DataFrame,
    size: str,
    spread_by: list[str],
    *,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join rows to aggregates of their own group: what a window without order would give.

    A window brings a whole group into one task. Here the aggregates in ``groups`` (one row per
    non-null key, with the group's row count in ``size``) are built with map-side partial results and
    joined back. Rows of hot groups get theirs from a broadcast and are spread over the exchange by a
    hash of ``spread_by``, so no task holds a whole hot group. The hash is of content, so a task that
    runs again sends each row to the same place.
    """
    values = [c for c in groups.columns if c not in keys]
    payload = F.struct(*values)
    hot = groups.where(F.col(size) > hot_rows).select(*keys, payload.alias(_HOT))
    # zero, but not as a literal: the optimizer would drop a constant from the join key and bring
    # the rows of a hot group together again
    zero = F.pmod(F.col(size), F.lit(1)).cast("int")
    cold = groups.where(F.col(size) <= hot_rows).select(*keys, payload.alias(_COLD), zero.alias(_SPREAD))
    marked = rows.join(F.broadcast(hot), keys, "left").withColumn(
        _SPREAD,
        F.when(F.col(_HOT).isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)).cast("int")),
    )
    joined = marked.join(cold, [*keys, _SPREAD], "left")
    found = F.coalesce(F.col(_HOT), F.col(_COLD))
    return joined.select(*[F.col(c) for c in rows.columns], *[found[n].alias(n) for n in values])


def last_per_key(rows: DataFrame, keys: list[Column], order_first: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order_first``, ties broken by the remaining columns.

    An aggregate with partial combine, so a hot key is reduced before the exchange. NULLs sort lowest.
    """
    rest = [c for c in rows.columns if c not in order_first]
    names = [f"__k{i}" for i in range(len(keys))]
    picked = (
        rows.groupBy(*[k.alias(n) for k, n in zip(keys, names)])
        .agg(F.max(F.struct(*order_first, *rest)).alias("__row"))
        .select("__row.*")
    )
    return picked.select(*rows.columns)
