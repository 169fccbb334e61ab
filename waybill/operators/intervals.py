"""Half-open ranges [range_min, range_max): lookup, overlaps, gaps, versions in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed value: stands for "no upper bound" while ranges are compared.
UNBOUNDED = "9999999999.99"
RANGE_TYPE = "decimal(12,2)"

# Ranges and values are compared within buckets of their order, at most this many.
BUCKETS = 256


class OverlappingRanges(ValueError):
    """Ranges of which more than one may hold a value."""


def _upper() -> Column:
    return F.coalesce(F.col("range_max"), F.lit(UNBOUNDED).cast(RANGE_TYPE))


# Up to so many ranges are held as one array by every task (some 100 bytes a range).
INDEXED_RANGES = 4_096


def range_lookup(facts: DataFrame, value: str, ranges: DataFrame, columns: list[str], prefix: str) -> DataFrame:
    """Left join each fact to the one range that holds its value; overlapping ranges are refused.

    Ranges measured to be few are one sorted array, searched by halves for each fact: facts stay where they are. Many
    ranges are carried forward over the distinct values, see :func:`_carried`. Both give the same rows.
    """
    named = ranges.select("range_min", "range_max", F.struct(*columns).alias("__match"))
    few = named.select("range_min", "range_max").orderBy("range_min").limit(INDEXED_RANGES + 1).collect()
    if len(few) > INDEXED_RANGES:
        joined = _carried(facts, value, named)
    else:
        _refuse_overlaps(few)
        joined = _searched(facts, value, named, len(few))
    return joined.select(
        *[F.col(c) for c in facts.columns], *[F.col(f"__match.{c}").alias(f"{prefix}{c}") for c in columns]
    )


def _refuse_overlaps(ranges: list) -> None:
    """Ranges in order of their lower bounds, as (range_min, range_max)."""
    for (low, high), (after, _) in zip(ranges, ranges[1:]):
        if high is None or high > after:
            raise OverlappingRanges(f"a range from {after} begins before {high}, where the one from {low} ends")


def _searched(facts: DataFrame, value: str, named: DataFrame, n: int) -> DataFrame:
    """The facts with the match of the range that holds their value, from ``n`` ranges as one array."""
    if not n:
        return facts.withColumn("__match", F.lit(None).cast(named.schema["__match"].dataType))
    index = named.agg(F.sort_array(F.collect_list(F.struct("range_min", "range_max", "__match")))).scalar()
    held = facts.withColumn("__ranges", index)
    v, mid = F.col(value), "(a.low + a.high) div 2"
    # after so many halvings, low is the number of ranges that begin at or below the value
    steps = ", ".join("0" for _ in range(n.bit_length()))
    below = F.expr(
        f"aggregate(array({steps}), struct(0L AS low, {n}L AS high), (a, x) -> if(a.low < a.high, "
        f"if(__ranges[int({mid})].range_min <= `{value}`, struct({mid} + 1 AS low, a.high AS high), struct(a.low AS low, {mid} AS high)), a)).low")
    last = F.when(v.isNotNull() & (below > 0), F.get("__ranges", (below - 1).cast("int")))
    found = held.withColumn("__last", last)
    inside = F.col("__last.range_max").isNull() | (v < F.col("__last.range_max"))
    return found.withColumn("__match", F.when(inside, F.col("__last.__match")))


def _carried(facts: DataFrame, value: str, named: DataFrame) -> DataFrame:
    """The same for any number of ranges.

    The distinct values of the facts are laid among the lower bounds, and the last range that begins
    at or below a value is carried forward to it: within buckets of values, and from bucket to bucket
    through one row per bucket. Facts get their range by equality of the value. No fact is compared
    with every range, however many there are.
    """
    clash = overlaps(named.withColumn("__row", F.to_json("__match")), [], "__row").limit(1).collect()
    if clash:
        raise OverlappingRanges(f"a range from {clash[0]['range_min']} begins before {clash[0]['reached']}, where another ends")
    kind = facts.schema[value].dataType
    values = facts.where(F.col(value).isNotNull()).select(F.col(value).alias("__at")).distinct()
    held = F.struct(F.col("range_max").alias("high"), "__match").alias("__held")
    begins = named.select(F.col("range_min").alias("__at"), F.lit(0).alias("__order"), held)
    empty = F.lit(None).cast(begins.schema["__held"].dataType)
    events = begins.unionByName(values.select("__at", F.lit(1).alias("__order"), empty.alias("__held")))
    bounds = _bounds(events, "__at")
    events = events.withColumn("__bucket", _bucket("__at", bounds))
    within = Window.partitionBy("__bucket").orderBy("__at", "__order").rowsBetween(Window.unboundedPreceding, 0)
    carried = events.withColumn("__own", F.last("__held", ignorenulls=True).over(within)).where("__order = 1")
    tops = begins.withColumn("__bucket", _bucket("__at", bounds)).groupBy("__bucket").agg(F.max(F.struct("__at", "__held")).alias("__top"))
    buckets = events.select("__bucket").distinct().join(tops, "__bucket", "left")
    earlier = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = buckets.select("__bucket", F.last("__top", ignorenulls=True).over(earlier).getField("__held").alias("__before"))
    found = F.coalesce("__own", "__before")
    high = F.col("__found.high")
    resolved = (
        carried.join(F.broadcast(before), "__bucket").select(F.col("__at").cast(kind).alias(value), found.alias("__found"))
        .where(high.isNull() | (F.col(value) < high)).select(value, "__found.__match")
    )
    return facts.join(resolved, value, "left")


def _bounds(rows: DataFrame, column: str) -> list:
    """Quantiles of a column, as values; a plan that cuts two tables uses one list for both."""
    shares = ", ".join(f"{i / BUCKETS}D" for i in range(1, BUCKETS))
    found = rows.agg(F.expr(f"percentile_approx(`{column}`, array({shares}), 10000)")).head()[0]
    return sorted(set(found or []))


def _bucket(column: str, bounds: list) -> Column:
    """How many bounds are at or below the column."""
    above = F.lit(0)
    for part in range(0, len(bounds), 64):
        above = above + F.size(F.filter(F.array(*[F.lit(b) for b in bounds[part:part + 64]]), lambda b: b <= F.col(column)))
    return above


def overlaps(ranges: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """Each range that begins before an earlier one of its group has ended.

    One row per offending range, with the farthest end among the ranges before it (NULL = unbounded),
    instead of all overlapping pairs. Ranges with the same lower bound are ordered by ``row_id``.

    A group may be large, so it is cut into buckets by the quantiles of all lower bounds: a running
    maximum within the bucket is joined with the running maximum over the earlier buckets' summaries.
    """
    rows = ranges.withColumn("__bucket", _bucket("range_min", _bounds(ranges, "range_min"))).withColumn("__upper", _upper())
    inner = Window.partitionBy(*keys, "__bucket").orderBy("range_min", row_id)
    marked = rows.withColumn("__within", F.max("__upper").over(inner.rowsBetween(Window.unboundedPreceding, -1)))
    outer = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy(*keys, "__bucket")
        .agg(F.max("__upper").alias("__top"))
        .select(*keys, "__bucket", F.max("__top").over(outer).alias("__before"))
    )
    reach = F.greatest(F.col("__within"), F.col("__before"))
    return (
        marked.join(before, [*keys, "__bucket"])
        .where(reach > F.col("range_min"))
        .select(
            *keys, row_id, "range_min", "range_max",
            F.nullif(reach, F.lit(UNBOUNDED).cast(RANGE_TYPE)).alias("reached"),
        )
    )


def gaps(ranges: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """Values between a range's end and the next range's start, which no range covers."""
    rows = ranges.withColumn("__bucket", _bucket("range_min", _bounds(ranges, "range_min")))
    inner = Window.partitionBy(*keys, "__bucket").orderBy("range_min", row_id)
    marked = rows.withColumn("__next", F.lead("range_min").over(inner))
    outer = Window.partitionBy(*keys).orderBy("__bucket")
    after = (
        rows.groupBy(*keys, "__bucket")
        .agg(F.min("range_min").alias("__first"))
        .select(*keys, "__bucket", F.lead("__first").over(outer).alias("__after"))
    )
    following = F.coalesce("__next", "__after")
    return (
        marked.join(after, [*keys, "__bucket"])
        .where(F.col("range_max") < following)
        .select(*keys, F.col("range_max").alias("gap_start"), following.alias("gap_end"))
    )


def version_periods(versions: DataFrame, scope: list[str]) -> DataFrame:
    """When each version was in force. Of several versions saved on one day the last one counts.

    Reducing to one row per day first bounds the window by the calendar, not by the number of saves.
    """
    daily = versions.groupBy(*scope, "effective_date").agg(F.max("version_id").alias("version_id"))
    by_day = Window.partitionBy(*scope).orderBy("effective_date")
    return daily.withColumn("next_effective_date", F.lead("effective_date").over(by_day))


def version_on(versions: DataFrame, scope: list[str], on_date: Column) -> DataFrame:
    """The version in force on one date: an aggregate, no window."""
    return (
        versions.where(F.col("effective_date") <= on_date)
        .groupBy(*scope)
        .agg(F.max(F.struct("effective_date", "version_id")).alias("__v"))
        .select(*scope, "__v.version_id", "__v.effective_date")
    )


def as_of_join(facts: DataFrame, versions: DataFrame, scope: list[str], on_date: str) -> DataFrame:
    """The version in force at each fact's date, or NULL before the first one.

    Resolved once per (scope, day) by carrying the last version forward over the days, then joined
    back on equality. There is no range join, and a window holds at most the days of one scope.
    """
    days = facts.select(*scope, F.col(on_date).alias("__day")).distinct().withColumn("__v", F.lit(None).cast("bigint"))
    saves = versions.groupBy(*scope, F.col("effective_date").alias("__day")).agg(
        F.max("version_id").cast("bigint").alias("__v")
    )
    merged = days.unionByName(saves).groupBy(*scope, "__day").agg(F.max("__v").alias("__v"))
    carried = F.last("__v", ignorenulls=True).over(
        Window.partitionBy(*scope).orderBy("__day").rowsBetween(Window.unboundedPreceding, 0)
    )
    resolved = merged.select(*scope, "__day", carried.alias("version_id")).withColumnRenamed("__day", on_date)
    return facts.join(resolved, [*scope, on_date], "left")
