from __future__ import annotations

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from waybill.operators import (
    append_new, attach_group_values, duplicate_keys, joined_update, last_per_key, lookup_join, require_unique, upsert,
)
from waybill.operators.intervals import as_of_join, gaps, overlaps, range_lookup, version_on, version_periods
from waybill.operators.merge import DuplicateKeys
from waybill.operators.unpivot import described, fixed, unpivot_charges
from waybill.session import discard, written


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows."""
    return spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("v")
    )


def groups_of(facts):
    return facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top"))


def test_group_values_hot_and_cold_agree(skewed):
    groups = groups_of(skewed)
    want = rows(skewed.join(groups, "k").select("k", "v", "n", "top"))
    for limit in (1, 100, 10**6):
        got = attach_group_values(skewed, ["k"], groups, "n", ["v"], hot_rows=limit)
        assert rows(got) == want


def test_hot_group_is_spread(spark, skewed):
    """Rows of the hot key land in many partitions of the exchange, and the salt stays in the join key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = attach_group_values(skewed, ["k"], groups_of(skewed), "n", ["v"], hot_rows=100)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        placed = joined.where("k = -1").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = next(line for line in plan.splitlines() if "SortMergeJoin" in line)
    assert "__spread" in join.split("LeftOuter")[0]
    assert len(placed) == 8 and max(r["count"] for r in placed) < 1000


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_lookup_beyond_broadcast_is_exact(spark, skewed, how):
    dim = spark.range(0, 500, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    dim = dim.unionByName(spark.createDataFrame([(-1, 7)], "k bigint, w bigint"))
    dim = dim if how in ("left", "inner") else dim.select("k")
    small, large = lookup_join(skewed, dim, ["k"], how), lookup_join(skewed, dim, ["k"], how, max_rows=5)
    assert rows(small) == rows(large)


def test_lookup_null_safe(spark):
    facts = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (None, None, "c")], "x int, y int, v string")
    dim = spark.createDataFrame([(1, None, "none"), (1, 2, "two")], "x int, y int, w string")
    want = [(1, 2, "b", "two"), (1, None, "a", "none"), (None, None, "c", None)]
    for bound in (10, 0):
        assert rows(lookup_join(facts, dim, ["x", "y"], "left", null_safe=True, max_rows=bound)) == want


def test_derived_lookup_is_written_once(spark, skewed):
    got = lookup_join(skewed, groups_of(skewed), ["k"], "inner", derived=True)
    assert got.count() == skewed.count()
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_last_per_key(spark):
    frame = spark.createDataFrame(
        [("A", 1, "x"), ("a ", 2, "y"), ("a", None, "z"), ("b", 1, None), ("b", 1, "q")], "k string, t int, v string"
    )
    got = last_per_key(frame, [F.lower(F.rtrim("k"))], ["t"])
    assert rows(got) == [("a ", 2, "y"), ("b", 1, "q")]


def test_unpivot(spark):
    frame = spark.createDataFrame(
        [(1, D("5.00"), "Fee", D("2.00")), (2, D("0.00"), " ", D("3.00")), (3, D("-1.00"), None, None)],
        "id int, base decimal(18,2), d string, a decimal(18,2)",
    )
    got = unpivot_charges(frame, fixed(("Base", "base")) + described(("d", "a")), ["id"])
    assert rows(got) == [(1, "Base", D("5.00")), (1, "Fee", D("2.00")), (3, "Base", D("-1.00"))]


def test_append_new(spark):
    new = spark.createDataFrame([(1, "T1 "), (1, None), (2, "t2")], "c int, t string")
    old = spark.createDataFrame([(1, "t1"), (1, None), (3, "t2")], "c int, t string")
    assert rows(append_new(new, old, ["c", "t"], text_keys=("t",))) == [(2, "t2")]
    assert append_new(new, new, ["c", "t"]).count() == 0


def test_upsert(spark):
    schema = "k int, first string, w int"
    target = spark.createDataFrame([(1, "old", 5), (2, None, 6)], schema)
    source = spark.createDataFrame([(1, "new", None), (2, "new", 7), (3, "new", 8)], schema)
    got = upsert(target, source, ["k"], refresh=["w"], insert_only=["first"])
    assert rows(got.select("k", "first", "w")) == [(1, "old", 5), (2, None, 7), (3, "new", 8)]


def test_joined_update(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    got = joined_update(target, spark.createDataFrame([(1, None)], "k int, v string"), "k", ["v"])
    assert rows(got) == [(1, None, 1), (2, "b", 2)]


def test_unique_keys(spark):
    frame = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "a int, b int")
    assert rows(duplicate_keys(frame, ["a", "b"])) == [(1, 1, 2)]
    with pytest.raises(DuplicateKeys, match="invoices"):
        require_unique(frame, ["a"], "invoices")
    assert require_unique(frame.distinct(), ["a", "b"], "invoices").count() == 2


RANGE = "g string, id int, range_min decimal(12,2), range_max decimal(12,2)"


def test_golden_overlaps(spark):
    pairs = {"x": [(0, 50), (30, 100)], "y": [(0, 50), (50, 100)], "z": [(0, 50), (50, None)], "same": [(10, 20), (10, 15)], "open": [(0, None), (5, 6)]}
    data = [(g, i, D(a), None if b is None else D(b)) for g, rs in pairs.items() for i, (a, b) in enumerate(rs)]
    found = rows(overlaps(spark.createDataFrame(data, RANGE), ["g"], "id").select("g", "id", "reached"))
    # of two ranges with one lower bound the later id is reported
    assert found == [("open", 1, None), ("same", 1, D("20.00")), ("x", 1, D("50.00"))]


def brute(data):
    over, holes = [], []
    for g in {r[0] for r in data}:
        own = sorted((r for r in data if r[0] == g), key=lambda r: (r[2], r[1]))
        for i, r in enumerate(own):
            before = [D("9999999999.99") if q[3] is None else q[3] for q in own[:i]]
            if before and max(before) > r[2]:
                over.append((g, r[1]))
            if i + 1 < len(own) and r[3] is not None and r[3] < own[i + 1][2]:
                holes.append((g, r[3], own[i + 1][2]))
    return sorted(over), sorted(holes)


@pytest.mark.parametrize("seed", [1, 7, 50])
def test_overlaps_and_gaps_against_brute_force(spark, seed):
    rng = random.Random(seed)
    data = []
    for i in range(400):
        low = rng.randrange(300)
        data.append((f"g{rng.randrange(6)}", i, D(low), None if rng.random() < .02 else D(low + rng.randrange(40))))
    frame = spark.createDataFrame(data, RANGE)
    want_over, want_gaps = brute(data)
    got = sorted((r.g, r.id) for r in overlaps(frame, ["g"], "id").collect())
    assert got == want_over
    got = sorted((r.g, r.gap_start, r.gap_end) for r in gaps(frame, ["g"], "id").collect())
    assert got == want_gaps


@pytest.mark.parametrize("n", [1, 40, 1_500])
def test_range_lookup(spark, n):
    """The same at every number of ranges: each value finds the range that holds it."""
    ranges = spark.range(n).select(
        (F.col("id") * 10).cast("decimal(12,2)").alias("range_min"),
        F.when(F.col("id") < n - 1, F.col("id") * 10 + 8).cast("decimal(12,2)").alias("range_max"), F.col("id").alias("name"),
    )
    values = spark.range(-20, 10 * n + 50).select(F.col("id").cast("decimal(18,2)").alias("v"))
    facts = values.unionByName(values.where("v < 30")).unionByName(spark.createDataFrame([(None,)], "v decimal(18,2)"))
    got = range_lookup(facts, "v", ranges, ["name"], "r_").collect()
    assert len(got) == facts.count()
    for row in got:
        v = row.v
        k = None if v is None or v < 0 else int(v // 10)
        want = None if k is None else n - 1 if k >= n - 1 else k if v < 10 * k + 8 else None
        assert row.r_name == want


def test_range_lookup_refuses_overlaps(spark):
    from waybill.operators.intervals import OverlappingRanges

    facts = spark.createDataFrame([(D(5),)], "v decimal(12,2)")
    for high in (D(11), None):
        ranges = spark.createDataFrame([(D(0), high, 1), (D(10), D(20), 2)], "range_min decimal(12,2), range_max decimal(12,2), name int")
        with pytest.raises(OverlappingRanges):
            range_lookup(facts, "v", ranges, ["name"], "r_")


def test_versions_in_time(spark):
    versions = spark.createDataFrame(
        [("s", 1, "2026-01-01"), ("s", 2, "2026-01-10"), ("s", 3, "2026-01-10"), ("s", 4, "2026-02-01"), ("r", 9, "2026-01-05")],
        "scope string, version_id bigint, d string",
    ).select("scope", "version_id", F.col("d").cast("date").alias("effective_date"))
    periods = {(r.scope, r.version_id): str(r.next_effective_date) for r in version_periods(versions, ["scope"]).collect()}
    assert periods == {("s", 1): "2026-01-10", ("s", 3): "2026-02-01", ("s", 4): "None", ("r", 9): "None"}
    on = version_on(versions, ["scope"], F.lit("2026-01-15").cast("date"))
    assert {(r.scope, r.version_id) for r in on.collect()} == {("s", 3), ("r", 9)}
    facts = spark.createDataFrame(
        [(1, "s", "2025-12-31"), (2, "s", "2026-01-01"), (3, "s", "2026-01-31"), (4, "s", "2026-03-01"), (5, "t", "2026-03-01"), (6, "s", "2026-01-31")],
        "i int, scope string, t string",
    ).withColumn("day", F.col("t").cast("date"))
    got = {r.i: r.version_id for r in as_of_join(facts, versions, ["scope"], "day").collect()}
    assert got == {1: None, 2: 1, 3: 3, 4: 4, 5: None, 6: 3}


def test_written_tables_are_whole_and_discarded_ones_are_gone(spark, skewed):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    grouped = groups_of(skewed)
    table = written(grouped, "groups")
    assert spark.conf.get(setting, None) == before
    assert rows(table) == rows(grouped)
    # the written frame is not tied to the shuffles that went with its write, nor is a later table to a discarded one
    further = written(table.groupBy("n").agg(F.count("*").alias("keys")), "sizes")
    discard(table)
    assert sum(r["keys"] for r in further.collect()) == grouped.count()
    with pytest.raises(Exception):
        table.collect()


def test_discarding_an_empty_table(spark, skewed):
    table = written(skewed.where("k > 1000"), "none")
    discard(table)
    assert skewed.count() == 9000
