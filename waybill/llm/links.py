"""Links between members of groups, found without listing all pairs of a group.

Members that share a group may be linked; whether they are is decided by an exact check of the two. Star rounds over the large
groups come first: in each, a few members, others in each round, are checked against those not yet connected with them, so a
group of near copies of any size becomes connected by work in proportion to its size. The last round checks every pair of a group
that is still not connected and passes the filter. A pair within one component is never checked again, as it cannot change a
component. So components are those of all links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import discard, written
from .components import components

STAR_ROUNDS, STARS = 2, 8
FEW = 16  # members of a group that needs no star


def at_least(percent: int) -> Callable[[np.ndarray, np.ndarray], bool]:
    """Whether two sorted sets have 100 * intersection >= percent * union."""

    def decide(x: np.ndarray, y: np.ndarray) -> bool:
        if len(x) > len(y):
            x, y = y, x
        if not len(x) or 100 * len(x) < percent * len(y):
            return False
        at = np.minimum(np.searchsorted(y, x), len(y) - 1)
        common = int((y[at] == x).sum())
        return 100 * common >= percent * (len(x) + len(y) - common)

    return decide


def verified(pairs: DataFrame, nodes: DataFrame, decide: Callable[[np.ndarray, np.ndarray], bool]) -> DataFrame:
    """Those (a, b) whose items are close enough. ``nodes``: node, items (uint64 as bytes)."""
    left = nodes.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("items").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column("x")[i].as_buffer(), np.uint64)
                y = np.frombuffer(batch.column("y")[i].as_buffer(), np.uint64)
                if decide(x, y):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def connect(
    members: DataFrame, attributes: list[str], may_link: Callable[[str, str], Column],
    check: Callable[[DataFrame], DataFrame], first_meeting: Callable[[str, str], Column] = lambda x, y: F.lit(True),
) -> DataFrame:
    """(node, root) of the nodes linked with another.

    ``members``: group, node and attributes, written; ``may_link`` gives a necessary condition from the prefixes of the
    two sides' attributes; ``check`` takes (a, b) with a < b and returns those linked.
    """
    spark = members.sparkSession
    roots = spark.createDataFrame([], "node bigint, root bigint")
    sizes = members.groupBy("group").agg(F.count("*").alias("n"))
    large = written(members.join(sizes.where(F.col("n") > FEW), "group", "left_semi"), "large-groups")
    for turn in range(STAR_ROUNDS if large.limit(1).count() else 0):
        now = _open(large, roots)
        # the members of least hash, by a hash of its own for each star
        orders = [F.xxhash64("node", F.lit(turn * STARS + k)) for k in range(STARS)]
        firsts = [F.min(F.struct(order.alias("at"), "node", "comp", *attributes)) for order in orders]
        pivots = now.groupBy("group").agg(*[first.alias(f"p{k}") for k, first in enumerate(firsts)])
        pivots = pivots.select("group", F.explode(F.array(*[f"p{k}" for k in range(STARS)])).alias("p"))
        other = pivots.select("group", *[F.col(f"p.{c}").alias(f"y_{c}") for c in ("node", "comp", *attributes)])
        found = _checked(now, other, attributes, may_link, check, F.col("x_comp") != F.col("y_comp"))
        discard(now)
        if found is None:
            break
        roots = _more(roots, found)
    discard(large)
    now = _open(members, roots)
    other = now.select("group", *[F.col(c).alias(f"y_{c}") for c in ("node", "comp", *attributes)])
    wanted = (F.col("x_comp") != F.col("y_comp")) & (F.col("x_node") < F.col("y_node")) & first_meeting("x_", "y_")
    found = _checked(now, other, attributes, may_link, check, wanted)
    discard(now)
    return roots if found is None else _more(roots, found)


def _open(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of groups that hold more than one component, with the component."""
    now = rows.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    spread = now.groupBy("group").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high").select("group")
    return written(now.join(spread, "group", "left_semi"), "open-groups")


def _checked(
    now: DataFrame, other: DataFrame, attributes: list[str], may_link: Callable[[str, str], Column],
    check: Callable[[DataFrame], DataFrame], wanted: Column,
) -> DataFrame | None:
    """The linked pairs of rows with partners of their group, written; None without any."""
    one = now.select("group", *[F.col(c).alias(f"x_{c}") for c in ("node", "comp", *attributes)])
    pairs = one.join(other, "group").where(wanted & may_link("x_", "y_"))
    pairs = pairs.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
    found = written(check(pairs), "links")
    return found if found.limit(1).count() else None


def _more(roots: DataFrame, found: DataFrame) -> DataFrame:
    """(node, root) after more links."""
    known = roots.where("node != root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    more = written(components(known.unionByName(found)), "components")
    discard(found, roots)
    return more
