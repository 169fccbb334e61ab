"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import discard, written


ONE_TASK_EDGES = 200_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node with an edge: the root is the least node it is connected with.

    Rounds of large star and small star: each node's neighbours are hung to the least of them, first those above the node,
    then those below, until the graph is a set of stars. A round is a few joins by node; its result is written to the shared
    folder, so a lost executor costs one round. The minima are combined before each exchange, and a node with very many
    neighbours is met by equality with one row, which adaptive execution can split.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    e = written(e, "edges")
    while True:
        # a small graph is finished in one task; a coalesced scan needs no exchange for any of the joins
        if e.count() <= ONE_TASK_EDGES:
            e = e.coalesce(1)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = written(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        done = e
        e = written(small, "small-star")
        discard(done, large)
        parents = e.groupBy("u").agg(F.count("*").alias("n"))
        several = parents.where("n > 1").limit(1).count()
        if not several and not e.join(e.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count():
            break
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
