"""Documents whose sets of word shingles have a Jaccard similarity of at least a given share: grouped prefix join, exact.

A document's set holds its distinct runs of four words (fewer words: the whole sequence). All shingles have one global
order, from rare to frequent. If two sets are similar enough, they share a shingle among the first few of each (the prefix).

1. Documents with equal sets, and so equal prefixes and sizes, are one group; a group has one node.
2. Of the shingles with the least third of all hashes it is known which were met more than once (an aggregate over all of
   them, kept as a filter of fixed size). Those met once come first in the order; then those of which nothing is known; then
   the repeated ones; last the frequent ones, by how often they were met. A document with enough shingles of its own has a
   prefix that nobody shares and sends no rows. Prefix shingles held by one group only are then found by an aggregate over
   (shingle, least group, greatest group) and left out by a filter; what remains is joined.
3. Pairs of groups that share a prefix shingle pass the length and position filters, and one by parities of 256 slots, from
   which two sets are seen to differ too much without reading them. What passes is verified exactly on their whole
   sets, by ``links.connect``: stars first, so that groups of thousands of near copies do not become all pairs.
4. Components over groups are expanded to the documents.

The list of frequent shingles has at most ``FREQUENT`` entries and is the only thing broadcast besides the filters. It steers
the work; any order gives the same links. Null and empty texts, and texts without words, have an empty set and link with
nothing; documents of equal non-empty sets link. Repeated rows link with each other. A null id is a member like any other
and is left out of the least id of a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from .chunks import slices
from .filters import key_filter, passes
from .links import at_least, connect, verified
from .sampling import most_counted
from .tokens import mix, shingles_of, words_of

FREQUENT = 1 << 17
_WINDOW = 1 << 21  # shingles counted at a time
SKETCH = ("s0", "s1", "s2", "s3")
_LOW = np.uint64((1 << 64) // 3)


def distinct_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' distinct shingles, sorted within each text, and where each text's begin."""
    shingles, ends = shingles_of(words_of(column), width, short_as_one=True)
    for a, b in zip(ends.tolist(), ends[1:].tolist()):
        shingles[a:b].sort()
    first = np.ones(len(shingles), bool)
    first[1:] = shingles[1:] != shingles[:-1]
    first[ends[:-1][np.diff(ends) > 0]] = True
    kept = np.concatenate([[0], np.cumsum(first)])
    return shingles[first], kept[ends].astype(np.int64)


def node_ids(shingles: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; 0 for the empty one."""
    sums = np.zeros(len(shingles) + 1, np.uint64)
    np.cumsum(mix(shingles + np.uint64(0x9E37)), out=sums[1:])
    sizes = np.diff(ends).astype(np.uint64)
    return np.where(sizes > 0, mix(sums[ends[1:]] - sums[ends[:-1]] + sizes), np.uint64(0)).view(np.int64)


def frequent_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """(shingle, count) of the shingles met most, sorted by shingle; of those met twice within some window of a task.

    Every document is counted. What is met once in a window is not passed on, so counts are lower bounds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            several = counts > 2
            return pa.record_batch([pa.array(keys[several].view(np.int64)), pa.array(counts[several])], names=["key", "n"])

        for batch in slices(batches, "text"):
            shingles, _ = distinct_sets(batch.column("text"), width)
            held.append(shingles)
            size += len(shingles)
            if size >= _WINDOW:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    counts = docs.select("text").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    top = most_counted(written(counts, "frequent"), "n", FREQUENT).toArrow()
    keys = top["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return np.stack([keys[order], top["n"].to_numpy().astype(np.uint64)[order]])


def repeated_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """A filter of the shingles of the least hashes that were met more than once; copies within a batch count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            shingles, ends = distinct_sets(batch.column("text"), width)
            once = own_rows(node_ids(shingles, ends))
            low = (shingles < _LOW) & np.repeat(once, np.diff(ends))
            yield pa.record_batch([pa.array(shingles[low].view(np.int64))], names=["key"])

    keys = docs.select("text").mapInArrow(run, "key bigint").groupBy("key").agg(F.count("*").alias("n"))
    return key_filter(written(keys.where("n > 1").select("key"), "repeated"), "key")


def own_rows(nodes: np.ndarray) -> np.ndarray:
    """True for the first text of each non-empty set."""
    out = np.zeros(len(nodes), bool)
    out[np.unique(nodes, return_index=True)[1]] = True
    return out & (nodes != 0)


def parities(shingles: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """For each text, whether the number of its shingles is odd in each of 256 slots.

    Two sets differ in at least as many shingles as their parities differ in slots.
    """
    slot = (shingles >> np.uint64(20)) & np.uint64(255)
    one = np.uint64(1) << (slot & np.uint64(63))
    out = []
    for k in range(len(SKETCH)):
        own = np.append(np.where(slot >> np.uint64(6) == k, one, np.uint64(0)), np.uint64(0))
        found = np.bitwise_xor.reduceat(own, ends[:-1]) if len(ends) > 1 else np.zeros(0, np.uint64)
        out.append(np.where(np.diff(ends) > 0, found, np.uint64(0)))
    return out


def prefixes(
    shingles: np.ndarray, ends: np.ndarray, chosen: np.ndarray, frequent: np.ndarray, repeated: np.ndarray, percent: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each prefix shingle of the chosen texts that others may hold: its text, the shingle, its place in the order."""
    sizes = np.diff(ends)
    count = np.zeros(len(shingles), np.uint64)
    if frequent.shape[1]:
        at = np.minimum(np.searchsorted(frequent[0], shingles), frequent.shape[1] - 1)
        count = np.where(frequent[0][at] == shingles, frequent[1][at], np.uint64(0))
    low = np.flatnonzero(shingles < _LOW)
    kind = np.ones(len(shingles), np.uint64)
    kind[low] = 0
    kind[low[passes(repeated, shingles[low])]] = 2
    kind[count > 0] = 3
    alone = np.concatenate([[0], np.cumsum(kind == 0)])
    alone = alone[ends[1:]] - alone[ends[:-1]]
    length = sizes - -(-percent * sizes // 100) + 1
    order = kind << np.uint64(62) | np.minimum(count, np.uint64(0xFFFF)) << np.uint64(46) | shingles >> np.uint64(18)
    texts, keys, places = [], [], []
    for i in np.flatnonzero(chosen & (alone < length) & (sizes > 0)).tolist():
        a, b = ends[i], ends[i + 1]
        # equal keys keep the order of the full hashes
        own = np.argsort(order[a:b], kind="stable")[alone[i]:length[i]]
        texts.append(np.full(len(own), i))
        keys.append(shingles[a:b][own])
        places.append(np.arange(alone[i], length[i]))
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(texts), np.concatenate(keys), np.concatenate(places)


def similar_documents(
    docs: DataFrame, *, width: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: id, text_hash, n_shingles, component_id (the least id connected), root (one per component)."""
    spark = docs.sparkSession
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("text_hash"))

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            shingles, ends = distinct_sets(batch.column("text"), width)
            yield pa.record_batch(
                [batch.column("id"), batch.column("text_hash"), pa.array(node_ids(shingles, ends)), pa.array(np.diff(ends))],
                names=["id", "text_hash", "node", "n_shingles"],
            )

    kind = texts.schema["id"].dataType.simpleString()
    known = written(texts.mapInArrow(classes, f"id {kind}, text_hash bigint, node bigint, n_shingles bigint"), "sets")
    frequent = spark.sparkContext.broadcast(frequent_shingles(texts, width))
    repeated = spark.sparkContext.broadcast(repeated_shingles(texts, width))

    def first_look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            shingles, ends = distinct_sets(batch.column("text"), width)
            nodes = node_ids(shingles, ends)
            text, key, _ = prefixes(shingles, ends, own_rows(nodes), frequent.value, repeated.value, percent)
            yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(nodes[text])], names=["group", "node"])

    looked = texts.select("text").mapInArrow(first_look, "group bigint, node bigint")
    shared = looked.groupBy("group").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
    shared = spark.sparkContext.broadcast(key_filter(written(shared.select("group"), "shared-shingles"), "group"))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            shingles, ends = distinct_sets(batch.column("text"), width)
            nodes, sizes = node_ids(shingles, ends), np.diff(ends)
            text, key, place = prefixes(shingles, ends, own_rows(nodes), frequent.value, repeated.value, percent)
            keep = passes(shared.value, key)
            own = text[keep]
            bits = parities(shingles, ends)
            # the text's entry before this one, 0 for its first
            before = np.zeros(len(keep), np.uint64)
            before[1:] = np.where(own[1:] == own[:-1], key[keep][:-1], np.uint64(0))
            yield pa.record_batch(
                [pa.array(key[keep].view(np.int64)), pa.array(nodes[own]), pa.array(sizes[own].astype(np.int32)),
                 pa.array(place[keep].astype(np.int32)), pa.array(before.view(np.int64)), *[pa.array(b[own].view(np.int64)) for b in bits]],
                names=["group", "node", "n", "place", "before", *SKETCH],
            )

    schema = "group bigint, node bigint, n int, place int, before bigint, " + ", ".join(f"{c} bigint" for c in SKETCH)
    found = texts.select("text").mapInArrow(entries, schema)
    # copies in several batches give equal rows
    same = [F.max(c).alias(c) for c in ("n", "place", "before", *SKETCH)]
    members = written(found.groupBy("group", "node").agg(*same), "prefixes")

    def may_link(x: str, y: str) -> Column:
        nx, ny, px, py = (F.col(c) for c in (f"{x}n", f"{y}n", f"{x}place", f"{y}place"))
        # at most 1 and what is left of either after the shared shingle, if it is the first they share
        most = 1 + F.least(nx - px - 1, ny - py - 1)
        # an intersection of i is enough when (100 + percent) * i >= percent * (nx + ny); a later shared shingle has a
        # row of its own, and the first shared one always passes
        apart = sum(F.bit_count(F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}"))) for c in SKETCH)
        return (
            (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)) & ((100 + percent) * most >= percent * (nx + ny))
            & ((100 + percent) * apart <= (100 - percent) * (nx + ny))
        )

    def first_meeting(x: str, y: str) -> Column:
        # two nodes with the same entry before this one meet there already, and pass every filter there
        return (F.col(f"{x}before") != F.col(f"{y}before")) | (F.col(f"{x}before") == 0)

    def check(pairs: DataFrame) -> DataFrame:
        pairs = written(pairs, "pairs")
        return verified(pairs, _sets_of(texts, pairs, width), at_least(percent))

    roots = connect(members, ["n", "place", "before", *SKETCH], may_link, check, first_meeting)
    joined = known.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = joined.where("n_shingles > 0").groupBy("root").agg(F.min("id").alias("component_id"))
    out = joined.join(least, "root", "left").withColumn(
        "component_id", F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    )
    return out.select(F.col("id").alias(id_col), "text_hash", "n_shingles", "component_id", "root")


def _sets_of(texts: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """(node, items) of the nodes of the pairs."""
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "candidates")
    chosen = texts.sparkSession.sparkContext.broadcast(key_filter(wanted, "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            shingles, ends = distinct_sets(batch.column("text"), width)
            nodes = node_ids(shingles, ends)
            keep = passes(chosen.value, nodes.view(np.uint64))
            keep = keep[own_rows(nodes)[keep]]
            items = [shingles[ends[i]:ends[i + 1]].tobytes() for i in keep]
            yield pa.record_batch([pa.array(nodes[keep]), pa.array(items, pa.binary())], names=["node", "items"])

    found = texts.select("text").mapInArrow(run, "node bigint, items binary")
    return written(found.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "candidate-sets")
