"""Vectors of equal label with a cosine of at least a threshold: PCA-ordered tiled comparison, exact.

Equal vectors of a label are one class first, so copies are never compared. Classes are turned to the principal axes of all
unit vectors (second moments summed over every row). Vectors within the threshold are at most ``sqrt(2 - 2 t)`` apart, along
any axis too; so classes lie in cells of that width along the two leading axes, and only neighbouring cells are compared. A
cell of many classes is cut into blocks by a hash, and a tile is a pair of blocks: no task gets more than two blocks.

In a tile, products accumulate over the leading axes first; what the rest can add is bounded by the product of the suffix
norms. Rows and columns without a partner that can still reach the threshold drop out, and the tile stops when none is left.
Pairs that stay are decided in the given coordinates in double precision. A tile returns a count of links for each class and
one edge per class to the least class it is connected with in the tile, not the pairs. The blocks of a cell that holds m
classes are all compared: m^2 / 2 products, which exact counts of links need.

Vectors link only within a label and dimension. Null labels and vectors that are null, empty, zero, or hold null or
non-finite components link with nothing and are components of their own. Repeated rows link with each other. A null id has
no component id and counts as a link of others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import written
from .components import components

BLOCK = 2_048
THRESHOLD = 0.98
MOST_AXES = 1_024  # of more dimensions, the first are turned and the rest kept as they are
_SLACK = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one dimension as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def axes_of(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension, the principal axes of its unit vectors as columns, the leading first."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            for d in np.unique(sizes):
                x = _unit(_matrix(batch.column("embedding").take(pa.array(np.flatnonzero(sizes == d)))))[:, :MOST_AXES]
                sums[int(d)] = sums.get(int(d), 0) + x.T @ x
        for d, s in sums.items():
            yield pa.record_batch([pa.array(np.full(s.size, d, np.int32)), pa.array(np.arange(s.size, dtype=np.int32)), pa.array(s.ravel())], names=["dim", "place", "value"])

    total = vectors.select("dim", "embedding").mapInArrow(moments, "dim int, place int, value double")
    found = total.groupBy("dim", "place").agg(F.sum("value").alias("value")).toPandas()
    out = {}
    for d, part in found.groupby("dim"):
        side = min(int(d), MOST_AXES)
        s = np.zeros(side * side)
        s[part["place"]] = part["value"]
        out[int(d)] = np.linalg.eigh(s.reshape(side, side))[1][:, ::-1]
    return out


def turned(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    side = len(axes)
    return np.concatenate([x[:, :side] @ axes, x[:, side:]], axis=1)


def tile_links(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the linked pairs of two blocks; of a block with itself, each pair both ways, and all with themselves."""
    u, v = turned(_unit(x), axes), turned(_unit(y), axes)
    rows, cols = np.arange(len(u)), np.arange(len(v))
    done, step, sums = 0, 8, np.zeros((len(u), len(v)))
    while done < u.shape[1]:
        to = min(done + step, u.shape[1])
        sums += u[rows, done:to] @ v[cols, done:to].T
        rest_u = np.linalg.norm(u[rows, to:], axis=1)
        rest_v = np.linalg.norm(v[cols, to:], axis=1)
        may = sums + np.outer(rest_u, rest_v) >= threshold - _SLACK
        done, step = to, step * 2
        keep_r, keep_c = may.any(axis=1), may.any(axis=0)
        if not keep_r.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows, cols, sums = rows[keep_r], cols[keep_c], sums[np.ix_(keep_r, keep_c)]
    a, b = np.nonzero(sums >= threshold - _SLACK)
    a, b = rows[a], cols[b]
    # those at the threshold are decided in the given coordinates
    near = np.flatnonzero(np.abs(_dots(u, v, a, b) - threshold) < 1e-6)
    ok = np.ones(len(a), bool)
    for k in near:
        p, q = x[a[k]], y[b[k]]
        ok[k] = float(p @ q) / (float(np.sqrt(p @ p)) * float(np.sqrt(q @ q))) >= threshold
    return a[ok], b[ok]


def _dots(u: np.ndarray, v: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros(len(a))
    for at in range(0, len(a), 65536):
        to = at + 65536
        out[at:to] = np.einsum("ij,ij->i", u[a[at:to]], v[b[at:to]])
    return out


def least_connected(n: int, a: np.ndarray, b: np.ndarray, names: np.ndarray) -> np.ndarray:
    """For each of ``n`` members, the least name among those it is connected with by the pairs."""
    names = names.copy()
    while True:
        low = np.minimum(names[a], names[b])
        new = names.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == names).all():
            return names
        names = new


def links(vectors: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: id, n_links (other vectors linked directly), component_id (the least id connected), kept."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors[id_col].alias("id"), vectors[label_col].alias("label"), vectors[vector_col].cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("label").isNotNull() & (F.size("embedding") > 0) & fine & F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    # -0.0 and 0.0 are one value
    plain = F.transform("embedding", lambda x: x + F.lit(0.0))
    rows = rows.withColumn("embedding", F.when(usable, plain)).withColumn("class", F.when(usable, F.xxhash64("label", "embedding")))
    rows = written(rows, "vectors")
    classes = rows.where("class is not null").groupBy("class", "label", "embedding").agg(F.count("*").alias("n")).withColumn("dim", F.size("embedding"))
    classes = written(classes, "classes")
    axes = spark.sparkContext.broadcast(axes_of(classes))
    width = float(np.sqrt(2 - 2 * threshold)) * (1 + 1e-9) + 1e-9

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            cell = np.zeros((2, batch.num_rows), np.int32)
            for d in np.unique(sizes):
                own = np.flatnonzero(sizes == d)
                y = turned(_unit(_matrix(batch.column("embedding").take(pa.array(own)))), axes.value[int(d)])[:, :2]
                cell[:y.shape[1], own] = np.floor(y / width).astype(np.int32).T
            yield pa.record_batch([*batch.columns, pa.array(cell[0]), pa.array(cell[1])], names=[*batch.schema.names, "c0", "c1"])

    label_kind = classes.schema["label"].dataType.simpleString()
    placed = classes.select("class", "label", "embedding", "n", "dim").mapInArrow(
        place, f"class bigint, label {label_kind}, embedding array<double>, n bigint, dim int, c0 int, c1 int")
    placed = written(placed, "placed")
    home = ["label", "dim", "c0", "c1"]
    cells = placed.groupBy(*home).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    near = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))]))
    ahead = cells.select(*home, F.col("blocks"), near.alias("o"))
    ahead = ahead.select("label", "dim", "c0", "c1", "blocks", (F.col("c0") + F.col("o.dx")).alias("d0"), (F.col("c1") + F.col("o.dy")).alias("d1"))
    other = cells.select("label", "dim", F.col("c0").alias("d0"), F.col("c1").alias("d1"), F.col("blocks").alias("other_blocks"))
    pairs = written(ahead.join(other, ["label", "dim", "d0", "d1"]), "cell-pairs")
    same = (F.col("c0") == F.col("d0")) & (F.col("c1") == F.col("d1"))

    def dealt(side: int) -> DataFrame:
        # a class of block i of a cell goes to the tiles (i, j) on one side and (j, i) on the other
        mine, theirs = ("blocks", "other_blocks") if side == 0 else ("other_blocks", "blocks")
        own = placed if side == 0 else placed.withColumnsRenamed({"c0": "d0", "c1": "d1"})
        keys = home if side == 0 else ["label", "dim", "d0", "d1"]
        met = own.join(pairs, keys).withColumn("own", F.expr(f"cast(pmod(xxhash64(class), {mine}) as int)"))
        low = F.when(same, F.col("own")).otherwise(0) if side == 0 else F.lit(0)
        high = F.col(theirs) - 1 if side == 0 else F.when(same, F.col("own") - 1).otherwise(F.col(theirs) - 1)
        met = met.where(low <= high).withColumn("partner", F.explode(F.sequence(low, high)))
        first, second = ("own", "partner") if side == 0 else ("partner", "own")
        tile = F.struct("label", "dim", "c0", "c1", "d0", "d1", F.col(first).alias("i"), F.col(second).alias("j"))
        alone = same & (F.col(first) == F.col(second))
        return met.select(tile.alias("tile"), F.lit(side).alias("side"), alone.alias("alone"), "class", "n", "dim", "embedding")

    def compare(table: pa.Table) -> pa.Table:
        sides = table["side"].to_numpy()
        names, counts = table["class"].to_numpy(), table["n"].to_numpy()
        x = _matrix(table["embedding"].combine_chunks())
        d = int(table["dim"][0].as_py())
        left = np.flatnonzero(sides == 0)
        right = left if table["alone"][0].as_py() else np.flatnonzero(sides == 1)
        a, b = tile_links(x[left], x[right], axes.value[d], threshold) if len(left) and len(right) else (np.zeros(0, int), np.zeros(0, int))
        a, b = left[a], right[b]
        a, b = a[a != b], b[a != b]
        met = np.bincount(a, counts[b], len(names))
        if right is not left:
            met += np.bincount(b, counts[a], len(names))
        touched = np.flatnonzero(met > 0)
        roots = least_connected(len(names), a, b, names)
        return pa.table({"class": names[touched], "links": met[touched].astype(np.int64), "root": roots[touched]})

    tiles = dealt(0).unionByName(dealt(1))
    met = written(tiles.groupBy("tile").applyInArrow(compare, "class bigint, links bigint, root bigint"), "tile-links")
    roots = components(met.select(F.col("class").alias("a"), F.col("root").alias("b")))
    counted = met.groupBy("class").agg(F.sum("links").alias("links"))
    joined = (
        rows.select("id", "class").join(classes.select("class", "n"), "class", "left").join(counted, "class", "left")
        .join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    )
    joined = written(joined, "linked")
    least = joined.where("root is not null").groupBy("root").agg(F.min("id").alias("component"))
    out = joined.join(least, "root", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(id_col), (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("n") - 1, F.lit(0))).alias("n_links"),
        component.alias("component_id"), (F.col("id") == component).alias("kept"),
    )
