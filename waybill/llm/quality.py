"""Quality of whole texts by a convolutional network over bytes.

A text is cut into chunks of ``CHUNK`` bytes that overlap, the last reaching past its end. Learned filters of ``WIDTH`` bytes
slide over all of it, two bytes at a step; each filter's maximum in a chunk, at least zero, passes a hidden layer to one
value per chunk, and the mean over all chunks becomes one probability. A filter holds one number per byte value and place,
so it is scored as gathers from tables of byte pairs. Trained in numpy by adaptive gradients on a bounded sample of labelled
texts (``SAMPLE_ROWS`` of each label, of at most ``SAMPLE_CHARS`` characters, those of smallest hash of
id and text).

Null and empty texts are scored as blank bytes. Labels that are null, or whose id is null, are not learned from; an id
labelled more than once counts once, by its lesser label. Rows come back one to one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import written
from .chunks import numbered, slices
from .sampling import hashed_sample
from .tokens import bytes_of

SEGMENT = 64  # bytes between the starts of two steps of the maximum
CHUNK, HOP = 4, 3  # segments in a chunk, and from one to the next
WIDTH = 8
FILTERS, HIDDEN = 16, 8
SAMPLE_ROWS = 1_500
SAMPLE_CHARS = 12_000
SLICE = 1 << 18


def padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes, each filled up with zeros to whole segments, and the segments each begins at."""
    data, ends = bytes_of(column)
    sizes = np.diff(ends)
    segments = np.zeros(len(ends), np.int64)
    np.cumsum(sizes // SEGMENT + 1, out=segments[1:])
    out = np.zeros(int(segments[-1]) * SEGMENT + WIDTH, np.uint8)
    place = np.arange(len(data)) + np.repeat(segments[:-1] * SEGMENT - ends[:-1], sizes)
    out[place] = data
    return out, segments


def chunk_edges(segments: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last segment of every chunk, and the first chunk of every text."""
    sizes = np.diff(segments)
    counts = np.maximum(-(-(sizes - CHUNK) // HOP), 0) + 1
    chunks = np.zeros(len(segments), np.int64)
    np.cumsum(counts, out=chunks[1:])
    within = np.arange(int(chunks[-1])) - np.repeat(chunks[:-1], counts)
    first = np.repeat(segments[:-1], counts) + within * HOP
    return first, np.minimum(first + CHUNK, np.repeat(segments[1:], counts)) - 1, chunks


@dataclass
class Network:
    filters: np.ndarray  # WIDTH x 256 x FILTERS
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        return cls(
            rng.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32),
            rng.normal(0, 0.4, (FILTERS, HIDDEN)).astype(np.float32), np.full(HIDDEN, 0.1, np.float32),
            rng.normal(0, 0.4, HIDDEN).astype(np.float32), np.zeros(1, np.float32),
        )

    def pair_tables(self) -> list[np.ndarray]:
        """For each two places: one row per pair of bytes, the first the high one."""
        return [(self.filters[j][:, None] + self.filters[j + 1][None]).reshape(65536, FILTERS) for j in range(0, WIDTH, 2)]

    def responses(self, data: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        pairs = data[0::2].astype(np.int32) * 256 + data[1::2]
        n = (len(data) - WIDTH) // 2
        r = tables[0][pairs[:n]]
        for j in range(1, len(tables)):
            r += tables[j][pairs[j:n + j]]
        return r

    def head(self, pooled: np.ndarray, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(pooled @ self.inner + self.inner_bias)
        values = hidden @ self.outer
        mean = np.add.reduceat(values, chunks[:-1]) / np.diff(chunks)
        return hidden, 1 / (1 + np.exp(-np.clip(mean + self.bias[0], -30, 30)))

    def score(self, column: pa.Array, tables: list[np.ndarray]) -> np.ndarray:
        data, segments = padded(column)
        r = self.responses(data, tables)
        steps = np.maximum(r.reshape(-1, SEGMENT // 2, FILTERS).max(axis=1), 0)
        first, last, chunks = chunk_edges(segments)
        pooled = steps[first]
        for k in range(1, CHUNK):
            np.maximum(pooled, steps[np.minimum(first + k, last)], out=pooled)
        return self.head(pooled, chunks)[1].astype(np.float64)


def fit(texts: list[bytes], labels: np.ndarray, *, epochs: int = 6, batch: int = 32, rate: float = 0.05, seed: int = 3) -> Network:
    net = Network.fresh(seed)
    rng = np.random.default_rng(seed)
    params = [net.filters, net.inner, net.inner_bias, net.outer, net.bias]
    seen = [np.full_like(p, 1e-2) for p in params]
    share = min(max(float(labels.mean()), 1e-3), 1 - 1e-3)
    weight = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            chosen = order[at:at + batch]
            data, segments = padded(pa.array([texts[i] for i in chosen], pa.binary()))
            r = net.responses(data, net.pair_tables())
            per = SEGMENT // 2
            steps = r.reshape(-1, per, FILTERS)
            where = steps.argmax(axis=1) + np.arange(len(steps))[:, None] * per
            steps = steps.max(axis=1)
            first, last, chunks = chunk_edges(segments)
            pooled, peak = steps[first].copy(), where[first].copy()
            for k in range(1, CHUNK):
                other = np.minimum(first + k, last)
                better = steps[other] > pooled
                pooled = np.where(better, steps[other], pooled)
                peak = np.where(better, where[other], peak)
            live = pooled > 0
            pooled = np.maximum(pooled, 0)
            hidden, p = net.head(pooled, chunks)
            g = ((p - labels[chosen]) * weight[chosen] / len(chosen)).astype(np.float32)
            counts = np.diff(chunks)
            per_chunk = np.repeat(g / counts, counts).astype(np.float32)
            d_inner = per_chunk[:, None] * net.outer[None] * (1 - hidden**2)
            d_pooled = (d_inner @ net.inner.T) * live
            d_filters = np.zeros_like(net.filters)
            for j in range(WIDTH):
                byte = data[2 * peak + j]
                slot = byte.astype(np.int64) * FILTERS + np.arange(FILTERS)[None]
                d_filters[j] = np.bincount(slot.ravel(), d_pooled.ravel(), 256 * FILTERS).reshape(256, FILTERS)
            grads = [d_filters, pooled.T @ d_inner, d_inner.sum(axis=0), hidden.T @ per_chunk, np.array([g.sum()])]
            for x, s, d in zip(params, seen, grads):
                s += d**2
                x -= (rate * d / np.sqrt(s)).astype(np.float32)
    return net


def train(docs: DataFrame, labels: DataFrame, learn: Column, *, label: str = "quality", rows: int = SAMPLE_ROWS) -> Network:
    """``learn`` says, of ``doc_id``, whose labels may be learned from. Without both labels, every text is of that one."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("label"))
    known = known.where(learn)
    parts = [hashed_sample(known.where(F.col("label") == x), "doc_id", rows) for x in (0, 1)]
    texts = docs.where(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text")
    # an id may have many rows
    chosen = written(texts.join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id"), "labelled")
    parts = [hashed_sample(chosen.where(F.col("label") == x), "doc_id", rows, "text") for x in (0, 1)]
    found = parts[0].unionByName(parts[1]).toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    y = found["label"].to_numpy().astype(np.float32)
    if not len(y) or y.min() == y.max():
        net = Network.fresh(0)
        net.outer[:] = 0
        net.bias[:] = 3.0 if not len(y) or y.max() > 0 else -3.0
        return net
    return fit([t.encode() for t in found["text"].to_pylist()], y)


def score(docs: DataFrame, net: Network, *, text_col: str = "text", into: str = "quality_score") -> DataFrame:
    """The rows with a column of the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows, names = numbered(docs)
    text = names[text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        tables = own.pair_tables()
        for batch in slices(batches, text, SLICE):
            yield batch.append_column("score", pa.array(own.score(batch.column(text), tables), pa.float64()))

    scored = rows.mapInArrow(run, StructType([*rows.schema, StructField("score", DoubleType())]))
    return scored.select(*[F.col(n).alias(c) for c, n in names.items() if c != into], F.col("score").alias(into))
