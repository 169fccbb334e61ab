"""Passages of a benchmark in documents, by spaced seeds.

A seed is a hash of the words that a fixed mask selects from a run of words; the positions it ignores may differ. Seeds of the
documents that pass a filter of the benchmark's seeds (``filters``: of fixed size at most) are joined with those by equality.
Around each hit, document and item are laid on each other with the words of the hit aligned, and the longest stretch with at
least ``SHARE`` equal words is an overlap if it has ``LEAST_WORDS`` words, or all words of a shorter item.

Words are runs of anything but ASCII white space, A-Z as a-z. Items of fewer words than a mask spans cannot be hit. Null and
empty texts overlap with nothing. Repeated rows give one result per distinct id and text. The benchmark's seeds and items are
broadcast up to a counted size, and joined by shuffles beyond it. What leaves a document for the join is the hits and the
words within the longest item's length around them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import written
from .chunks import slices
from .filters import key_filter, passes
from .tokens import Words, mix, words_of

# fixed values: the masks; 1 is a word that counts
MASKS = ("1101011", "1011101", "111011")
SHARE = 0.8
LEAST_WORDS = 13
BROADCAST_SEEDS, BROADCAST_WORDS = 400_000, 2_000_000


def seeds_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places (in all words) and hashes of every seed that stays within its text."""
    places, hashes = [], []
    sizes = np.diff(words.offsets)
    for k, mask in enumerate(MASKS):
        full = len(words.hashes) - len(mask) + 1
        if full <= 0:
            continue
        acc = np.full(full, k + 1, np.uint64)
        for j, c in enumerate(mask):
            if c == "1":
                acc = mix(acc + words.hashes[j:j + full])
        inside = np.arange(full) + len(mask) <= np.repeat(words.offsets[1:], sizes)[:full]
        places.append(np.flatnonzero(inside))
        hashes.append(acc[inside])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(places), np.concatenate(hashes)


def longest_stretch(doc: np.ndarray, item: np.ndarray, shift: int, share: float, least: int) -> tuple[int, int, int] | None:
    """Start in the item, words and equal words of the longest stretch, item place 0 lying on document place ``shift``."""
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    if high - low < min(least, len(item)):
        return None
    equal = doc[low + shift:high + shift] == item[low:high]
    unit = round(share * 1000)
    sums = np.concatenate([[0], np.cumsum(np.where(equal, 1000 - unit, -unit))])
    # the first place from which the sum has not fallen, for every end
    lowest = np.minimum.accumulate(sums)
    start = np.searchsorted(-lowest, -sums, side="left")
    end = int(np.argmax(np.arange(len(sums)) - start))
    a, b = int(start[end]), end
    while a < b and not equal[a]:
        a += 1
    while b > a and not equal[b - 1]:
        b -= 1
    if b - a < min(least, len(item)):
        return None
    return low + a, b - a, int(equal[a:b].sum())


def overlaps(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", share: float = SHARE, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """One row per document and item that overlap: id, text_hash, item, doc_start, item_start, n_words, n_equal (longest)."""
    spark = docs.sparkSession
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("text_hash"))
    tests = benchmark.select(benchmark[item_col].alias("item"), benchmark[item_text].alias("text")).where("text is not null").distinct()
    tests = tests.withColumn("key", F.xxhash64("item", "text"))
    doc_kind, item_kind = (f.schema[c].dataType.simpleString() for f, c in ((texts, "id"), (tests, "item")))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = words_of(batch.column("text"))
            place, seed = seeds_of(words)
            owner = np.searchsorted(words.offsets, place, side="right") - 1
            rows = range(batch.num_rows)
            own = [np.flatnonzero(owner == i) for i in rows]
            yield pa.record_batch([
                batch.column("item"), batch.column("key"),
                pa.array([words.hashes[words.offsets[i]:words.offsets[i + 1]].tobytes() for i in rows], pa.binary()),
                pa.array([seed[o].view(np.int64) for o in own], pa.list_(pa.int64())),
                pa.array([(place[o] - words.offsets[i]).astype(np.int32) for i, o in zip(rows, own)], pa.list_(pa.int32())),
            ], names=["item", "key", "item_words", "seeds", "places"])

    items = written(tests.mapInArrow(prepare, f"item {item_kind}, key bigint, item_words binary, seeds array<bigint>, places array<int>"), "items")
    size = items.agg(F.sum(F.size("seeds")).alias("seeds"), F.sum(F.length("item_words")).alias("bytes"), F.max(F.length("item_words")).alias("longest")).head()
    reach = (size.longest or 0) // 8
    test_seeds = items.select("key", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select("key", F.col("s.seeds").alias("seed"), F.col("s.places").alias("item_place"))
    wanted = spark.sparkContext.broadcast(key_filter(test_seeds, "seed"))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = words_of(batch.column("text"))
            place, seed = seeds_of(words)
            found = passes(wanted.value, seed)
            place, seed = place[found], seed[found]
            order = np.argsort(place, kind="stable")
            place, seed = place[order], seed[order]
            owner = np.searchsorted(words.offsets, place, side="right") - 1
            # hits whose surroundings meet go together
            apart = np.flatnonzero((np.diff(owner) > 0) | (np.diff(place) > 2 * reach)) + 1
            rows, start, own, lists, at = [], [], [], [], []
            for a, b in zip([0, *apart], [*apart, len(place)]) if len(place) else []:
                i = int(owner[a])
                low = max(int(place[a]) - reach, int(words.offsets[i]))
                high = min(int(place[b - 1]) + reach + 8, int(words.offsets[i + 1]))
                rows.append(i)
                start.append(low - int(words.offsets[i]))
                own.append(words.hashes[low:high].tobytes())
                lists.append(seed[a:b].view(np.int64))
                at.append((place[a:b] - low).astype(np.int32))
            chosen = batch.select(["id", "text_hash"]).take(pa.array(rows, pa.int64()))
            yield pa.record_batch([
                chosen.column("id"), chosen.column("text_hash"), pa.array(start, pa.int32()), pa.array(own, pa.binary()),
                pa.array(lists, pa.list_(pa.int64())), pa.array(at, pa.list_(pa.int32())),
            ], names=["id", "text_hash", "start", "doc_words", "seeds", "places"])

    near = texts.mapInArrow(hits, f"id {doc_kind}, text_hash bigint, start int, doc_words binary, seeds array<bigint>, places array<int>")
    near = written(near.withColumn("part", F.xxhash64("id", "text_hash", "start")).dropDuplicates(["part"]), "hits")
    doc_seeds = near.select("part", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select("part", F.col("s.seeds").alias("seed"), (F.col("s.places")).alias("place"))
    small = F.broadcast if (size.seeds or 0) <= BROADCAST_SEEDS else (lambda f: f)
    laid = doc_seeds.join(small(test_seeds), "seed").select("part", "key", (F.col("place") - F.col("item_place")).alias("shift")).distinct()
    few = F.broadcast if (size.bytes or 0) <= 8 * BROADCAST_WORDS else (lambda f: f)
    pairs = laid.join(near.drop("seeds", "places"), "part").join(few(items.select("key", "item", "item_words")), "key")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, out = [], []
            for i in range(batch.num_rows):
                doc = np.frombuffer(batch.column("doc_words")[i].as_buffer(), np.uint64)
                item = np.frombuffer(batch.column("item_words")[i].as_buffer(), np.uint64)
                shift = batch.column("shift")[i].as_py()
                stretch = longest_stretch(doc, item, shift, share, least_words)
                if stretch:
                    keep.append(i)
                    out.append((stretch[0] + shift + batch.column("start")[i].as_py(), *stretch))
            kept = batch.select(["id", "text_hash", "item"]).take(pa.array(keep, pa.int64()))
            numbers = [pa.array([r[k] for r in out], pa.int32()) for k in range(4)]
            yield pa.record_batch([kept.column("id"), kept.column("text_hash"), kept.column("item"), *numbers],
                                  names=["id", "text_hash", "item", "doc_start", "item_start", "n_words", "n_equal"])

    kinds = f"id {doc_kind}, text_hash bigint, item {item_kind}, doc_start int, item_start int, n_words int, n_equal int"
    found = pairs.select("id", "text_hash", "start", "doc_words", "item", "item_words", "shift").mapInArrow(verify, kinds)
    best = F.max(F.struct("n_words", "n_equal", (-F.col("doc_start")).alias("first"), (-F.col("item_start")).alias("at"))).alias("best")
    return found.groupBy("id", "text_hash", "item").agg(best).select(
        F.col("id").alias(id_col), "text_hash", F.col("item").alias(item_col), (-F.col("best.first")).alias("doc_start"),
        (-F.col("best.at")).alias("item_start"), "best.n_words", "best.n_equal",
    )
