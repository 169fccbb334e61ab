"""Passages that repeat across documents: paragraph MinHash banding.

Passages are pasted into the middle of lines, so paragraphs do not follow line breaks. A paragraph is a run of ``WORDS`` words
that begins at a content-defined place: one whose five-word shingle has the least hash among the ``STEP`` shingles around.
Any passage of ``WORDS + STEP + 4`` words or more found in two texts has a paragraph begin at the same place in both; with
``WORDS`` = 30 and ``STEP`` = 16 that is every passage of 50 words or more. Paragraphs overlap and cover what can repeat.

Paragraphs have MinHash signatures over their shingles, in ``BANDS`` bands of ``ROWS`` values, tuned for recall: two
paragraphs of Jaccard similarity 0.8 share a band with probability 0.95, equal ones always. Bands found in one text only
are left out by an aggregate and a filter of fixed size. Paragraphs of equal content are one class. Of the classes that share a
band, those whose sets of 256 bits differ in no more places than a similarity of ``PERCENT`` % allows for their numbers of shingles are verified by exact
Jaccard similarity through ``links.connect``, and its components are the clusters; a class that occurs only where another one
overlaps it is not linked with that one, as neighbours are not repeats; paragraphs moved by a few words that occur apart are.
In each cluster the first paragraph, by document id and place, is kept, and the words of the others that no kept paragraph
holds are removed.

Texts of fewer than ``WORDS`` words have no paragraphs. Null and empty texts have none. Rows are told apart by id and text, so a
row repeated exactly is one row here; a null id sorts last. Every paragraph of every text is compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..session import discard, written
from .chunks import slices
from .filters import key_filter, passes
from .links import at_least, connect, verified
from .tokens import mix, shingles_of, words_of

SHINGLE = 5
WORDS, STEP = 30, 16
BANDS, ROWS = 3, 2
BIT_WORDS = 4
SLICE = 1 << 20
PERCENT = 80
_START_BITS = 24  # of the place where a class occurs first
_MOVED = 4  # words by which overlapping paragraphs may be moved and still reach the similarity
_SIZE = WORDS - SHINGLE + 1  # shingles in a paragraph
# shingles that only one of two similar paragraphs may hold: their union has as many, at most, as one and half of these
_ALONE = int((100 - PERCENT) * _SIZE / (100 - (100 - PERCENT) / 2))
_SEEDS = [np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & ((1 << 64) - 1)) for k in range(BANDS * ROWS)]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values, by doubling."""
    have, out = 1, x
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


class Paragraphs:
    """All paragraphs of a batch of texts: where they begin, their bands and their content."""

    def __init__(self, column: pa.Array) -> None:
        words = words_of(column)
        self.words = words
        shingles, ends = shingles_of(words, SHINGLE, short_as_one=False)
        self.shingles = shingles
        sizes = np.diff(ends)
        text = np.repeat(np.arange(len(sizes)), sizes)
        room = np.arange(len(shingles)) + _SIZE <= np.repeat(ends[1:], sizes)
        order = mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
        # a place is chosen if it has the least hash of some run of STEP shingles within its text; of a row of equal
        # shingles, the first one
        chosen = np.zeros(len(shingles), bool)
        if len(shingles) >= STEP:
            low = sliding_min(order, STEP)
            low[text[:len(low)] != text[STEP - 1:]] = 0
            around = np.concatenate([np.zeros(STEP - 1, np.uint64), low, np.zeros(STEP - 1, np.uint64)])
            chosen = ~sliding_min(~around, STEP) == order
            chosen[1:] &= (order[1:] != order[:-1]) | (text[1:] != text[:-1])
        # a text shorter than a run begins one paragraph with its first shingle
        first = ends[:-1][(sizes >= _SIZE)]
        chosen[first] = True
        self.at = np.flatnonzero(chosen & room)
        self.text = text[self.at]
        self.start = (self.at - ends[:-1][self.text]).astype(np.int32)
        sums = np.zeros(len(shingles) + 1, np.uint64)
        np.cumsum(mix(shingles), out=sums[1:])
        self.content = mix(sums[self.at + _SIZE] - sums[self.at]) if len(self.at) else np.zeros(0, np.uint64)

    @cached_property
    def bands(self) -> np.ndarray:
        """One row per band, one column per paragraph."""
        bands = []
        for band in range(BANDS):
            key = np.full(len(self.at), band + 1, np.uint64)
            for row in range(ROWS):
                low = sliding_min(mix(self.shingles ^ _SEEDS[band * ROWS + row]), _SIZE)
                key = mix(key + low[self.at]) if len(low) else key
            bands.append(key)
        return np.stack(bands)

    def bits(self, keep: np.ndarray) -> list[np.ndarray]:
        """A set of bits for each paragraph, one bit by each shingle, as ``BIT_WORDS`` words of 64."""
        spread = mix(self.shingles)
        one = np.uint64(1) << (spread >> np.uint64(58))
        word = (spread >> np.uint64(40)) % np.uint64(BIT_WORDS)
        places = self.at[keep][:, None] + np.arange(_SIZE)[None]
        return [np.bitwise_or.reduce(np.where(word == k, one, np.uint64(0))[places], axis=1) for k in range(BIT_WORDS)]

    def distinct(self, keep: np.ndarray) -> np.ndarray:
        """How many different shingles each paragraph holds."""
        rows = np.sort(self.shingles[self.at[keep][:, None] + np.arange(_SIZE)[None]], axis=1)
        return (1 + (rows[:, 1:] != rows[:, :-1]).sum(axis=1)).astype(np.int16)

    def items(self, keep: np.ndarray) -> pa.Array:
        """The shingles of paragraphs in order, as bytes."""
        rows = np.ascontiguousarray(self.shingles[self.at[keep][:, None] + np.arange(_SIZE)[None]])
        offsets = np.arange(len(keep) + 1, dtype=np.int32) * (_SIZE * 8)
        return pa.Array.from_buffers(pa.binary(), len(keep), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def close(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two paragraphs are similar enough."""
    return at_least(PERCENT)(np.unique(x), np.unique(y))


def alone(both: Column) -> Column:
    """How many shingles only one of two similar paragraphs may hold, which have ``both`` different ones together.

    Twice their union is both and these; and these are odd in number where both are.
    """
    most = F.floor(both * (100 - PERCENT) / (100 + PERCENT)).cast("int")
    return most - F.pmod(both - most, F.lit(2))


def first_spelled(texts: DataFrame, members: DataFrame) -> DataFrame:
    """(node, items): the shingles of each class of ``members`` (node, occurs), from the place where it occurs first.

    ``texts``: text, place. Filters of fixed size choose texts and paragraphs, so a class of many copies is read once.
    """
    first = members.select("node", "occurs").distinct()
    key = F.xxhash64(F.shiftrightunsigned("place", _START_BITS)).alias("key")
    owners = first.select(F.col("occurs").alias("place")).select(key)
    spots = first.select(F.col("node").bitwiseXOR(F.col("occurs")).alias("key"))
    wanted = texts.sparkSession.sparkContext.broadcast((key_filter(owners, "key"), key_filter(spots, "key")))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.take(pa.array(np.sort(passes(wanted.value[0], batch.column("key").to_numpy().view(np.uint64)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(chosen(batches), "text", SLICE):
            found = Paragraphs(batch.column("text"))
            occurs = batch.column("place").to_numpy()[found.text] | (found.start.astype(np.int64) & ((1 << _START_BITS) - 1))
            keep = np.sort(passes(wanted.value[1], found.content ^ occurs.view(np.uint64)))
            yield pa.record_batch([pa.array(found.content[keep].view(np.int64)), found.items(keep)], names=["node", "items"])

    return texts.select("text", "place", key).mapInArrow(run, "node bigint, items binary").dropDuplicates(["node"])


def beside(places: DataFrame) -> DataFrame:
    """(a, b) with a < b: classes of which one occurs only where the other does too, moved by a few words.

    Every text that holds the one then holds the other, and equal paragraphs connect these texts. ``places``: id, text_hash,
    start, content.
    """
    spots = places.select("id", "text_hash", "start", "content").distinct()
    next_ones = Window.partitionBy("id", "text_hash").orderBy("start")
    after = F.array(*[F.lead(F.struct("start", "content"), k).over(next_ones) for k in range(1, _MOVED + 1)])
    near = spots.withColumn("next", after).withColumn("after", F.explode("next")).where(F.col("after.start") - F.col("start") <= _MOVED)
    near = near.where(F.col("after.content") != F.col("content"))
    spot = [F.xxhash64("id", "text_hash", s).alias("spot") for s in ("start", "after.start")]
    pairs = near.select(F.explode(F.array(
        F.struct(F.col("content").alias("x"), F.col("after.content").alias("y"), spot[0]),
        F.struct(F.col("after.content").alias("x"), F.col("content").alias("y"), spot[1]),
    )).alias("p")).select("p.*").distinct().groupBy("x", "y").agg(F.count("*").alias("met"))
    often = spots.groupBy(F.col("content").alias("x")).agg(F.count("*").alias("n"))
    always = pairs.join(often, "x").where(F.col("met") == F.col("n"))
    return always.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def repeated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per paragraph of a cluster of two or more: id, text_hash, start (word), n_words, cluster, kept."""
    spark = docs.sparkSession
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("text_hash"))
    kind = texts.schema["id"].dataType.simpleString()

    def first_look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            found = Paragraphs(batch.column("text"))
            owner = np.tile(batch.column("row").to_numpy()[found.text], BANDS)
            flat = found.bands.ravel()
            order = np.lexsort((owner, flat))
            flat, owner = flat[order], owner[order]
            # the least and the greatest text of each band, one row for each band of the batch
            first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, int)
            last = np.concatenate([first[1:], [len(flat)]])[:len(first)] - 1
            yield pa.record_batch([pa.array(flat[first].view(np.int64)), pa.array(owner[first]), pa.array(owner[last])], names=["band", "low", "high"])

    owned = texts.select("text", F.hash("id", "text_hash").alias("row"))
    looked = owned.mapInArrow(first_look, "band bigint, low int, high int")
    shared = looked.groupBy("band").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low != high").select("band")
    shared = written(shared, "shared-bands")
    wanted = spark.sparkContext.broadcast(key_filter(shared, "band"))
    discard(shared)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            found = Paragraphs(batch.column("text"))
            keep = np.unique(passes(wanted.value, found.bands.ravel()) % max(len(found.at), 1))
            rows = batch.select(["id", "text_hash"]).take(pa.array(found.text[keep]))
            yield pa.record_batch([
                rows.column("id"), rows.column("text_hash"), pa.array(found.start[keep]), pa.array(found.content[keep].view(np.int64)),
                pa.array(found.distinct(keep)), *[pa.array(word.view(np.int64)) for word in found.bits(keep)], *[pa.array(band[keep].view(np.int64)) for band in found.bands],
            ], names=["id", "text_hash", "start", "content", "distinct", *bits, *names])

    names, bits = [f"band{k}" for k in range(BANDS)], [f"bits{k}" for k in range(BIT_WORDS)]
    schema = f"id {kind}, text_hash bigint, start int, content bigint, distinct smallint, " + ", ".join(f"{name} bigint" for name in [*bits, *names])
    places = written(texts.mapInArrow(candidates, schema), "paragraphs")
    # a class is placed where its first text, by a hash, has it: one that occurs there alone is no repeat of what overlaps it
    place = F.shiftleft(F.xxhash64("id", "text_hash").bitwiseAND((1 << 39) - 1), _START_BITS)
    occurs = place.bitwiseOR(F.col("start").cast("bigint").bitwiseAND((1 << _START_BITS) - 1))
    # equal paragraphs have equal bands
    classes = places.groupBy(F.col("content").alias("node")).agg(
        F.min(occurs).alias("occurs"), (F.min(occurs) != F.max(occurs)).alias("many"), *[F.min(name).alias(name) for name in ("distinct", *bits, *names)],
    )
    all_members = written(classes.select(F.explode(F.array(*names)).alias("group"), "node", "occurs", "many", "distinct", *bits), "paragraph-classes")
    several = all_members.groupBy("group").agg(
        F.min("occurs").alias("low"), F.max("occurs").alias("high"), F.count_if("many").alias("many"),
    ).where((F.col("high") - F.col("low") >= WORDS) | (F.col("many") > 1))
    members = written(all_members.join(several.select("group"), "group", "left_semi"), "bands")
    discard(all_members)

    spelled = written(first_spelled(texts.select("text", place.alias("place")), members), "paragraph-items")
    neighbours = written(beside(places), "neighbours")

    def may_link(x: str, y: str) -> Column:
        # a bit that differs is of a shingle that one of the two alone holds, so no similar pair is lost
        differ = reduce(add, [F.bit_count(F.col(x + word).bitwiseXOR(F.col(y + word))) for word in bits])
        return (differ <= alone(F.col(f"{x}distinct").cast("int") + F.col(f"{y}distinct"))) & apart(x, y)

    def apart(x: str, y: str) -> Column:
        return (F.abs(F.col(f"{x}occurs") - F.col(f"{y}occurs")) >= WORDS) | (F.col(f"{x}many") & F.col(f"{y}many"))

    def check(pairs: DataFrame) -> DataFrame:
        pairs = pairs.join(neighbours, ["a", "b"], "left_anti")
        return verified(written(pairs, "pairs"), spelled, close)

    roots = connect(members, ["occurs", "many", "distinct", *bits], may_link, check)
    discard(members, spelled, neighbours)
    rows = places.select("id", "text_hash", "start", F.col("content").alias("node")).distinct()
    rows = rows.join(roots, "node", "left").withColumn("cluster", F.coalesce("root", "node"))
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "text_hash", "start")
    clusters = rows.groupBy("cluster").agg(F.count("*").alias("n"), F.min(order).alias("first")).where("n > 1")
    kept = order == F.col("first")
    found = rows.join(clusters, "cluster")
    return found.select(
        F.col("id").alias(id_col), "text_hash", "start", F.lit(WORDS).alias("n_words"), "cluster", kept.alias("kept"),
    )


def removals(found: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """(id, text_hash, first_word, n_words): runs of words to remove, of paragraphs that are not kept, joined where they meet.

    Words that a kept paragraph of the same text holds stay.
    """
    def run(cells: pd.DataFrame) -> pd.DataFrame:
        spans: list[list[int]] = []
        for start in sorted(cells.loc[~cells["kept"], "start"]):
            if spans and start <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], start + WORDS)
            else:
                spans.append([start, start + WORDS])
        for start in sorted(cells.loc[cells["kept"], "start"]):
            cut = []
            for a, b in spans:
                cut += [s for s in ([a, min(b, start)], [max(a, start + WORDS), b]) if s[0] < s[1]]
            spans = cut
        head = cells.iloc[0]
        return pd.DataFrame({"id": [head["id"]] * len(spans), "text_hash": [head["text_hash"]] * len(spans),
                             "first_word": [s[0] for s in spans], "n_words": [s[1] - s[0] for s in spans]})

    kind = found.schema[id_col].dataType.simpleString()
    rows = found.select(found[id_col].alias("id"), "text_hash", "start", "kept")
    out = rows.groupBy("id", "text_hash").applyInPandas(run, f"id {kind}, text_hash bigint, first_word int, n_words int")
    return out.withColumnRenamed("id", id_col)
