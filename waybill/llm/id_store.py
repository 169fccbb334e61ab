"""Token ids in compressed files with an index: a shared zstandard dictionary, one frame per document.

A store is a folder of Parquet files. ``dictionary`` holds the dictionary, its SHA-256 and its parameters. ``blocks`` holds
rows of about a megabyte: a payload of concatenated frames, and beside it, readable without the payload, the documents' ids,
their offsets in the payload, numbers of token ids and the ids before them in their shard. Blocks carry the least and
greatest document id, so a single short document is found by pruned columns and read with one block.

Documents are dealt by ranges of id; shards are numbered in that order. Ties of id are ordered by a hash of the text. The
dictionary is fitted to about ``DICTIONARY_DOCS`` documents of at most ``DICTIONARY_CHARS`` characters, those of smallest
hash of id and text; everything is stored whatever the dictionary. Null and empty texts hold the end id alone; a null id sorts first.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from .chunks import slices
from .sampling import hashed_sample
from .tokens import words_of

DICTIONARY_DOCS = 1_500
DICTIONARY_CHARS = 20_000
DICTIONARY_BYTES = 64 << 10
BLOCK_BYTES = 1 << 20
SLICE = 4 << 20
TABLE_WORDS = 1_500_000
LEVEL = 3

_BLOCK = ("shard int, block int, least bigint, greatest bigint, doc_ids array<bigint>, n_tokens array<int>, "
          "starts array<bigint>, offsets array<int>, dictionary_sha256 string, payload binary")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class WordTable:
    """Ids of distinct words between ASCII white space, kept as arrays and looked up many words at a time.

    The tokenizer folds case, drops white space and never merges across it, so a word is segmented once however its ASCII
    letters are written. Words are known by two 64-bit hashes. At ``TABLE_WORDS`` the table starts anew. Texts that may
    spell a special token go through the library whole.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = tokenizer(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.separator = special[0]
        self.separator_id = self.tokenizer.token_to_id(self.separator)
        self.opening = os.path.commonprefix(special).encode()
        probe = self.tokenizer.encode(f"Ab {self.separator} c\td", add_special_tokens=False).ids
        parts = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in ("ab", "c", "d")]
        if not self.opening or probe != [*parts[0], self.separator_id, *parts[1], *parts[2]]:
            raise ValueError("the tokenizer does not treat words apart")
        self.empty()

    def empty(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in order, and how many each has."""
        between = f" {self.separator} "
        ids, sizes = [], []
        joined = [between.join(words[i:i + 500]) for i in range(0, len(words), 500)]
        for found in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            every = np.array(found.ids, np.uint32)
            own = every != self.separator_id
            cuts = np.flatnonzero(~own)
            sizes.append(np.diff(np.concatenate([[-1], cuts, [len(every)]])) - 1)
            ids.append(every[own])
        return np.concatenate(ids), np.concatenate(sizes)

    def add(self, keys: np.ndarray, checks: np.ndarray, words: list[str]) -> None:
        if len(self.keys) + len(keys) > TABLE_WORDS:
            self.empty()
        ids, sizes = self.segment(words)
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        self.flat = np.concatenate([self.flat, ids])
        order = np.argsort(keys)
        to = np.searchsorted(self.keys, keys[order])
        for name, new in (("keys", keys), ("checks", checks), ("starts", starts), ("sizes", sizes)):
            setattr(self, name, np.insert(getattr(self, name), to, new[order]))

    def place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return at, (self.keys[at] == keys) if len(self.keys) else np.zeros(len(keys), bool)

    def serialized(self, texts: pa.Array, end_id: int) -> list[bytes]:
        """Each text's ids and the end id, as little-endian unsigned 32-bit integers."""
        words = words_of(texts, check=True)
        which, keys = pd.factorize(words.hashes)
        first = np.zeros(len(keys), np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        at, known = self.place(keys)
        if not known.all():
            new = np.flatnonzero(~known)
            if len(self.keys) + len(new) > TABLE_WORDS:
                self.empty()
                new = np.arange(len(keys))
            raw = words.data.tobytes()
            spelled = [raw[a:b].decode() for a, b in zip(words.first[first[new]].tolist(), words.last[first[new]].tolist())]
            # words with what may be a special token have no entry of their own: their texts go whole
            spelled = ["" if self.opening.decode() in w else w for w in spelled]
            self.add(keys[new], words.checks[first[new]], spelled)
            at, known = self.place(keys)
        slot = at[which]
        sizes = np.diff(words.offsets)
        lengths = self.sizes[slot]
        total = np.concatenate([[0], np.cumsum(lengths)])
        # every text's ids, then its end id
        ends = total[words.offsets] + np.arange(len(words.offsets))
        out = np.full(int(ends[-1]), end_id, "<u4")
        shift = np.repeat(np.arange(len(sizes)), sizes)
        to = np.repeat(total[:-1] + shift - self.starts[slot], lengths)
        source = np.repeat(self.starts[slot] - total[:-1], lengths) + np.arange(int(total[-1]))
        out[source + to] = self.flat[source]
        made = out.tobytes()
        cuts = (ends * 4).tolist()
        result = [made[a:b] for a, b in zip(cuts, cuts[1:])]
        odd = np.zeros(len(sizes), bool)
        clash = np.flatnonzero(self.checks[slot] != words.checks)
        odd[np.searchsorted(words.offsets, clash, side="right") - 1] = True
        for i in range(len(result)):
            if not sizes[i]:
                continue
            a, b = words.first[words.offsets[i]], words.last[words.offsets[i + 1] - 1]
            if odd[i] or self.opening in words.data[a:b].tobytes():
                ids = self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids
                result[i] = np.array([*ids, end_id], "<u4").tobytes()
        return result


@lru_cache(maxsize=2)
def word_table(path: str) -> WordTable:
    """One table per worker process, kept from task to task."""
    return WordTable(path)


def fit_dictionary(docs: DataFrame, path: str, end_id: int) -> bytes:
    """A dictionary over serialized ids; empty where there is too little to fit one."""
    short = docs.where(F.length("text") <= DICTIONARY_CHARS)
    rows = sorted(hashed_sample(short, "id", DICTIONARY_DOCS, "text").collect(), key=lambda r: (r.id is not None, r.id, r.text))
    samples = word_table(path).serialized(pa.array([r.text for r in rows], pa.string()), end_id)
    if sum(map(len, samples)) < 16 * DICTIONARY_BYTES or len(samples) < 64:
        return b"".join(samples)[:DICTIONARY_BYTES] if len(samples) > 1 else b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()


def write(docs: DataFrame, folder: str, path: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every text, appends the end id, and writes the store."""
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("text"))
    dictionary = fit_dictionary(rows, path, end_id)
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(bytearray(dictionary), sha, LEVEL, end_id)], "dictionary binary, sha256 string, level int, end_id bigint") \
        .coalesce(1).write.parquet(f"{folder}/dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, table = TaskContext.get().partitionId(), word_table(path)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        block, start = 0, 0
        ids, counts, starts, offsets, frames, held = [], [], [], [], [], 0

        def made() -> pa.RecordBatch:
            known = [i for i in ids if i is not None]
            row = {"shard": shard, "block": block, "least": min(known, default=None), "greatest": max(known, default=None),
                   "doc_ids": ids, "n_tokens": counts, "starts": starts, "offsets": offsets, "dictionary_sha256": sha,
                   "payload": b"".join(frames)}
            return pa.RecordBatch.from_pylist([row], schema=_SCHEMA)

        for batch in slices(batches, "text", SLICE):
            found = table.serialized(batch.column("text"), end_id)
            for doc, raw in zip(batch.column("id").to_pylist(), found):
                frame = press.compress(raw)
                if held and held + len(frame) > BLOCK_BYTES:
                    yield made()
                    block += 1
                    ids, counts, starts, offsets, frames, held = [], [], [], [], [], 0
                ids.append(doc)
                counts.append(len(raw) // 4)
                starts.append(start)
                offsets.append(held)
                frames.append(frame)
                held += len(frame)
                start += len(raw) // 4
        if ids:
            yield made()

    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.mapInArrow(run, _BLOCK).write.option("compression", "none").parquet(f"{folder}/blocks")


_SCHEMA = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("least", pa.int64()), ("greatest", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())),
    ("offsets", pa.list_(pa.int32())), ("dictionary_sha256", pa.string()), ("payload", pa.binary()),
])


def dictionary_of(spark: SparkSession, folder: str) -> tuple[bytes, str]:
    row = spark.read.parquet(f"{folder}/dictionary").head()
    if hashlib.sha256(row.dictionary).hexdigest() != row.sha256:
        raise ValueError("the dictionary does not match its hash")
    return bytes(row.dictionary), row.sha256


def read(spark: SparkSession, folder: str, only: list[int] | None = None, *, digest: bool = False) -> DataFrame:
    """(doc_id, start, ids) from the files; of the documents in ``only``, else of all.

    With ``digest``, the CRC-32 of the ids' bytes and their number come instead of the ids. Blocks written with another
    dictionary are refused.
    """
    dictionary, sha = dictionary_of(spark, folder)
    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")
    # ids in the shards before: one row per shard, from the index alone
    totals = blocks.select("shard", F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, n: a + n).alias("n"))
    sums = totals.groupBy("shard").agg(F.sum("n").alias("n"))
    before = sums.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    if only is not None:
        wanted = F.lit(False)
        for i in only:
            wanted = wanted | ((F.col("least") <= i) & (F.col("greatest") >= i))
        blocks = blocks.where(wanted)
    keep = frozenset(only) if only is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        unpack = zstandard.ZstdDecompressor(dict_data=shared)
        for batch in batches:
            for row in range(batch.num_rows):
                shard, ids, starts, offsets, sha_of, payload = (c[row] for c in batch.columns)
                if sha_of.as_py() != sha:
                    raise ValueError(f"a block needs the dictionary {sha_of.as_py()}")
                body = memoryview(payload.as_buffer())
                cuts = [*offsets.as_py(), len(body)]
                rows = [
                    (doc, start, unpack.decompress(body[a:b]))
                    for doc, start, a, b in zip(ids.as_py(), starts.as_py(), cuts, cuts[1:])
                    if keep is None or doc in keep
                ]
                out = [pa.array([shard.as_py()] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())]
                if digest:
                    out += [pa.array([len(r[2]) // 4 for r in rows], pa.int64()), pa.array([zlib.crc32(r[2]) for r in rows], pa.int64())]
                else:
                    lists = [np.frombuffer(r[2], "<u4").astype(np.int64) for r in rows]
                    out.append(pa.array(lists, pa.list_(pa.int64())))
                yield pa.record_batch(out, names=names)

    names = ["shard", "doc_id", "local_start", *(["n_tokens", "ids_crc32"] if digest else ["ids"])]
    kinds = "shard int, doc_id bigint, local_start bigint, " + ("n_tokens bigint, ids_crc32 bigint" if digest else "ids array<bigint>")
    parts = blocks.select("shard", "doc_ids", "starts", "offsets", "dictionary_sha256", "payload").mapInArrow(run, kinds)
    joined = parts.join(F.broadcast(before), "shard")
    return joined.select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), *names[3:])
