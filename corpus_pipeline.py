"""Corpus preparation: stages over the documents, each written as Parquet and read again as the next one's input.

A row is known by its id and a hash of its text, null ids included. Every stage but the last returns the columns of its
input. Rows that a stage has nothing against stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from waybill.llm import decontaminate, jaccard_join, pii, piece_codec, toxicity
from waybill.llm.queries import TOKENIZERS, remainder
from waybill.operators.lookup import BROADCAST_ROWS
from waybill.session import configure, fresh_dir, remove_at_exit, written
from waybill.sources.tables import read_table

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
SHINGLE_WORDS, PERCENT = 5, 80


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(work: Stage) -> Stage:
    """A stage that runs with the library's settings, whoever calls it."""

    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return work(configure(spark), docs, sf_dir)

    return run


def joined(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` joined to keys (doc_id, text_hash): documents stay where they are while the keys are counted to be few."""
    keys = written(keys.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), "keys")
    same = docs["doc_id"].eqNullSafe(keys["__id"]) & (F.xxhash64(docs["text"]) == keys["__hash"])
    return docs.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, same, how)


def without(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not among ``found`` (doc_id, text_hash)."""
    return joined(docs, found, "left_anti")


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out the documents whose score reaches the threshold of their language."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), remainder(3) != 1)
    return toxicity.score(docs, model, into="__toxicity").where("not __toxicity.toxic").select(*docs.columns)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by similar sets of shingles, the one of least id stays; of repeated rows, one."""
    found = written(jaccard_join.similar_documents(docs, width=SHINGLE_WORDS, percent=PERCENT), "near-copies")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    # empty texts are linked with nothing
    linked = found.where("n_shingles > 0")
    first = linked.groupBy("root").agg(F.min(order).alias("first"))
    more = linked.join(first, "root").where(order != F.col("first"))
    # only rows that are repeated have to meet; all others stay where they are
    keys = ["doc_id", "text_hash"]
    again = found.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys)
    more = written(more.select(*keys), "more-copies")
    name = "text_hash"
    while name in docs.columns:
        name += "_"
    one_each = without(joined(docs, again, "left_semi"), more).withColumn(name, F.xxhash64("text")).dropDuplicates(["doc_id", name])
    return without(docs, more.unionByName(again)).unionByName(one_each.select(*docs.columns))


@stage
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out the documents that hold a passage of the benchmark."""
    return without(docs, decontaminate.overlaps(docs, read_table(spark, sf_dir, "benchmark")))


@stage
def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind in place of every span of personal data."""
    clean = pii.redact(pii.find(docs, into="__spans"), spans_col="__spans")
    if "n_chars" in docs.columns:
        changed = F.size("__spans") > 0
        clean = clean.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


@stage
def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and the text they decode to."""
    return piece_codec.decode(piece_codec.encode(docs, MODEL), MODEL)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("personal_data", hide_personal_data),
    ("piece_ids", piece_ids),
]

# the first stage is a trained model: no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, work in STAGES:
        folder = fresh_dir(spark, f"pipeline-{name}")
        work(spark, docs, sf_dir).write.parquet(folder)
        remove_at_exit(spark, folder)
        docs = spark.read.parquet(folder)
    return docs
