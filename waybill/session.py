"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the jobs rely on; all can be changed on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.ansi.enabled": "true",  # a bad number or date fails the file
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM never compiles a method of more than 8000 bytes; typing a wide bill makes larger ones,
    # which would be interpreted for every row (three times slower over six million FedEx lines)
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a Python worker holds several copies of a batch; by rows alone a batch of long texts has no bound
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}

# A billing line becomes up to fifty charges with their keys in the task that reads it, so tasks begin with fewer bytes than
# Spark's 128 MB, and what they exchange falls into many partitions, of which adaptive execution joins small ones.
# At Spark's values these tasks spill from some million lines on.
BILLING_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.files.openCostInBytes": "1m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "256",
    # stored tables and those between two steps: a quarter less than Spark's snappy
    "spark.sql.parquet.compression.codec": "zstd",
    # a task that writes into some folders keeps their files open instead of sorting its rows by folder
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}

_CHECKPOINT_SETTING = "spark.checkpoint.dir"
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_fallback_dir: str | None = None


def configure(spark: SparkSession, *, billing: bool = False) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    for name, value in BILLING_SETTINGS.items():
        if billing:
            spark.conf.set(name, value)
        elif spark.conf.get(name, None) == value:  # left by a billing job of the same session
            spark.conf.unset(name)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A session on one machine that names none gets a folder of its own; on a cluster the name is required.
    """
    global _fallback_dir
    named = spark.conf.get(_CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(_CHECKPOINT_SETTING)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^-]*\])?", master):
        raise RuntimeError(f"set {_CHECKPOINT_SETTING} to a folder that all executors of {master} share")
    if _fallback_dir is None:
        _fallback_dir = tempfile.mkdtemp(prefix="waybill-")
        remove_at_exit(spark, _fallback_dir)
    return _fallback_dir


def remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Have the file system delete a folder of intermediate data when the application ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """A write is planned for itself, so nothing else reads its shuffles; they are deleted when it ends."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before) if before else spark.conf.unset(_SHUFFLE_CLEANUP)


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and kept when executors are lost."""
    spark = frame.sparkSession
    folder = fresh_dir(spark, label)
    with shuffles_deleted(spark):
        frame.write.parquet(folder)
    remove_at_exit(spark, folder)
    return spark.read.schema(frame.schema).parquet(folder)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written` that no frame still to be computed reads."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
