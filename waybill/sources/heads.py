"""The first records of files, without reading the rest of them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

PATH = "file_path"
STEP = 1 << 16
LONGEST = 1 << 20  # a record that has not ended by then is none
# file systems that a task opens itself; files of others are scanned as text
DIRECT = {"file", "hdfs", "s3", "gs"}
_MARK = re.compile(rb'["\r\n]')


def split_records(data: bytes, n: int, *, whole: bool) -> list[bytes]:
    """The first ``n`` records that end within ``data`` (or with it, if it is ``whole``); line breaks within quotes are text."""
    out, start, quoted = [], 0, False
    for mark in _MARK.finditer(data):
        if mark[0] == b'"':
            quoted = not quoted
        elif not quoted:
            if mark.start() > start:
                out.append(data[start:mark.start()])
                if len(out) == n:
                    return out
            start = mark.end()
    if whole and start < len(data):
        out.append(data[start:])
    return out


def read_records(stream, n: int) -> list[bytes]:
    """The first ``n`` records of an open file; it is read in steps until they are there."""
    data = b""
    while True:
        more = stream.read(STEP)
        data += more
        found = split_records(data.removeprefix(b"\xef\xbb\xbf"), n, whole=not more)
        if len(found) == n or not more or len(data) > LONGEST:
            return found


def file_heads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_path, header, first_row): the first two records of every file, null where there are fewer.

    The files are dealt out by the listing, and each is opened for its first bytes only.
    """
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias(PATH))
    first = files.limit(1).collect()
    if first and urlparse(first[0][PATH]).scheme not in DIRECT:
        return _scanned_heads(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = []
            for uri in batch.column(PATH).to_pylist():
                if urlparse(uri).scheme == "file":
                    system, place = fs.LocalFileSystem(), unquote(urlparse(uri).path)
                else:
                    system, place = fs.FileSystem.from_uri(uri)
                with system.open_input_stream(place) as stream:
                    found = [r.decode("utf-8", "replace") for r in read_records(stream, 2)]
                heads.append([*found, None, None][:2])
            yield pa.record_batch(
                [batch.column(PATH), *(pa.array([h[i] for h in heads], pa.string()) for i in range(2))], names=[PATH, "header", "first_row"])

    return files.mapInArrow(run, f"{PATH} string, header string, first_row string")


def _scanned_heads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The same by a scan of the text, for file systems that only Spark opens; records are lines there."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias(PATH), "value", F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    ).where("start = 0 and trim(value) <> ''")
    order = Window.partitionBy(PATH).orderBy("at")
    first = lines.withColumn("n", F.row_number().over(order)).where("n <= 2")
    value = F.regexp_replace("value", "^﻿|\r$", "")
    heads = first.groupBy(PATH).agg(F.max(F.when(F.col("n") == 1, value)).alias("header"), F.max(F.when(F.col("n") == 2, value)).alias("first_row"))
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias(PATH))
    return files.join(heads, PATH, "left")
