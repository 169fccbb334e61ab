"""Tables as Parquet snapshots under one root, published by a manifest.

A load writes new files of every table it touches and then publishes one manifest that names them
all, so readers see all of a load or none of it. Appends add a folder to a table's list: data that
is already there is never rewritten.

A table with a :class:`Layout` lies in partition folders computed from its rows, such as a bucket of
its key. A load reads and rewrites only the partitions its rows fall into; the folders of all others
stay in the manifest as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import fold
from ..session import shuffles_deleted

_END = "\n"  # closes a complete manifest
_LOAD = "load"
BUCKETS = 16


def bucket(keys: list[str], text_keys: tuple[str, ...] = (), n: int = BUCKETS) -> Column:
    """The bucket of a key; texts that compare equal fall into the same one."""
    return F.pmod(F.xxhash64(*[fold(F.col(k)) if k in text_keys else F.col(k) for k in keys]), F.lit(n)).cast("int")


@dataclass(frozen=True)
class Layout:
    """Partition columns by name, each from the table's own columns. They are not part of the rows that are read."""

    columns: Callable[[], dict[str, Column]]
    # whether a partition's rows are brought together before they are written. Without it every task writes into all
    # partitions, which spares an exchange of all rows and suits some dozens of partitions, not thousands.
    gathered: bool = True

    def laid_out(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns(self.columns())

    def parts(self, rows: DataFrame) -> list[dict]:
        """The partitions that rows fall into: at most as many as the layout has."""
        named = self.columns()
        return [r.asDict() for r in rows.select(*[c.alias(n) for n, c in named.items()]).distinct().collect()]


def _among(parts: list[dict]) -> Column:
    """Whether a row lies in one of the partitions: by column where one says it all, so that scans are pruned."""
    if not parts:
        return F.lit(False)
    names = list(parts[0])
    if len(names) == 1:
        return F.col(names[0]).isin([p[names[0]] for p in parts])
    by_first: dict = {}
    for p in parts:
        by_first.setdefault(p[names[0]], []).append({n: p[n] for n in names[1:]})
    out = F.lit(False)
    for value, rest in by_first.items():
        out = out | ((F.col(names[0]) == F.lit(value)) & _among(rest))
    return out


class Store:
    def __init__(self, spark: SparkSession, root: str, layouts: dict[str, Layout] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.layouts = layouts or {}
        self._jvm_fs = spark._jvm.org.apache.hadoop.fs
        self._path = self._jvm_fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)
        self._fs.mkdirs(self._path(f"{self.root}/manifests"))
        self._staged: dict[int, tuple[DataFrame, str]] = {}

    def _versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/manifests"))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def version(self) -> int:
        """Number of the last published manifest, for ``publish(after=...)``."""
        return self._latest()[0]

    def manifest(self) -> dict[str, list[str]]:
        return self._latest()[1]

    def _latest(self) -> tuple[int, dict[str, list[str]]]:
        """Number and content of the last published manifest, from one listing.

        A manifest is put in place whole, so one that is cut off belongs to nobody and is passed over.
        """
        listed = self._versions()
        for number in reversed(listed):
            stream = self._fs.open(self._path(self._manifest_path(number)))
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith(_END):
                return listed[-1], json.loads(text)
        return (listed[-1] if listed else 0), {}

    def _manifest_path(self, number: int) -> str:
        return f"{self.root}/manifests/{number:012d}.json"

    def has(self, table: str) -> bool:
        return bool(self.manifest().get(table))

    def read(self, table: str) -> DataFrame:
        rows = self._partitioned(table)
        return rows.drop(_LOAD, *self.layouts[table].columns()) if table in self.layouts else rows

    def read_or(self, table: str, empty: DataFrame) -> DataFrame:
        return self.read(table) if self.has(table) else empty.limit(0)

    def _partitioned(self, table: str) -> DataFrame:
        """The table with the columns of its partitions."""
        reader = self.spark.read
        if table in self.layouts:
            reader = reader.option("basePath", f"{self.root}/data/{table}")
        return reader.parquet(*self.manifest()[table])

    def read_parts(self, table: str, parts: list[dict]) -> DataFrame:
        """The rows in some partitions; nothing else is read."""
        return self._partitioned(table).where(_among(parts)).drop(_LOAD, *self.layouts[table].columns())

    def read_where(self, table: str, condition: str) -> DataFrame:
        """The rows whose partition columns meet a condition."""
        return self._partitioned(table).where(condition).drop(_LOAD, *self.layouts[table].columns())

    def read_beside(self, table: str, rows: DataFrame) -> DataFrame:
        """The stored rows in the partitions that ``rows`` fall into. ``rows`` is read once for that."""
        return self.read_parts(table, self.layouts[table].parts(rows))

    def stage(self, table: str, frame: DataFrame) -> DataFrame:
        """Write a frame that later steps of the same load read; :meth:`publish` takes it as it is."""
        folder = f"{self.root}/data/{table}/{_LOAD}=staged-{uuid.uuid4().hex[:12]}"
        self._write(table, frame, folder)
        stored = self.spark.read.schema(frame.schema).parquet(folder)
        if table in self.layouts:
            stored = stored.drop(*self.layouts[table].columns())
        self._staged[id(stored)] = (stored, folder)
        return stored

    def _write(self, table: str, frame: DataFrame, folder: str) -> None:
        with shuffles_deleted(frame.sparkSession):
            self._write_rows(table, frame, folder)

    def _write_rows(self, table: str, frame: DataFrame, folder: str) -> None:
        layout = self.layouts.get(table)
        if layout is None:
            frame.write.parquet(folder)
            return
        names = list(layout.columns())
        rows = layout.laid_out(frame)
        if layout.gathered:  # a partition's rows come together, however large ones are split again
            rows = rows.hint("rebalance", *[F.col(n) for n in names])
        rows.write.partitionBy(*names).parquet(folder)
        if not self._leaves(folder, 1):  # no rows: one empty file keeps the schema
            none = {n: "false" if rows.schema[n].dataType.simpleString() == "boolean" else "0" for n in names}
            frame.limit(0).write.parquet("/".join([folder, *(f"{n}={v}" for n, v in none.items())]))

    def _leaves(self, folder: str, depth: int) -> list[str]:
        """The partition folders below a folder."""
        below = [folder]
        for _ in range(depth):
            found = [(at, s) for at in below for s in self._fs.listStatus(self._path(at)) if s.isDirectory()]
            below = [f"{at}/{s.getPath().getName()}" for at, s in found if "=" in s.getPath().getName()]
        return below

    def compact(self, table: str, files: int) -> None:
        """Bring the folders of many small appends into one of a given number of files."""
        self.publish(replace={table: self.read(table).repartition(files)})

    def publish(
        self, *, append: dict[str, DataFrame] | None = None, replace: dict[str, DataFrame] | None = None,
        update: dict[str, tuple[DataFrame, list[dict]]] | None = None, after: int | None = None,
    ) -> None:
        """Write all frames, then create the next manifest. A failed write publishes nothing.

        ``update`` gives the new rows of some partitions: these are replaced as a whole, rows that fall
        into others are added there, and all other partitions stay as they are.

        ``after`` is the version that the load has read. The manifest is put beside and moved into
        place without overwriting: of two loads that began from the same state, one has to run again.
        """
        last, tables = self._latest()
        if after is not None and after != last:
            raise PublishConflict(f"another load published version {last} of {self.root}; run this one again")
        number = last + 1
        for mode, frames in (("append", append or {}), ("replace", replace or {}), ("update", update or {})):
            for table, given in frames.items():
                frame, parts = given if mode == "update" else (given, [])
                _, folder = self._staged.pop(id(frame), (None, None))
                if folder is None:
                    folder = f"{self.root}/data/{table}/{_LOAD}={number:012d}-{uuid.uuid4().hex[:8]}"
                    self._write(table, frame, folder)
                old = [] if mode == "replace" else tables.get(table, [])
                if mode == "update":
                    old = self._without(table, old, parts)
                tables[table] = [*old, folder]
        self._put(number, json.dumps(tables) + _END)

    def _without(self, table: str, folders: list[str], parts: list[dict]) -> list[str]:
        names = list(self.layouts[table].columns())
        gone = {"/".join(f"{n}={str(p[n]).lower() if isinstance(p[n], bool) else p[n]}" for n in names) for p in parts}
        out = []
        for folder in folders:
            done = sum("=" in x for x in folder.removeprefix(f"{self.root}/data/{table}/").split("/")) - 1
            leaves = self._leaves(folder, len(names) - done)
            kept = [x for x in leaves if "/".join(x.split("/")[-len(names):]) not in gone]
            out += [folder] if len(kept) == len(leaves) else kept
        return out

    def _put(self, number: int, text: str) -> None:
        beside = f"{self.root}/manifests/.{number:012d}-{uuid.uuid4().hex[:8]}"
        stream = self._fs.create(self._path(beside), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm_fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(getattr(self._jvm_fs, "Options$Rename"), 0)
        try:
            context.rename(self._path(beside), self._path(self._manifest_path(number)), none)
        except Py4JJavaError as error:
            self._fs.delete(self._path(beside), False)
            if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
                raise PublishConflict(f"another load published version {number} of {self.root}; run this one again") from error
            raise


class PublishConflict(RuntimeError):
    """Another load was published since this one began."""
