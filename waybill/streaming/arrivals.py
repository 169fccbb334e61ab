"""Carrier files as they arrive: each goes once through the batch jobs, however often it is delivered.

The stream's checkpoint remembers which files it has seen; the tracker table, published together with
the data, remembers which files are loaded; a file is registered before its load begins. A batch that fails publishes nothing and is run again; a
batch that is replayed after it published finds its files in the tracker and does nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.lookup import lookup_join
from ..operators.merge import append_new
from ..plans import gold
from ..plans.carriers import CarrierPlan
from ..plans.load_gold import layouts, unified
from ..plans.intake import RejectedFile, file_id
from ..plans.normalise import check_bills, incomplete_files, invoice_rollup, require_complete, typed_lines, unreadable_files
from ..plans.unify import shipment_summary
from ..plans.reference import discover_charge_types, discover_methods
from ..sources.contracts import Contract
from ..sources.files import account_in, head_problems, header_totals, path_parts, read_dhl, read_staged
from ..sources.heads import file_heads
from ..session import written
from ..sources.store import Store


def stream_files(spark: SparkSession, folder: str, *, files_per_batch: int = 1000) -> DataFrame:
    """Files as they arrive: (path, file_path, modified). Their content is read by the batch readers."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("modified"))
    )


@dataclass
class FileLoader:
    """Loads batches of one carrier's staged rows into a store."""

    plan: CarrierPlan
    store: Store
    charge_types: DataFrame
    methods: DataFrame | None = None
    carriers: DataFrame | None = None
    skip_bad_files: bool = False  # load the other files of a batch and record the refused ones
    name_of: Callable[[Column], Column] = lambda path: path_parts(path).getField("file_name")
    account_of: Callable[[str], str] | None = None  # the account that a file's path promises; its first row has to name it
    check_totals: bool = False  # a header record's total has to agree with its lines

    def __post_init__(self) -> None:
        self.store.layouts = self.store.layouts or layouts()

    def load(self, staged: DataFrame, run_ts: Column) -> bool:
        """Load the files that are not in the tracker. Returns whether there were any."""
        if "modified" not in staged.columns:
            staged = staged.withColumn("modified", F.lit(None).cast("timestamp"))
        # distinct first: names and ids are made once for a path there, and a text minimum over all lines would sort them
        files, rows = self._named(staged.select("file_path", "modified").distinct()), self._named(staged)
        files = files.groupBy("file_id", "file_name").agg(F.min("file_path").alias("source_path"), F.min("modified").alias("modified"))
        files = files.select(
            "file_id", "file_name", F.lit(self.plan.carrier_id).alias("carrier_id"), "source_path", "modified",
        )
        if self.store.has("tracker"):
            done = self.store.read("tracker").select("file_id")
            files = append_new(files, done, ["file_id"])
            rows = lookup_join(rows, done.distinct(), ["file_id"], "left_anti")
        if files.isEmpty():
            return False
        # one row per file: the window orders the files of this load, earlier loads are in the store
        files = self._register(written(files, "files"), run_ts)
        version = self.store.version()
        order = files.select("file_id", F.row_number().over(Window.orderBy("modified", "file_name")).cast("bigint").alias("arrival"))
        rows = lookup_join(rows.drop("modified"), order, ["file_id"], "inner")
        unreadable = None
        if self.skip_bad_files:
            unreadable = written(unreadable_files(self.plan, rows).withColumn("missing", F.lit("a number or date that cannot be read")), "unreadable")
            files, rows = (lookup_join(f, unreadable.select("file_id"), ["file_id"], "left_anti") for f in (files, rows))
        # the files' text is parsed once per table; what follows reads the typed lines
        loaded = files.select("file_id", F.col("file_name").alias("source_file"), F.col("created_at").alias("loaded_at"))
        bills = self.store.stage("bills", lookup_join(invoice_rollup(self.plan, rows), loaded, ["file_id"], "left"))
        lines = self.store.stage("lines", typed_lines(self.plan, rows, bills, bills_are_stored=True))
        refused = None
        if unreadable is None:
            require_complete(self.plan, lines)
        else:
            lacking = written(incomplete_files(self.plan, lines), "lacking")
            files, bills, lines = (lookup_join(f, lacking.select("file_id"), ["file_id"], "left_anti") for f in (files, bills, lines))
            refused = unreadable.unionByName(lacking)
        check_bills(bills)
        types, new_types = self._with_new("charge_types", self.charge_types, "charge_type_id",
                                          lambda known: discover_charge_types(self.plan, lines, known))
        methods, new_methods = self.methods, None
        if methods is not None and "method_name" in methods.columns:
            methods, new_methods = self._with_new("methods", methods, "shipping_method_id",
                                                  lambda known: discover_methods(self.plan, lines, known, self.carriers))
        append, update = unified(self.store, self.plan, lines, types, methods=methods, carriers=self.carriers)
        append |= {"bills": bills, "lines": lines, "tracker": files.withColumn("completed_at", run_ts), "charge_types": new_types}
        if new_methods is not None:
            append["methods"] = new_methods
        if refused is not None:
            append["refused"] = refused.withColumn("refused_at", run_ts)
        self.store.publish(append=append, update=update, after=version)
        return True

    def _named(self, rows: DataFrame) -> DataFrame:
        """Rows with the name and the id of their file."""
        return rows.withColumn("file_name", self.name_of(F.col("file_path"))).withColumn(
            "file_id", file_id(F.col("file_name"), F.lit(self.plan.carrier_id))
        )

    def _register(self, files: DataFrame, run_ts: Column) -> DataFrame:
        """The files with the time they were first registered; new ones are recorded before anything of them is loaded."""
        new = files.withColumn("created_at", run_ts)
        if self.store.has("registered"):
            new = append_new(new, self.store.read("registered"), ["file_id"])
        new = written(new, "registered")
        if not new.isEmpty():
            self.store.publish(append={"registered": new})
        known = self.store.read("registered").select("file_id", "created_at")
        return written(lookup_join(files, known, ["file_id"], "left"), "files")

    def unfinished(self) -> DataFrame:
        """Files that were registered and not completed: refused ones, and those whose load has died."""
        registered = self.store.read("registered")
        return append_new(registered, self.store.read("tracker"), ["file_id"]) if self.store.has("tracker") else registered

    def _with_new(self, table: str, given: DataFrame, key: str, discover: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
        """The reference table with what the lines add, and the rows to append to the store."""
        stored = self.store.has(table)
        known = self.store.read(table) if stored else given
        found = discover(known)
        highest = known.agg(F.coalesce(F.max(key), F.lit(0))).head()[0]
        # few rows: one for each name that was never met before
        names = [c for c in ("charge_name", "method_name", "integrated_carrier_id") if c in found.columns]
        number = (F.row_number().over(Window.orderBy(*names)) + highest).alias(key)
        lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in given.schema if f.name not in (key, *found.columns)]
        new = found.select(number, *[c for c in found.columns if c != key], *lacking)
        new = written(new.select(*[F.col(f.name).cast(f.dataType) for f in given.schema]), table)
        every = known.select(*given.columns).unionByName(new)
        return every, new if stored else every

    def refuse(self, problems: dict[str, str], run_ts: Column) -> None:
        """Record files that cannot be read at all, by path; they are not in the tracker and may come again."""
        found = self.store.spark.createDataFrame(sorted(problems.items()), "file_path string, missing string")
        named = found.withColumn("file_name", self.name_of(F.col("file_path")))
        self.store.publish(append={"refused": named.select(
            file_id(F.col("file_name"), F.lit(self.plan.carrier_id)).alias("file_id"), F.lit(None).cast("bigint").alias("n_lines"),
            "missing", run_ts.alias("refused_at"),
        )})

    def summary(self) -> DataFrame:
        """Cost per shipment over everything loaded so far: later corrections simply add charges."""
        return shipment_summary(self.store.read("attributes"), self.store.read("costs"))

    def summary_beside(self, shipments: DataFrame) -> DataFrame:
        """The same for some shipments (carrier_id, tracking_number): no other bucket of them is read."""
        near = [gold.of_files(self.store.read_beside(table, shipments), shipments) for table in ("attributes", "costs")]
        return shipment_summary(*near)


def intake_problems(loader: FileLoader, contract: Contract, files: list) -> dict[str, str]:
    """Why files (path, file_path) must not be loaded: their head, their account, or a total that their lines do not add up to."""
    spark = loader.store.spark
    headless = contract.positional and not contract.header_record
    problems: dict[str, str] = {}
    if loader.account_of is not None or not headless:
        heads = file_heads(spark, [f["path"] for f in files]).collect()  # as many rows as files in a trigger
        problems = head_problems(contract, heads)
        for row in heads if loader.account_of is not None else ():
            expected, found = loader.account_of(row["file_path"]), account_in(contract, row)
            if not found or found.lower() != expected.lower():
                problems.setdefault(row["file_path"], f"account mismatch: expected {expected}, found {found}")
    good = [f["path"] for f in files if f["file_path"] not in problems]
    if loader.check_totals and contract.header_record and good:
        headers, details = read_dhl(spark, contract, good)
        for row in header_totals(details, headers).where("agrees is null or not agrees").collect():
            problems[row["file_path"]] = f"its header says {row['header_total']}, its lines add up to {row['detail_total']}"
    return problems


def load_files(loader: FileLoader, contract: Contract, files: list, run_ts: Column) -> None:
    """Load files (path, file_path, modified) in order of arrival.

    With ``skip_bad_files`` a file whose data is at fault stops no other: its head does not fit the contract, a number or date
    cannot be read, or a line lacks a required value. It is recorded under ``refused`` and may come again. Each is found by one pass
    over all files of the batch. Anything else (a lost executor, a full disk, another load that published first) fails the
    batch, which is then run again as a whole; no file is blamed for it.
    """
    spark = loader.store.spark
    problems = intake_problems(loader, contract, files)
    if problems and not loader.skip_bad_files:
        path, reason = min(problems.items())
        raise RejectedFile(f"{path}: {reason}")
    if problems:
        loader.refuse(problems, run_ts)
        files = [f for f in files if f["file_path"] not in problems]
    if not files:
        return
    staged = read_staged(spark, contract, [f["path"] for f in files])
    when = spark.createDataFrame([(f["file_path"], f["modified"]) for f in files], "file_path string, modified timestamp")
    loader.load(staged.join(F.broadcast(when), "file_path"), run_ts)


def ingest(
    loader: FileLoader, contract: Contract, arrivals: DataFrame, checkpoint: str, run_ts: Column | None = None
) -> StreamingQuery:
    """Run the stream over all files that are there, then stop."""
    stamp = F.current_timestamp().cast("timestamp_ntz") if run_ts is None else run_ts

    def batch(rows: DataFrame, _batch_id: int) -> None:
        # as many rows as files in a trigger
        files = sorted(rows.collect(), key=lambda f: (f["modified"], f["path"]))
        if files:
            load_files(loader, contract, files, stamp)

    return (
        arrivals.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
