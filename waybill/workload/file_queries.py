"""Queries that go through files: carrier layouts as CSV, the store, and the file stream."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import fold
from ..functions.text import not_blank
from ..plans.carriers import EASYPOST, FLAVORCLOUD, PLANS, UPS, dhl_tracking
from ..plans.load_gold import backfill_waiting
from ..plans.normalise import invoice_rollup, normalise, typed_lines
from ..plans.run import publish_counted, run_job
from ..plans.unify import shipment_charges
from ..session import fresh_dir, shuffles_deleted
from ..sources import contracts
from ..sources.files import attach_header, header_totals, read_dhl, read_named, read_positional
from ..sources.store import Store
from ..streaming.arrivals import FileLoader, ingest, stream_files
from . import oracle as o
from .fixtures import delivered, relation
from .queries import query, reference, staged, warehouse



def run_ts():
    return F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz")


# Lines of one delivered file. A carrier's delivery of more lines comes in several files of one folder, and the lines of a shipment
# in one of them; each is written by a task of its own.
FILE_LINES = 100_000
_SHIPMENT = ("express_or_ground_tracking_id", "tracking_code", "tracking_id", "shipment_number", "tracking_number")


def in_files(rows: DataFrame, shipment: Column | None = None, lines: int | None = None) -> tuple[DataFrame, int, int]:
    """Rows with the number (`part`) of their file in the delivery, the number of files of the largest delivery, and that of deliveries."""
    if shipment is None:
        shipment = F.col(next(n for n in _SHIPMENT if n in rows.columns))
    most, deliveries = rows.groupBy("file_id").count().agg(F.max("count"), F.count(F.lit(1))).head()
    parts = max(1, -(-(most or 0) // (lines or FILE_LINES)))
    # lines without a shipment belong together with no other
    key = F.when(not_blank(shipment), F.xxhash64(fold(F.trim(shipment)))).otherwise(F.xxhash64(*rows.columns))
    return rows.withColumn("part", F.pmod(key, F.lit(parts)).cast("int")), parts, deliveries


def dealt(rows: DataFrame, parts: int, deliveries: int) -> DataFrame:
    """Rows of :func:`in_files`, those of one file in one task."""
    files = max(1, deliveries) * parts
    return rows.repartitionById(files, F.coalesce(F.pmod(F.col("file_id") * parts + F.col("part"), F.lit(files)), F.lit(0)).cast("int"))


def deliver(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The lines of a staged relation, those of one file in one task, for :func:`write_delivery`."""
    return delivered(spark, folder, name, FILE_LINES)


def write_files(rows: DataFrame, folder: str, *, header: bool, packed: bool = False) -> None:
    """A file for each file id that a task holds. Packed, as a large delivery comes: most of a wide line is empty cells."""
    options = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"} if packed else {}
    with shuffles_deleted(rows.sparkSession):
        rows.write.partitionBy("file_id").options(header=header, escape='"', **options).csv(folder)


def positional_cells(rows: DataFrame, contract: contracts.Contract) -> list[Column]:
    """Every cell of the layout, also those that stay empty."""
    by_cell = {i: n for n, i in contract.ordinals.items()}
    return [
        F.col(by_cell[i]).alias(f"c{i}") if i in by_cell and by_cell[i] in rows.columns else F.lit(None).cast("string").alias(f"c{i}")
        for i in range(1, contract.width + 1)
    ]


def write_delivery(rows: DataFrame, contract: contracts.Contract, folder: str, *, header: bool | None = None) -> None:
    """Packed files of lines that are already dealt out (:func:`deliver`)."""
    if contract.positional:
        cells, titled = positional_cells(rows, contract), contract.has_header if header is None else header
    else:
        cells, titled = [F.col(n).alias(h) for n, h in contract.headers.items()], True
    write_files(rows.select("file_id", *cells), folder, header=titled, packed=True)


def write_positional(rows: DataFrame, contract: contracts.Contract, folder: str, *, header: bool) -> None:
    """CSV files by file id, with every cell of the layout. Cells that stay empty are added when the lines are dealt out."""
    write_files(dealt(*in_files(rows)).select("file_id", *positional_cells(rows, contract)), folder, header=header)


def write_named(rows: DataFrame, contract: contracts.Contract, folder: str) -> None:
    cells = [F.col(n).alias(h) for n, h in contract.headers.items()]
    write_files(dealt(*in_files(rows)).select("file_id", *cells), folder, header=True)


def with_file_id(rows: DataFrame) -> DataFrame:
    """The id of the file a row was read from (these files lie in `file_id=<n>/` folders)."""
    return rows.withColumn("file_id", F.regexp_extract("file_path", r"file_id=(\d+)/", 1).cast("bigint")).drop("file_path")


@query("csv_positional", "WITH " + o.ctes("stg_ups") + ", " + o.bills("ups") + f" SELECT {o.BILL} FROM bills_ups")
def _(spark, folder):
    out = fresh_dir(spark, "ups")
    write_delivery(deliver(spark, folder, "stg_ups"), contracts.UPS, out)
    return invoice_rollup(UPS, with_file_id(read_positional(spark, contracts.UPS, f"{out}/*")))


@query("csv_named", "WITH " + o.ctes("stg_easypost") + ", " + o.lines("easypost") + " SELECT * FROM lines_easypost")
def _(spark, folder):
    out = fresh_dir(spark, "easypost")
    write_delivery(deliver(spark, folder, "stg_easypost"), contracts.EASYPOST, out)
    return typed_lines(EASYPOST, with_file_id(read_named(spark, contracts.EASYPOST, f"{out}/*")))


@query("csv_trailer", "WITH " + o.ctes("stg_flavorcloud") + ", " + o.bills("flavorcloud") + f" SELECT {o.BILL} FROM bills_flavorcloud")
def _(spark, folder):
    out = fresh_dir(spark, "flavorcloud")
    write_delivery(deliver(spark, folder, "stg_flavorcloud"), contracts.FLAVORCLOUD, out)
    return invoice_rollup(FLAVORCLOUD, with_file_id(read_named(spark, contracts.FLAVORCLOUD, f"{out}/*")))


@query("csv_named_mixed_headers", "WITH " + o.ctes("stg_easypost") + ", " + o.lines("easypost") + " SELECT * FROM lines_easypost")
def _(spark, folder):
    # files of one delivery that order their columns differently and add some of their own
    out = fresh_dir(spark, "easypost")
    rows = staged(spark, folder, "easypost")
    names = list(contracts.EASYPOST.headers.items())
    for k in range(4):
        turned = names[k * 3:] + names[:k * 3]
        cells = [F.col(n).alias(h) for n, h in turned]
        extra = [F.lit("x, y").alias(f"own {i}") for i in range(k)]
        part = rows.where(F.col("file_id") % 4 == k).select("file_id", *extra, *cells)
        part.write.mode("append").partitionBy("file_id").options(header=True, escape='"').csv(out)
    return typed_lines(EASYPOST, with_file_id(read_named(spark, contracts.EASYPOST, f"{out}/*")))


# --- DHL files: a header record, details, and a valueless second line per shipment ---------------------


def write_dhl(spark: SparkSession, folder: str) -> str:
    out = fresh_dir(spark, "dhl")
    line = PLANS["dhl"].line()
    shipment = dhl_tracking(F.col("recipient_country"), line["domestic_tracking_number"], line["international_tracking_number"])
    rows, parts, deliveries = in_files(staged(spark, folder, "dhl"), shipment)
    names = {i: n for n, i in contracts.DHL.ordinals.items()}
    empty = F.lit(None).cast("string")
    cells = range(1, contracts.DHL.width + 1)
    detail = rows.select("file_id", "part", F.lit(1).alias("k"), *[F.col(names[i]).alias(f"c{i}") for i in cells if i in names])
    # every file states its own lines' total, under the delivery's invoice number
    numbered = rows.withColumns({
        "invoice_number": F.concat(F.lit("F"), F.col("file_id")), "invoice_date": F.lit("2024-03-01"), "file_id": F.col("file_id") * parts + F.col("part"),
    })
    one = F.floor(F.col("file_id") / parts).cast("bigint")
    bills = invoice_rollup(PLANS["dhl"], numbered).withColumns({"file_id": one, "part": F.pmod("file_id", F.lit(parts)).cast("int")})
    first = F.col("part") == F.min("part").over(Window.partitionBy("file_id"))  # few rows: one for each file
    header = {
        2: F.lit("2024-03-01"), 3: F.col("bill_number"), 4: F.col("account_number"),
        12: (F.col("total_amount") + F.when((F.col("file_id") == 3) & first, 1).otherwise(0)).cast("string"), 14: F.col("num_shipments").cast("string"),
    }
    top = bills.select("file_id", "part", F.lit(0).alias("k"), *[c.alias(f"c{i}") for i, c in header.items()])
    lines = dealt(detail.unionByName(top, allowMissingColumns=True), parts, deliveries).sortWithinPartitions("file_id", "part", "k")
    # cells that stay empty, and a shipment's second line, which holds its account alone, are made where they are written
    account = contracts.DHL.account_ordinal + 1
    again = F.when(F.col("k") == 0, F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    both = lines.withColumn("second", F.explode(again))
    write_files(both.select("file_id", *[
        (empty if f"c{i}" not in lines.columns else F.col(f"c{i}") if i == account else F.when(~F.col("second"), F.col(f"c{i}"))).alias(f"c{i}")
        for i in cells
    ]), out, header=False, packed=True)
    return out


_DHL_SUM = " + ".join(f"COALESCE({o.d(c)}, 0)" for c in ("transportation_cost", "non_qualified_dimensional_charges", "fuel_surcharge_amount", "delivery_area_surcharge_amount"))


def dhl_with_header(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    headers, details = read_dhl(spark, contracts.DHL, f"{write_dhl(spark, folder)}/*")
    return headers, details


@query("dhl_header_join", "WITH " + o.ctes("stg_dhl") + """ SELECT file_id, 'F' || file_id AS invoice_number, '2024-03-01' AS invoice_date, trim(unique_id) AS unique_id,
  CAST(NULLIF(trim(transportation_cost), '') AS DECIMAL(18,2)) AS transportation_cost FROM stg_dhl""")
def _(spark, folder):
    headers, details = dhl_with_header(spark, folder)
    return with_file_id(attach_header(details, headers)).select(
        "file_id", "invoice_number", "invoice_date", F.trim("unique_id").alias("unique_id"),
        F.col("transportation_cost").cast("decimal(18,2)").alias("transportation_cost"),
    )


@query("dhl_header_total", "WITH " + o.ctes("stg_dhl") + f""", t AS (SELECT file_id, CAST(sum({_DHL_SUM}) AS DECIMAL(18,2)) AS detail_total FROM stg_dhl GROUP BY 1)
SELECT file_id, 'F' || file_id AS bill_number, CAST(detail_total + CASE WHEN file_id = 3 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS header_total, detail_total, file_id <> 3 AS agrees FROM t""")
def _(spark, folder):
    headers, details = dhl_with_header(spark, folder)
    by_file = with_file_id(header_totals(details, headers))
    return by_file.groupBy("file_id", "bill_number").agg(
        *[F.sum(c).cast("decimal(18,2)").alias(c) for c in ("header_total", "detail_total")], F.bool_and("agrees").alias("agrees"))


# --- store and runs --------------------------------------------------------------------------------------


def _load_easypost(spark: SparkSession, folder: str, store: Store) -> dict[str, int]:
    bills, lines = normalise(EASYPOST, staged(spark, folder, "easypost"))
    charges = shipment_charges(EASYPOST, lines, relation(spark, folder, "charge_types"))
    return publish_counted(store, append={"bills": bills, "lines": lines, "charges": charges})


@query("atomic_publish", "WITH " + o.ctes("stg_easypost") + ", " + o.bills("easypost") + ", " + o.lines("easypost") + """
SELECT b.file_id, b.bill_number, b.total_amount, (SELECT count(*) FROM lines_easypost l WHERE l.file_id = b.file_id AND l.bill_number = b.bill_number) AS n_lines FROM bills_easypost b""")
def _(spark, folder):
    store = Store(spark, fresh_dir(spark, "store"))
    _load_easypost(spark, folder, store)
    counted = store.read("lines").groupBy("file_id", "bill_number").agg(F.count(F.lit(1)).alias("n_lines"))
    return store.read("bills").join(counted, ["file_id", "bill_number"]).select("file_id", "bill_number", "total_amount", "n_lines")


@query("run_result", "WITH " + o.ctes("stg_easypost", "charge_types") + ", " + o.bills("easypost") + ", " + o.lines("easypost") + ", " + o.tall("easypost") + ", " + o.charges("easypost") + """
SELECT 'load easypost' AS job, 'SUCCESS' AS status, (SELECT count(*) FROM bills_easypost) AS bills, (SELECT count(*) FROM lines_easypost) AS lines, (SELECT count(*) FROM chg_easypost) AS charges""")
def _(spark, folder):
    store = Store(spark, fresh_dir(spark, "store"))
    result = run_job(spark, store, "load easypost", lambda: _load_easypost(spark, folder, store), run_ts())
    return result.select("job", "status", *[F.col("rows_by_table")[t].alias(t) for t in ("bills", "lines", "charges")])


@query("error_log", "SELECT 'load easypost' AS job, 'NumberFormatException' AS error_type, 50000 AS error_number, 16 AS severity, 1 AS state, "
       "true AS names_the_value, TIMESTAMP '2026-01-01' AS error_time FROM (SELECT count(*) FROM lineitem) t")
def _(spark, folder):
    store = Store(spark, fresh_dir(spark, "store"))

    def fails() -> dict[str, int]:
        bad = staged(spark, folder, "easypost").withColumn("rate", F.concat(F.col("rate"), F.lit("?")))
        return publish_counted(store, append={"lines": typed_lines(EASYPOST, bad)})

    try:
        run_job(spark, store, "load easypost", fails, run_ts())
    except Exception:  # recorded by the run
        pass
    return store.read("errors").select(
        "job", "error_type", "error_number", "severity", "state", F.col("message").contains("CAST_INVALID_INPUT").alias("names_the_value"), "error_time"
    )


# --- streams -----------------------------------------------------------------------------------------------


def _loader(spark: SparkSession, folder: str, plan=EASYPOST) -> FileLoader:
    return FileLoader(
        plan, Store(spark, fresh_dir(spark, "store")), relation(spark, folder, "charge_types"),
        **(reference(spark, folder) if plan.integrated else {}),
        # all part files of this trial are named alike, so the folder belongs to the name
        name_of=lambda path: F.regexp_extract(path, r"(file_id=\d+/[^/]+)$", 1),
    )


def _deliver(spark: SparkSession, rows: DataFrame) -> str:
    out = fresh_dir(spark, "arrivals")
    write_delivery(rows, contracts.EASYPOST, out)
    _arrive_in_order(spark, out)
    return out


def _arrive_in_order(spark: SparkSession, folder: str) -> None:
    """Date the files of `file_id=<n>/` folders by n: they were written at once, and come one after the other."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files = fs.listFiles(path(folder), True)
    while files.hasNext():
        file = files.next().getPath()
        number = re.search(r"file_id=(\d+)/", file.toString())
        if number:
            fs.setTimes(file, 1_700_000_000_000 + 1_000 * int(number[1]), -1)


def _files_of_largest(spark: SparkSession, folder: str) -> int:
    """The number of files of the largest delivery: a batch of some deliveries takes that many times as many files."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path(folder), True)
    found: dict[str, int] = {}
    while files.hasNext():
        number = re.search(r"file_id=(\d+)/", files.next().getPath().toString())
        if number:
            found[number[1]] = found.get(number[1], 0) + 1
    return max(found.values(), default=1)


def _stream(spark: SparkSession, loader: FileLoader, folder: str, files_per_batch: int = 3) -> None:
    """Load deliveries, some in a batch."""
    arrivals = stream_files(spark, folder, files_per_batch=files_per_batch * _files_of_largest(spark, folder))
    ingest(loader, getattr(contracts, loader.plan.key.upper()), arrivals, fresh_dir(spark, "checkpoint"), run_ts()).awaitTermination()


_COSTS = "SELECT tracking_number, billed_shipping_cost, charge_count FROM summary"


@query("stream_file_ingest", o.unified("easypost") + ", " + o.SUMMARY + _COSTS)
def _(spark, folder):
    loader = _loader(spark, folder)
    _stream(spark, loader, _deliver(spark, deliver(spark, folder, "stg_easypost")))
    return loader.summary().select("tracking_number", "billed_shipping_cost", "charge_count")


@query("stream_retry_once", o.unified("easypost") + ", " + o.SUMMARY + _COSTS)
def _(spark, folder):
    # the same files are delivered twice, to streams that do not know of each other
    loader = _loader(spark, folder)
    files = _deliver(spark, deliver(spark, folder, "stg_easypost"))
    _stream(spark, loader, files, 5)
    _stream(spark, loader, files, 8)
    return loader.summary().select("tracking_number", "billed_shipping_cost", "charge_count")


@query("stream_corrections", "WITH " + o.ctes("stg_corrections", "charge_types") + ", " + o.lines("easypost").replace("FROM stg_easypost", "FROM stg_corrections")
       + ", " + o.tall("easypost") + ", " + o.charges("easypost") + """ SELECT tracking_number, CAST(sum(amount) AS DECIMAL(18,2)) AS billed_shipping_cost, count(*) AS charge_count FROM chg_easypost GROUP BY 1""")
def _(spark, folder):
    loader = _loader(spark, folder)
    _stream(spark, loader, _deliver(spark, deliver(spark, folder, "stg_corrections")), 2)
    return loader.summary().where("charge_count > 0").select("tracking_number", "billed_shipping_cost", "charge_count")


_ATTRIBUTES = ("tracking_number", "shipment_date", "shipping_method", "destination_zone", "billed_weight_oz", "billed_length_in", "billed_width_in", "billed_height_in")
# of the files that name a shipment, the first to arrive decides
_FIRST_FILE = ("WITH " + o.ctes("stg_corrections", "carriers", "methods") + ", " + o.lines("easypost").replace("FROM stg_easypost", "FROM stg_corrections")
               + ", every AS (SELECT * FROM lines_easypost), firsts AS (SELECT lower(rtrim(tracking_code)) AS k, min(file_id) AS f FROM every GROUP BY 1), "
               + o.attributes("easypost").replace("FROM lines_easypost", "FROM (SELECT e.* FROM every e JOIN firsts ON k = lower(rtrim(tracking_code)) AND f = file_id) lines_easypost")
               + f" SELECT {', '.join(_ATTRIBUTES)} FROM attr_easypost")


def _corrections_in(spark: SparkSession, folder: str, files_per_batch: int) -> DataFrame:
    loader = _loader(spark, folder)
    _stream(spark, loader, _deliver(spark, deliver(spark, folder, "stg_corrections")), files_per_batch)
    return loader.store.read("attributes").select(*_ATTRIBUTES)


@query("stream_attributes_one_batch", _FIRST_FILE)
def _(spark, folder):
    return _corrections_in(spark, folder, 1_000)


@query("stream_attributes_batches", _FIRST_FILE)
def _(spark, folder):
    return _corrections_in(spark, folder, 1)


# every charge has a type after a load, known before or not
_ALL_UPS = o.unified("ups", with_attributes=False) + """, named AS (SELECT file_id, bill_number, bill_date, tracking_number, lower(rtrim(charge_name)) AS name, CAST(sum(amount) AS DECIMAL(18,2)) AS amount
  FROM tall_ups WHERE trim(tracking_number) <> '' GROUP BY ALL) """


@query("stream_ups_headerless", _ALL_UPS + "SELECT tracking_number, CAST(sum(amount) AS DECIMAL(18,2)) AS billed_shipping_cost, count(*) AS charge_count FROM named GROUP BY 1")
def _(spark, folder):
    out = fresh_dir(spark, "ups-arrivals")
    write_delivery(deliver(spark, folder, "stg_ups"), contracts.UPS, out, header=False)
    loader = _loader(spark, folder, UPS)
    _stream(spark, loader, out, 3)
    return loader.summary().where("charge_count > 0").select("tracking_number", "billed_shipping_cost", "charge_count")


@query("stream_dhl", "WITH " + o.ctes("stg_dhl") + f"""
SELECT 'F' || file_id AS bill_number, DATE '2024-03-01' AS bill_date, CAST(sum({_DHL_SUM}) AS DECIMAL(18,2)) AS total_amount, CAST(count(*) AS INT) AS num_shipments FROM stg_dhl GROUP BY file_id""")
def _(spark, folder):
    loader = _loader(spark, folder, PLANS["dhl"])
    _stream(spark, loader, write_dhl(spark, folder), 3)
    # the files of a large delivery are parts of one invoice
    return loader.store.read("bills").groupBy("bill_number", "bill_date").agg(
        F.sum("total_amount").cast("decimal(18,2)").alias("total_amount"), F.sum("num_shipments").cast("int").alias("num_shipments"))


@query("load_new_charge_type", _ALL_UPS + "SELECT CAST(sum(amount) AS DECIMAL(18,2)) AS amount, count(DISTINCT name) AS types FROM named")
def _(spark, folder):
    # the charge type table knows none of the carrier's types yet: the load adds them, and no money is lost
    loader = _loader(spark, folder, UPS)
    loader.charge_types = loader.charge_types.where(F.col("carrier_id") != UPS.carrier_id)
    out = fresh_dir(spark, "ups-arrivals")
    write_delivery(deliver(spark, folder, "stg_ups"), contracts.UPS, out, header=False)
    _stream(spark, loader, out, 4)
    return loader.store.read("charges").agg(
        F.sum("amount").cast("decimal(18,2)").alias("amount"), F.count_distinct("charge_type_id").alias("types")
    )


@query("load_bad_file_alone", "WITH " + o.ctes("stg_easypost") + """ SELECT file_id, count(*) FILTER (WHERE file_id <> 2) > 0 AS loaded, file_id = 2 AS refused FROM stg_easypost GROUP BY 1""")
def _(spark, folder):
    rows = staged(spark, folder, "easypost")
    spoiled = deliver(spark, folder, "stg_easypost").withColumn("rate", F.when(F.col("file_id") == 2, "12.x").otherwise(F.col("rate")))
    loader = _loader(spark, folder)
    loader.skip_bad_files = True
    _stream(spark, loader, _deliver(spark, spoiled), 100)
    number = F.regexp_extract("file_name", r"file_id=(\d+)/", 1).cast("bigint").alias("file_id")
    loaded = loader.store.read("tracker").select(number, F.lit(True).alias("loaded"), F.lit(False).alias("refused")).distinct()
    bad_files = loader.store.read("refused").select(F.col("file_id").alias("hashed"))
    named = loader.store.read("registered").select(F.col("file_id").alias("hashed"), number)
    bad = bad_files.join(named, "hashed").select("file_id", F.lit(True).alias("__bad")).distinct()
    names = rows.select("file_id").distinct().join(loaded.select("file_id"), "file_id", "left_anti")
    return loaded.unionByName(names.join(bad, "file_id", "left").select(
        "file_id", F.lit(False).alias("loaded"), F.coalesce("__bad", F.lit(False)).alias("refused")))


@query("stream_late_wms", o.gold("SELECT carrier_id, file_id, bill_number, tracking_number, charge_type_id, amount, shipment_package_id, customer_id, status FROM ledger"))
def _(spark, folder):
    w = warehouse(spark, folder)
    enriched = w.store.stage("packages", w.enriched())
    w.store.publish(append={"ledger": w.ledger(enriched.where("shipment_package_id % 3 = 0")), "packages": enriched})
    backfill_waiting(w.store, w.methods, w.store.read("packages"), w.shipments, w.orders)
    return w.store.read("ledger").select(
        "carrier_id", "file_id", "bill_number", "tracking_number", "charge_type_id", "amount", "shipment_package_id", "customer_id", "status"
    )


# --- every carrier's files through the loader ------------------------------------------------------------------


def _load_query(key: str) -> None:
    """Registration, reference data, bills, lines, shipments and charges of all files of a carrier, in two loads."""
    plan, contract = PLANS[key], contracts.CONTRACTS[contracts.CARRIER_ALIASES.get(key, key)]
    only = " AND EXISTS (SELECT 1 FROM attr_fedex a WHERE lower(a.tracking_number) = lower(t.tracking_number))" if key == "fedex" else ""
    sql = o.unified(key, with_attributes=False) + f""", named AS (SELECT t.* FROM tall_{key} t WHERE trim(tracking_number) <> ''{only})
SELECT lower(rtrim(tracking_number)) AS tracking, CAST(sum(amount) AS DECIMAL(18,2)) AS billed,
  count(DISTINCT (file_id, lower(rtrim(bill_number)), bill_date, lower(rtrim(charge_name)))) AS charges FROM named GROUP BY 1"""

    @query(f"load_{key}", sql)
    def _(spark, folder):
        # a file with lines that lack a required value is refused; load_bad_file_alone has that case
        if contract.header_record:
            files = write_dhl(spark, folder)
        else:
            files, rows = fresh_dir(spark, f"{key}-arrivals"), deliver(spark, folder, f"stg_{key}")
            rows = rows.where(" and ".join(f"trim({c}) <> ''" for c in plan.not_null if c in rows.columns) or "true")
            write_delivery(rows, contract, files)
        _arrive_in_order(spark, files)
        loader = _loader(spark, folder, plan)
        _stream(spark, loader, files, 4)
        costs = loader.store.read("costs")
        return costs.groupBy(F.col("tracking_number").alias("tracking")).agg(
            F.sum("amount").cast("decimal(18,2)").alias("billed"), F.sum("n_charges").alias("charges"))


for _key in PLANS:
    _load_query(_key)
