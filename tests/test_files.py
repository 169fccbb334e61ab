from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from waybill.plans import intake
from waybill.plans.carriers import EASYPOST, FEDEX, UNIUNI, UPS
from waybill.plans.normalise import IncompleteLines, invoice_rollup, typed_lines
from waybill.plans.run import publish_counted, run_job
from waybill.session import shared_dir
from waybill.sources import contracts
from waybill.sources.files import (
    MissingColumns, attach_header, header_drift, header_totals, path_parts, read_dhl, read_named, read_positional,
    read_staged,
)
from waybill.sources.store import Store
from waybill.streaming.arrivals import FileLoader, ingest, stream_files


def cell_line(contract, **values):
    cells = [""] * contract.width
    for name, v in values.items():
        cells[contract.ordinals[name] - 1] = v
    return ",".join(cells)


def run_ts():
    return F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz")


def test_positional_file_with_repeated_headers(spark, tmp_path):
    head = ",".join(["Tracking ID Charge Description"] * contracts.FEDEX.width)
    line = cell_line(contracts.FEDEX, invoice_number="I1", invoice_date="20260115", net_charge_amount='"1,234.50"', express_or_ground_tracking_id="  F1 ",
                     charge_description_0="Fuel", charge_amount_0="2", charge_description_50="Last", charge_amount_50="3")
    (tmp_path / "bill.csv").write_text(f"{head}\n{line}\n")
    staged = read_positional(spark, contracts.FEDEX, str(tmp_path / "bill.csv")).withColumn("file_id", F.lit(1))
    row = typed_lines(FEDEX, staged).first()
    assert (row.net_charge_amount, row.express_or_ground_tracking_id, row.charge_description_50, row.charge_amount_50) == (D("1234.50"), "F1", "Last", D("3.00"))
    assert row.charge_description_1 is None


def test_positional_file_without_header(spark, tmp_path):
    (tmp_path / "u.csv").write_text(cell_line(contracts.UPS, invoice_number="U", invoice_date="2026-01-15", net_amount="5", tracking_number="1Z") + "\n")
    staged = read_positional(spark, contracts.UPS, str(tmp_path / "u.csv"), has_header=False).withColumn("file_id", F.lit(1))
    assert invoice_rollup(UPS, staged).first().total_amount == D("5.00")


def test_scan_reads_only_bound_columns(spark, tmp_path):
    (tmp_path / "u.csv").write_text("x\n" + cell_line(contracts.UPS, invoice_number="U", invoice_date="2026-01-15", net_amount="5") + "\n")
    staged = read_positional(spark, contracts.UPS, str(tmp_path / "u.csv")).withColumn("file_id", F.lit(1))
    plan = invoice_rollup(UPS, staged)._jdf.queryExecution().executedPlan().toString()
    read = next(x for x in plan.splitlines() if "FileScan csv" in x).split("ReadSchema: struct<")[-1]
    assert len(read.split(",")) <= 6


def test_named_file(spark, tmp_path):
    headers = list(contracts.FLAVORCLOUD.headers.values())
    row = dict.fromkeys(headers, "") | {"Invoice Number": "F1", "Date": '"Jan 25, 2026"', "Shipment Number": "S1"}
    order = list(reversed(headers)) + ["Extra"]
    (tmp_path / "f.csv").write_text(",".join(order) + "\n" + ",".join(row.get(h, "x") for h in order) + "\n")
    got = read_named(spark, contracts.FLAVORCLOUD, str(tmp_path / "f.csv")).first()
    assert (got.invoice_number, got.invoice_date, got.shipment_number, got.carrier) == ("F1", "Jan 25, 2026", "S1", None)
    assert header_drift(contracts.FLAVORCLOUD, order)["unexpected"] == ["Extra"]
    (tmp_path / "g.csv").write_text("Invoice Number,Date\nF1,x\n")
    with pytest.raises(MissingColumns, match="Shipment Number"):
        read_named(spark, contracts.FLAVORCLOUD, str(tmp_path / "g.csv"))


def dhl_file(path, number, total, shipments):
    head = [""] * contracts.DHL.width
    for i, v in {1: "HDR", 2: "2026-01-15", 3: number, 4: "A1", 12: str(total), 14: str(len(shipments))}.items():
        head[i - 1] = v
    lines = [",".join(head)]
    for uid, cost in shipments:
        lines.append("DTL" + cell_line(contracts.DHL, account_number="A1", unique_id=uid, transportation_cost=cost, recipient_zip_postal_code="02139", recipient_country="US"))
        lines.append("DTL" + cell_line(contracts.DHL, account_number="A1"))
    path.write_text("\n".join(lines) + "\n")


def test_dhl_header_record(spark, tmp_path):
    dhl_file(tmp_path / "a.csv", "N1", "12.50", [("U1", "10.00"), ("U2", "2.50")])
    dhl_file(tmp_path / "b.csv", "N2", "9.00", [("U3", "8.00")])
    headers, details = read_dhl(spark, contracts.DHL, str(tmp_path))
    joined = {(r.unique_id, r.invoice_number, r.invoice_date) for r in attach_header(details, headers).collect()}
    assert joined == {("U1", "N1", "2026-01-15"), ("U2", "N1", "2026-01-15"), ("U3", "N2", "2026-01-15")}
    assert {(r.bill_number, r.detail_total, r.agrees) for r in header_totals(details, headers).collect()} == {("N1", D("12.50"), True), ("N2", D("8.00"), False)}


def test_path_parts(spark):
    frame = spark.createDataFrame([("https://h/c/acme/USPS%20-%20Easy%20Post/ca_1/bill%2B1+2.csv",)], "p string")
    assert tuple(frame.select(path_parts(F.col("p"))).first()[0]) == ("acme", "usps - easy post", "ca_1", "bill+1+2.csv")


def test_routing(spark):
    def first(n, account):
        return f'{{"Prop_{n}":"{account}"}}'

    arrivals = spark.createDataFrame([
        ("h/t/FedEx/594/a.csv", first(1, "594")), ("h/t/fedex/594/done.csv", first(1, "594")), ("h/t/fedex/594/bad.csv", first(1, "595")),
        ("h/t/canpar/1/x.csv", first(1, "1")), ("h/t/ups/0017X/u.csv", first(2, "0017x")), ("h/t/FlavorCloud/Site/f.csv", first(6, "Site")), ("h/t/dhl/1/e.csv", first(9, "1")),
    ], "file_path string, first_row string")
    carriers = spark.createDataFrame([(1, "FedEx"), (2, "UPS"), (3, "DHL"), (6, "Flavor Cloud")], "carrier_id int, carrier_name string")
    tracker = spark.createDataFrame([(10, "DONE.csv", 1, dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)), (11, "u.csv", 2, dt.datetime(2026, 1, 1), None)],
                                    "file_id bigint, file_name string, carrier_id int, created_at timestamp_ntz, completed_at timestamp_ntz")
    routed = intake.route_files(arrivals, carriers, tracker)
    got = {r.file_name: (r.route, r.error, r.is_new) for r in routed.collect()}
    assert got == {
        "a.csv": ("fedex", None, True), "done.csv": ("Skip", None, False), "bad.csv": (None, "account mismatch", False), "x.csv": (None, "unsupported carrier", False),
        "u.csv": ("ups", None, False), "f.csv": ("flavor cloud", None, True), "e.csv": (None, "account mismatch", False),
    }
    with pytest.raises(intake.RejectedFile):
        intake.require_routed(routed)
    registered = intake.register_files(routed, tracker, run_ts())
    assert registered.count() == 4 and intake.register_files(intake.route_files(arrivals, carriers, registered), registered, run_ts()).count() == 4
    done = registered.where("file_name = 'a.csv'")
    finished = intake.complete_files(registered, done, run_ts())
    assert finished.where("completed_at IS NOT NULL").count() == 2
    with pytest.raises(intake.RejectedFile, match="file_id=99"):
        intake.require_known(registered, spark.createDataFrame([(99,)], "file_id bigint"))


def test_store_publishes_all_or_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.publish(append={"a": spark.range(3), "b": spark.range(1)})
    bad = spark.range(2).select(F.expr("CAST(IF(id = 1, 'x', '1') AS INT)").alias("id"))
    with pytest.raises(Exception):
        store.publish(append={"a": spark.range(5), "b": bad})
    assert (store.read("a").count(), store.read("b").count()) == (3, 1)
    store.publish(append={"a": spark.range(2)}, replace={"b": spark.range(7)})
    assert (store.read("a").count(), store.read("b").count()) == (5, 7)
    assert Store(spark, str(tmp_path / "s")).manifest() == store.manifest()
    before = sorted(r.id for r in store.read("a").collect())
    store.compact("a", 1)
    assert sorted(r.id for r in store.read("a").collect()) == before and len(store.manifest()["a"]) == 1


def test_staged_frames_are_not_written_twice(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    stored = store.stage("t", spark.range(4))
    assert not store.has("t")
    store.publish(append={"t": stored})
    assert store.read("t").count() == 4 and "staged-" in store.manifest()["t"][0]


def test_run_results_and_errors(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    ok = run_job(spark, store, "j", lambda: publish_counted(store, append={"t": spark.range(4), "u": spark.range(0)}), run_ts()).first()
    assert (ok.status, ok.rows_by_table) == ("SUCCESS", {"t": 4, "u": 0})

    def fails():
        raise ValueError("no such file")

    with pytest.raises(ValueError):
        run_job(spark, store, "j", fails, run_ts())
    error = store.read("errors").first()
    assert (error.job, error.error_type, error.message) == ("j", "ValueError", "no such file")


def easypost_file(folder, name, *rows):
    headers = list(contracts.EASYPOST.headers.values())
    folder.mkdir(parents=True, exist_ok=True)
    base = {"created_at": "2025-01-18T10:00:00Z", "carrier_account_id": "ca_1", "service": "Ground", "carrier": "USPS", "postage_fee": "1"}
    body = [",".join((base | r).get(h, "") for h in headers) for r in rows]
    (folder / name).write_text("\n".join([",".join(headers), *body]) + "\n")


@pytest.fixture
def loader(spark, tmp_path):
    types = spark.createDataFrame([(1, 4, "Base Rate"), (2, 4, "Label Fee")], "charge_type_id int, carrier_id int, charge_name string")
    return FileLoader(
        EASYPOST, Store(spark, str(tmp_path / "store")), types,
        methods=spark.createDataFrame([], "shipping_method_id int, carrier_id int, method_name string, integrated_carrier_id int"),
        carriers=spark.createDataFrame([], "carrier_id int, carrier_name string"),
    )


def run_stream(spark, loader, folder, checkpoint):
    ingest(loader, contracts.EASYPOST, stream_files(spark, str(folder), files_per_batch=1), str(checkpoint), run_ts()).awaitTermination()


def costs(loader):
    return {r.tracking_number: (r.billed_shipping_cost, r.charge_count) for r in loader.summary().collect()}


def test_stream_loads_each_file_once_and_adds_corrections(spark, tmp_path, loader):
    inbox = tmp_path / "t" / "easypost" / "ca_1"
    easypost_file(inbox, "1.csv", {"tracking_code": "A", "rate": "20"}, {"tracking_code": "B", "rate": "1"})
    run_stream(spark, loader, inbox, tmp_path / "c")
    easypost_file(inbox, "2.csv", {"tracking_code": "A", "rate": "3"})
    run_stream(spark, loader, inbox, tmp_path / "c")
    # the platform charged 1 for each line; what its rate differs by is a charge of a type the load has added
    assert costs(loader) == {"A": (D("2.00"), 4), "B": (D("1.00"), 1)}
    # a stream that lost its checkpoint meets files that are loaded already
    run_stream(spark, loader, inbox, tmp_path / "c2")
    assert costs(loader) == {"A": (D("2.00"), 4), "B": (D("1.00"), 1)}
    assert loader.store.read("tracker").count() == 2


def test_failed_file_is_retried(spark, tmp_path, loader):
    inbox = tmp_path / "t" / "easypost" / "ca_1"
    easypost_file(inbox, "1.csv", {"tracking_code": "A", "rate": "oops"})
    with pytest.raises(Exception):
        run_stream(spark, loader, inbox, tmp_path / "c")
    assert not loader.store.has("charges")
    easypost_file(inbox, "1.csv", {"tracking_code": "A", "rate": "5"})
    run_stream(spark, loader, inbox, tmp_path / "c")
    assert costs(loader) == {"A": (D("1.00"), 2)}


def uniuni_row(spark, file, tracking):
    columns = [*contracts.UNIUNI.columns, "file_path"]
    row = {"invoice_number": "1", "invoice_time": "2026-02-15", "merchant_id": "A", "tracking_number": tracking, "total_billed_amount": "2", "base_fee": "2", "file_path": f"t/uniuni/A/{file}"}
    return spark.createDataFrame([tuple(row.get(c) for c in columns)], ", ".join(f"{c} string" for c in columns))


def test_files_without_tracking_are_refused(spark, tmp_path):
    types = spark.createDataFrame([(1, 8, "Base Rate")], "charge_type_id int, carrier_id int, charge_name string")
    loader = FileLoader(UNIUNI, Store(spark, str(tmp_path / "store")), types)
    rows = uniuni_row(spark, "good.csv", "U1").unionByName(uniuni_row(spark, "bad.csv", " "))
    with pytest.raises(IncompleteLines, match="tracking_number"):
        loader.load(rows, run_ts())
    assert set(loader.store.manifest()) == {"registered"}  # it is known that the files have come, nothing of them is loaded
    loader.skip_bad_files = True
    loader.load(rows, run_ts())
    assert [r.file_name for r in loader.store.read("tracker").collect()] == ["good.csv"]
    assert [(r.n_lines, r.missing) for r in loader.store.read("refused").collect()] == [(1, "tracking_number")]
    # the corrected file comes again under its name
    loader.load(uniuni_row(spark, "bad.csv", "U2"), run_ts())
    assert costs(loader) == {"U1": (D("2.00"), 1), "U2": (D("2.00"), 1)}


def test_shared_dir_is_the_clusters(spark):
    class Session:
        class conf:
            @staticmethod
            def get(name, default):
                return {"spark.checkpoint.dir": "hdfs://nn/shared/"}.get(name, default)

    assert shared_dir(Session()) == "hdfs://nn/shared"
    # no folder is named for this session: it gets one of its own, always the same
    assert shared_dir(spark) == shared_dir(spark)


def test_two_publishers_from_one_state(spark, tmp_path):
    """A load that began before another one was published does not undo it."""
    store, other = Store(spark, str(tmp_path / "s")), Store(spark, str(tmp_path / "s"))
    store.publish(append={"t": spark.range(1)})
    listed = store._latest()
    other.publish(append={"t": spark.range(1, 2)})
    store._latest = lambda: listed
    with pytest.raises(RuntimeError, match="run this one again"):
        store.publish(append={"t": spark.range(2, 3)})
    del store._latest
    assert sorted(r.id for r in store.read("t").collect()) == [0, 1]
    # a manifest that is still being written is not read
    (tmp_path / "s" / "manifests" / "000000000003.json").write_text('{"t": [')
    assert sorted(r.id for r in store.read("t").collect()) == [0, 1]


def test_named_files_bind_by_their_own_header(spark, tmp_path):
    names = list(contracts.EASYPOST.headers.values())
    rate, fee = names.index(contracts.EASYPOST.headers["rate"]), names.index(contracts.EASYPOST.headers["label_fee"])
    values = [f"v{i}" for i in range(len(names))]
    one, two = list(range(len(names))), list(range(len(names)))
    two[rate], two[fee] = two[fee], two[rate]
    for k, order in enumerate((one, two)):
        text = ",".join(['"own, column"', *(names[i] for i in order)]) + "\n" + ",".join(["x", *(values[i] for i in order)]) + "\n"
        (tmp_path / f"a b{k}.csv").write_text(text)
    got = read_named(spark, contracts.EASYPOST, str(tmp_path)).collect()
    assert len(got) == 2 and all(r.rate == f"v{rate}" and r.label_fee == f"v{fee}" for r in got)
    (tmp_path / "short.csv").write_text(",".join(n for i, n in enumerate(names) if i != rate) + "\n")
    with pytest.raises(MissingColumns, match="short.csv"):
        read_named(spark, contracts.EASYPOST, str(tmp_path))


def test_dhl_file_without_header_record_is_refused(spark, tmp_path):
    cells = ["DTL", *[""] * (contracts.DHL.width - 1)]
    cells[contracts.DHL.ordinals["unique_id"] - 1] = "U1"
    (tmp_path / "x.csv").write_text(",".join(cells) + "\n")
    with pytest.raises(MissingColumns, match="0 header records"):
        read_staged(spark, contracts.DHL, [str(tmp_path / "x.csv")])


def test_headerless_files_keep_their_first_line(spark, tmp_path):
    (tmp_path / "u.csv").write_text("\n".join(",".join([f"r{k}"] * contracts.UPS.width) for k in range(3)) + "\n")
    assert read_staged(spark, contracts.UPS, [str(tmp_path / "u.csv")]).count() == 3


def test_watermark_reaches_the_scan(spark, tmp_path):
    from waybill.plans.legacy import since_last_run

    spark.sql("SELECT TIMESTAMP_NTZ '2026-01-01' AS created_date, 1 AS x").write.parquet(str(tmp_path / "t"))
    tracker = spark.sql("SELECT 'p' AS procedure_name, TIMESTAMP_NTZ '2025-06-01' AS last_run_time")
    rows = since_last_run(spark.read.parquet(str(tmp_path / "t")), "created_date", tracker, "p")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(created_date" in plan and rows.count() == 1
    assert since_last_run(rows, "created_date", tracker, "other").count() == 1


def test_shared_folder_is_required_on_a_cluster(spark):
    class Session:
        class conf:
            @staticmethod
            def get(name, default):
                return None

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_bad_file_alone_and_new_charge_types(spark, tmp_path, loader):
    loader.skip_bad_files = True
    loader.charge_types = loader.charge_types.where("charge_type_id = 1")
    inbox = tmp_path / "t" / "easypost" / "ca_1"
    for k, rate in enumerate(["1", "oops", "3", "4"]):
        easypost_file(inbox, f"{k}.csv", {"tracking_code": f"T{k}", "rate": rate, "label_fee": "2"})
    arrivals = stream_files(spark, str(inbox), files_per_batch=10)
    ingest(loader, contracts.EASYPOST, arrivals, str(tmp_path / "c"), run_ts()).awaitTermination()
    got = costs(loader)
    assert {k: v[0] for k, v in got.items()} == {"T0": D("3.00"), "T2": D("3.00"), "T3": D("3.00")}
    assert loader.store.read("refused").count() == 1
    bills = loader.store.read("bills")
    assert {"source_file", "loaded_at"} <= set(bills.columns)
    names = [r.charge_name for r in loader.store.read("charge_types").collect()]
    assert "Base Rate" in names and "Label Fee" in names and len(set(names)) == len(names)
