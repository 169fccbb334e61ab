"""Stored tables in partitions: what a load does not touch is neither read nor rewritten; files refused for their data alone."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from test_files import easypost_file, loader, run_stream, run_ts, uniuni_row  # noqa: F401
from waybill.operators import intervals
from waybill.operators.merge import append_new
from waybill.plans.carriers import EASYPOST, PLANS
from waybill.plans.intake import route_files
from waybill.plans.load_gold import backfill_waiting, layouts, stored_charges
from waybill.plans.normalise import typed_lines, unreadable_files
from waybill.plans.unify import CHARGE_KEY, TEXT_KEYS
from waybill.sources import contracts
from waybill.sources.files import MissingColumns, arrived, read_dhl, read_staged
from waybill.sources.heads import file_heads, read_records
from waybill.sources.store import Layout, PublishConflict, Store, bucket
from waybill.streaming.arrivals import ingest, stream_files


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def files_of(store, table):
    return set(store.read(table).inputFiles())


CHARGE = ("carrier_id int, file_id bigint, bill_number string, bill_date date, tracking_number string, charge_type_id int, amount decimal(18,2)")


def charge(file, tracking, amount="1"):
    return (4, file, f"B{file}", dt.date(2025, 1, 1), tracking, 1, D(amount))


def test_append_reads_only_the_buckets_it_touches(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), layouts(100))
    history = spark.createDataFrame([charge(f, f"T{f}") for f in range(400)], CHARGE)
    store.publish(append={"charges": history})
    new = spark.createDataFrame([charge(7, "t7 "), charge(7, "X"), charge(900, "T900")], CHARGE)
    near = store.read_beside("charges", new)
    assert "PartitionFilters: [" in plan_of(near) and "bucket#" in plan_of(near).split("PartitionFilters: [")[1].split("]")[0]
    touched = {r.b for r in new.select(bucket(["file_id"], n=100).alias("b")).collect()}
    assert near.count() == history.where(bucket(["file_id"], n=100).isin(sorted(touched))).count() < 40
    added = append_new(new, near, CHARGE_KEY, text_keys=TEXT_KEYS)
    assert sorted(r.tracking_number for r in added.collect()) == ["T900", "X"]
    one = stored_charges(store, spark.createDataFrame([(7,)], "file_id bigint"))
    assert "bucket#" in plan_of(one) and [r.tracking_number for r in one.collect()] == ["T7"]


def test_update_leaves_the_files_of_other_buckets(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), {"t": Layout(lambda: {"bucket": bucket(["k"], ("k",), 50)})})
    store.publish(append={"t": spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))})
    before = files_of(store, "t")
    change = spark.createDataFrame([("K3  ", -1), ("new", 5)], "k string, v bigint")
    parts = store.layouts["t"].parts(change)
    known = store.read_parts("t", parts)
    store.publish(update={"t": (known.where("k != 'k3'").unionByName(change), parts)})
    after = files_of(store, "t")
    gone = {re.search(r"bucket=(\d+)", f)[1] for f in before - after}
    assert gone <= {str(p["bucket"]) for p in parts} and len(before & after) >= 40
    assert store.read("t").count() == 501 and store.read("t").agg(F.sum("v")).first()[0] == sum(range(500)) - 3 - 1 + 5
    # a table without rows keeps its columns
    store.publish(replace={"t": change.limit(0)})
    assert store.read("t").columns == ["k", "v"] and store.read("t").count() == 0


LEDGER = ("carrier_id int, file_id bigint, tracking_number string, shipment_package_id bigint, shipment_external_id string, customer_id bigint, "
          "shipping_method_id int, status string")


def test_backfill_rewrites_waiting_rows_only(spark, tmp_path, monkeypatch):
    from waybill.plans import gold

    store = Store(spark, str(tmp_path / "s"), layouts(8))
    rows = [(4, f, f"T{f}", None if f % 4 == 0 else f, None, None, None, "unknown") for f in range(40)]
    store.publish(append={
        "ledger": spark.createDataFrame(rows, LEDGER), "attributes": spark.createDataFrame([(4, f"T{f}") for f in range(40)], "carrier_id int, tracking_number string"),
    })
    done = {f for f in files_of(store, "ledger") if "waiting=false" in f}
    monkeypatch.setattr(gold, "match_waiting", lambda waiting, *rest: waiting.withColumn(
        "shipment_package_id", F.when(F.col("file_id") % 8 == 0, F.col("file_id"))))
    backfill_waiting(store, None, None, None, None)
    assert done <= files_of(store, "ledger")
    ledger = store.read("ledger")
    assert ledger.count() == 40 and ledger.where("shipment_package_id is null").count() == 5
    assert {int(r.file_id) for r in store.read_where("ledger", "waiting = true").collect()} == {4, 12, 20, 28, 36}


def test_torn_manifest_blocks_nobody(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.publish(append={"t": spark.range(1)})
    (tmp_path / "s" / "manifests" / "000000000002.json").write_text('{"t": [')
    store.publish(append={"t": spark.range(1, 3)})
    assert sorted(r.id for r in store.read("t").collect()) == [0, 1, 2]


def test_load_that_began_earlier_has_to_run_again(spark, tmp_path):
    store, other = Store(spark, str(tmp_path / "s")), Store(spark, str(tmp_path / "s"))
    began = store.version()
    other.publish(append={"t": spark.range(1)})
    with pytest.raises(PublishConflict):
        store.publish(append={"t": spark.range(1)}, after=began)
    assert store.read("t").count() == 1


def test_conflict_refuses_no_file(spark, tmp_path, loader, monkeypatch):  # noqa: F811
    loader.skip_bad_files = True
    inbox = tmp_path / "t" / "easypost" / "ca_1"
    easypost_file(inbox, "1.csv", {"tracking_code": "A", "rate": "20"})
    plain, calls = loader.store.publish, []

    def once(**kinds):
        calls.append(kinds)
        if len(calls) == 1:
            raise PublishConflict("another load came first")
        plain(**kinds)

    monkeypatch.setattr(loader.store, "publish", once)
    with pytest.raises(Exception, match="another load came first"):
        run_stream(spark, loader, inbox, tmp_path / "c")
    assert not loader.store.has("refused")
    run_stream(spark, loader, inbox, tmp_path / "c")
    assert loader.store.read("tracker").count() == 1 and loader.store.read("refused").count() == 0


def test_bad_files_are_found_in_one_pass(spark, tmp_path, loader):  # noqa: F811
    loader.skip_bad_files = True
    inbox = tmp_path / "t" / "easypost" / "ca_1"
    for k, rate in enumerate(["1", "oops", "3", "1e400", "4"]):
        easypost_file(inbox, f"{k}.csv", {"tracking_code": f"T{k}", "rate": rate})
    easypost_file(inbox, "5.csv", {"tracking_code": "T5", "rate": "1", "created_at": "yesterday"})
    (inbox / "6.csv").write_text("a,b\n1,2\n")
    (inbox / "7.csv").write_text("\n")
    loads = []
    plain = loader.load
    loader.load = lambda *args: loads.append(1) or plain(*args)
    ingest(loader, contracts.EASYPOST, stream_files(spark, str(inbox), files_per_batch=100), str(tmp_path / "c"), run_ts()).awaitTermination()
    assert len(loads) == 1
    assert sorted(r.file_name for r in loader.store.read("tracker").collect()) == ["0.csv", "2.csv", "4.csv"]
    assert loader.store.read("refused").count() == 5


@pytest.mark.parametrize("key", sorted(PLANS))
def test_readable_lines_are_not_unreadable(spark, key):
    from waybill.workload.queries import staged

    rows = staged(spark, "/root/testdata/sf0.001", key)
    assert typed_lines(PLANS[key], rows).count() > 0
    assert unreadable_files(PLANS[key], rows).count() == 0


# --- heads of files -----------------------------------------------------------------------------------------


class Counted:
    def __init__(self, data):
        self.data, self.at = data, 0

    def read(self, n):
        out = self.data[self.at:self.at + n]
        self.at += n
        return out


def test_only_the_head_of_a_file_is_read():
    stream = Counted(b'\xef\xbb\xbf"a\nb",c\r\n\r\n1,2\r\n' + b"x,y\n" * 5_000_000)
    assert read_records(stream, 2) == [b'"a\nb",c', b"1,2"] and stream.at <= 1 << 16
    long = Counted(b'"' + b"x" * (1 << 23))
    assert read_records(long, 1) == [] and long.at <= 1 << 21
    assert read_records(Counted(b"only"), 2) == [b"only"] and read_records(Counted(b""), 2) == []


def test_heads_by_task_and_by_scan_agree(spark, tmp_path, monkeypatch):
    from waybill.sources import heads

    (tmp_path / "a b+%.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "c.csv").write_text("\n\nonly")
    want = sorted((tuple(r)[1:] for r in file_heads(spark, str(tmp_path)).collect()), key=str)
    assert want == [("only", None), ("x,y", "1,2")]
    monkeypatch.setattr(heads, "DIRECT", set())
    assert sorted((tuple(r)[1:] for r in file_heads(spark, str(tmp_path)).collect()), key=str) == want


def dhl_cells(**cells):
    return ",".join(cells.get(f"c{i}", "") for i in range(1, contracts.DHL.width + 1))


def test_dhl_bill_as_documented(spark, tmp_path):
    """The first line is the summary, known by its place; there is no marker, and a detail is no summary."""
    top = dhl_cells(c2="2025-01-02", c3="INV1", c4="ACC", c12="12.50", c14="2")
    lines = [top, dhl_cells(c2="ACC", c13="U1", c30="10"), dhl_cells(c2="ACC"), dhl_cells(c2="ACC", c13="U2", c30="2.50"), dhl_cells(c2="ACC")]
    folder = tmp_path / "t" / "dhl" / "ACC"
    folder.mkdir(parents=True)
    (folder / "bill.csv").write_text("\n".join(lines) + "\n")
    headers, details = read_dhl(spark, contracts.DHL, str(folder))
    assert [(r.header_bill_number, r.header_total_amount) for r in headers.collect()] == [("INV1", "12.50")]
    assert sorted(r.unique_id for r in details.collect()) == ["U1", "U2"]
    staged = read_staged(spark, contracts.DHL, [str(folder / "bill.csv")])
    assert {(r.invoice_number, r.invoice_date) for r in staged.collect()} == {("INV1", "2025-01-02")}
    (folder / "cut.csv").write_text("\n".join(lines[1:]) + "\n")
    with pytest.raises(MissingColumns, match="cut.csv"):
        read_dhl(spark, contracts.DHL, str(folder))


def test_accounts_are_read_from_the_files(spark, tmp_path):
    for account, name in (("ca_1", "good.csv"), ("ca_2", "wrong.csv")):
        folder = tmp_path / "t" / "easypost" / account
        folder.mkdir(parents=True)
        (folder / name).write_text(",".join(f"n{i}" for i in range(33)) + "\n" + ",".join(["x, y".join('""')] + ["v"] * 31 + ["ca_1"]) + "\n")
    ups = tmp_path / "t" / "ups" / "U1"
    ups.mkdir(parents=True)
    (ups / "u.csv").write_text(",".join(["x", "y", "U1", *["z"] * 241]) + "\n")
    dhl = tmp_path / "t" / "dhl" / "ACC"
    dhl.mkdir(parents=True)
    (dhl / "d.csv").write_text(dhl_cells(c2="2025-01-02", c3="I", c4="ACC", c12="1", c14="1") + "\n" + dhl_cells(c2="ACC", c13="U") + "\n")
    (tmp_path / "t" / "acme" / "A").mkdir(parents=True)
    (tmp_path / "t" / "acme" / "A" / "x.csv").write_text("1,2\n")
    carriers = spark.createDataFrame([(1, "DHL"), (2, "USPS - Easy Post"), (3, "UPS")], "carrier_id int, carrier_name string")
    tracker = spark.createDataFrame([], "file_id bigint, file_name string, carrier_id int, created_at timestamp_ntz, completed_at timestamp_ntz")
    found = route_files(arrived(spark, str(tmp_path / "t" / "*" / "*")), carriers, tracker)
    assert {r.file_name: (r.found_account, r.error) for r in found.collect()} == {
        "good.csv": ("ca_1", None), "wrong.csv": ("ca_1", "account mismatch"), "u.csv": ("U1", None), "d.csv": ("ACC", None),
        "x.csv": (None, "unsupported carrier"),
    }


# --- ranges --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 3, 40, 500])
def test_few_and_many_ranges_agree(spark, monkeypatch, n):
    ranges = spark.range(n).select(
        (F.col("id") * 10).cast("decimal(12,2)").alias("range_min"),
        F.when(F.col("id") < n - 1, F.col("id") * 10 + 8).cast("decimal(12,2)").alias("range_max"), F.col("id").alias("name"))
    facts = spark.range(-20, 10 * n + 50).select(F.col("id").cast("decimal(18,2)").alias("v")).unionByName(
        spark.createDataFrame([(None,)], "v decimal(18,2)"))
    found = intervals.range_lookup(facts, "v", ranges, ["name"], "r_")
    assert "Join" not in plan_of(found) and "Exchange" not in plan_of(found).split("Subquery")[0]
    few = sorted((tuple(r) for r in found.collect()), key=str)
    monkeypatch.setattr(intervals, "INDEXED_RANGES", -1)
    assert sorted((tuple(r) for r in intervals.range_lookup(facts, "v", ranges, ["name"], "r_").collect()), key=str) == few


# --- intake ---------------------------------------------------------------------------------------------------


def test_wrong_account_is_refused(spark, tmp_path, loader):  # noqa: F811
    loader.account_of = lambda path: path.split("/")[-2]
    headers = [*contracts.EASYPOST.headers.values()]
    names = [*headers, *(f"n{i}" for i in range(32 - len(headers))), "account"]
    base = {"created_at": "2025-01-18T10:00:00Z", "carrier_account_id": "x", "service": "Ground", "carrier": "USPS", "postage_fee": "1", "account": "ca_1"}
    for account, code in (("ca_1", "A"), ("ca_2", "B")):
        inbox = tmp_path / "t" / "easypost" / account
        inbox.mkdir(parents=True)
        row = base | {"tracking_code": code}
        (inbox / f"{account}.csv").write_text(",".join(names) + "\n" + ",".join(row.get(n, "") for n in names) + "\n")
    with pytest.raises(Exception, match="account mismatch: expected ca_2, found ca_1"):
        run_stream(spark, loader, tmp_path / "t" / "easypost", tmp_path / "c")
    loader.skip_bad_files = True
    run_stream(spark, loader, tmp_path / "t" / "easypost", tmp_path / "c")
    assert [r.file_name for r in loader.store.read("tracker").collect()] == ["ca_1.csv"]
    assert ["account mismatch" in r.missing for r in loader.store.read("refused").collect()] == [True]


def test_bill_one_cent_off_publishes_nothing(spark, tmp_path):
    from waybill.plans.carriers import PLANS
    from waybill.streaming.arrivals import FileLoader

    types = spark.createDataFrame([(1, 3, "Transportation Cost")], "charge_type_id int, carrier_id int, charge_name string")
    loader = FileLoader(PLANS["dhl"], Store(spark, str(tmp_path / "store")), types, check_totals=True)  # noqa: F811
    inbox = tmp_path / "t" / "dhl" / "ACC"
    inbox.mkdir(parents=True)
    for name, total in (("good", "12.50"), ("off", "12.51")):
        top = dhl_cells(c2="2025-01-02", c3=name, c4="ACC", c12=total, c14="1")
        (inbox / f"{name}.csv").write_text(top + "\n" + dhl_cells(c2="ACC", c9="2025-01-01", c13=f"U{name}", c19="12345", c30="12.50") + "\n")
    arrivals = lambda: stream_files(spark, str(inbox), files_per_batch=10)
    with pytest.raises(Exception, match="its header says 12.51, its lines add up to 12.50"):
        ingest(loader, contracts.DHL, arrivals(), str(tmp_path / "c"), run_ts()).awaitTermination()
    assert loader.store.manifest() == {}
    loader.skip_bad_files = True
    ingest(loader, contracts.DHL, arrivals(), str(tmp_path / "c"), run_ts()).awaitTermination()
    assert [r.file_name for r in loader.store.read("tracker").collect()] == ["good.csv"]


def test_load_that_died_is_seen_and_run_again(spark, tmp_path, loader):  # noqa: F811
    from waybill.streaming import arrivals

    inbox = tmp_path / "t" / "easypost" / "ca_1"
    easypost_file(inbox, "1.csv", {"tracking_code": "A", "rate": "20"})
    before = arrivals.check_bills
    try:
        arrivals.check_bills = lambda bills: 1 / 0
        with pytest.raises(Exception, match="division"):
            run_stream(spark, loader, inbox, tmp_path / "c")
    finally:
        arrivals.check_bills = before
    assert [r.file_name for r in loader.unfinished().collect()] == ["1.csv"] and not loader.store.has("tracker")
    later = F.lit(dt.datetime(2026, 1, 2)).cast("timestamp_ntz")
    ingest(loader, contracts.EASYPOST, stream_files(spark, str(inbox)), str(tmp_path / "c"), later).awaitTermination()
    row = loader.store.read("tracker").first()
    assert row.created_at < row.completed_at == dt.datetime(2026, 1, 2) and loader.unfinished().count() == 0
    near = loader.summary_beside(spark.createDataFrame([(4, "a ")], "carrier_id int, tracking_number string"))
    assert [r.tracking_number for r in near.collect()] == ["A"] and "bucket#" in plan_of(near)
