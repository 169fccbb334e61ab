"""Large deliveries come in several files, each written by a task of its own."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from waybill.session import BILLING_SETTINGS, configure, shuffles_deleted
from waybill.sources import contracts
from waybill.sources.files import read_named
from waybill.sources.store import Store
from waybill.workload import file_queries, queries
from waybill.workload.fixtures import spread


def _easypost(text_rows, n=60):
    columns = ["file_id", *contracts.EASYPOST.headers]
    return text_rows(columns, *[
        {"file_id": i % 2 + 1, "tracking_code": None if i % 10 == 0 else f"{'t' if i % 4 else 'T'}{i // 4} ", "rate": f"{i}.50", "created_at": "2024-01-01T00:00:00Z"}
        for i in range(n)
    ])


def test_large_delivery_comes_in_files_of_whole_shipments(spark, tmp_path, text_rows, monkeypatch):
    monkeypatch.setattr(file_queries, "FILE_LINES", 5)
    rows, out = _easypost(text_rows), f"{tmp_path}/easypost"
    file_queries.write_named(rows, contracts.EASYPOST, out)
    for number in (1, 2):
        assert 1 < len(glob.glob(f"{out}/file_id={number}/*.csv")) <= 6
    read = read_named(spark, contracts.EASYPOST, f"{out}/*")
    back = file_queries.with_file_id(read).select("file_id", "tracking_code", "rate")
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.select("file_id", F.trim("tracking_code").alias("tracking_code"), "rate").collect()))
    spelled = read.where("tracking_code is not null").select("file_path", F.regexp_extract("file_path", r"file_id=(\d+)/", 1).alias("f"), F.lower("tracking_code").alias("t"))
    assert spelled.groupBy("f", "t").agg(F.count_distinct("file_path").alias("n")).where("n > 1").isEmpty()


def test_dhl_delivery_of_several_files_is_one_invoice(spark, text_rows, monkeypatch):
    names = ["file_id", *contracts.DHL.ordinals]
    rows = text_rows(names, *[
        {"file_id": 2 + i % 2, "invoice_number": "D", "invoice_date": "2024-01-01", "account_number": "7", "shipping_date": "2024-01-01",
         "unique_id": f"U{i}", "recipient_country": "US", "recipient_zip_postal_code": "02139", "transportation_cost": "1.25"}
        for i in range(40)
    ])
    monkeypatch.setattr(file_queries, "staged", lambda *_: rows)
    monkeypatch.setattr(file_queries, "FILE_LINES", 4)
    headers, details = file_queries.dhl_with_header(spark, "")
    assert headers.count() > 2 and details.count() == 40
    got = queries.QUERIES["dhl_header_total"].job(spark, "").orderBy("file_id").collect()
    assert [(r["file_id"], float(r["header_total"]), float(r["detail_total"]), r["agrees"]) for r in got] == [(2, 25.0, 25.0, True), (3, 26.0, 25.0, False)]


def test_mixed_case_plan_stays_small(spark, text_rows, monkeypatch):
    monkeypatch.setattr(queries, "staged", lambda *_: _easypost(text_rows))
    charges = queries.QUERIES["charges_mixed_case"].job(spark, "")
    assert "xxhash64" not in charges._jdf.queryExecution().optimizedPlan().toString()


def test_store_deletes_the_shuffles_of_its_writes(spark, tmp_path, monkeypatch):
    seen, write = [], Store._write_rows

    def watched(self, table, frame, folder):
        seen.append(spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"))
        write(self, table, frame, folder)

    monkeypatch.setattr(Store, "_write_rows", watched)
    store = Store(spark, f"{tmp_path}/store")
    store.publish(append={"t": spark.range(9).groupBy((F.col("id") % 3).alias("k")).count()})
    assert seen == ["true"] and store.read("t").count() == 3
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    with shuffles_deleted(spark):
        pass
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == before


def test_large_splits_are_dealt_out(spark):
    rows = spark.range(0, 1000, 1, 16)
    assert spread(rows, 1000).rdd.getNumPartitions() == 16
    assert spread(rows, 25).rdd.getNumPartitions() == 40


def test_billing_settings_end_with_billing_jobs(spark):
    before = {n: spark.conf.get(n, None) for n in BILLING_SETTINGS}
    try:
        configure(spark, billing=True)
        assert all(spark.conf.get(n) == v for n, v in BILLING_SETTINGS.items())
        configure(spark)
        assert all(spark.conf.get(n, None) != v for n, v in BILLING_SETTINGS.items())
    finally:
        for n, v in before.items():
            spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def test_deliveries_are_counted_in_one_pass(spark, text_rows, monkeypatch):
    # a delivery's lines are made from whole tables, so each count of its files makes them again
    table = _easypost(text_rows)
    kind, counted = type(table), []
    count = kind.count
    monkeypatch.setattr(kind, "count", lambda self: counted.append(self) or count(self))
    rows, parts, deliveries = file_queries.in_files(table, lines=10)
    dealt = file_queries.dealt(rows, parts, deliveries)
    assert (parts, deliveries, counted) == (3, 2, []) and dealt.rdd.getNumPartitions() == 6
    assert file_queries.in_files(table.limit(0))[1:] == (1, 0)
