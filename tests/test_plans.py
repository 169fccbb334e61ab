from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from waybill.operators.merge import DuplicateKeys
from waybill.plans import adapter, gold, multipiece, quality, thresholds, variance
from waybill.plans.carriers import EASYPOST, ELITEWORKS, FEDEX, FLAVORCLOUD, UNIUNI, UPS
from waybill.plans.normalise import check_bills, invoice_rollup, normalise, typed_lines
from waybill.plans.reference import discover_carriers, discover_methods
from waybill.plans.unify import (
    new_charges, shipment_attributes, shipment_charges, shipment_summary, upsert_attributes,
)
from waybill.sources import contracts


def staging(contract):
    return ["file_id", *contract.columns]


@pytest.fixture
def fedex(text_rows):
    base = {"file_id": 1, "invoice_number": "I1", "invoice_date": "20240115", "account_number": "594"}

    def make(*rows):
        return text_rows(staging(contracts.FEDEX), *[{**base, **r} for r in rows])

    return make


def types(spark, *rows):
    return spark.createDataFrame(list(rows), "charge_type_id int, carrier_id int, charge_name string, freight boolean, charge_category_id int")


GROUP = [
    {"express_or_ground_tracking_id": "MPS100", "net_charge_amount": "150.00", "transportation_charge_amount": "150.00", "shipment_date": "20240115",
     "service_type": "Ground", "zone_code": "5", "dim_length": "30"},
    {"express_or_ground_tracking_id": "MPS100", "msp_tracking_id": "MPS100", "dim_length": "10"},
    {"express_or_ground_tracking_id": "MPS100", "msp_tracking_id": "PKG001", "dim_length": "12"},
    {"express_or_ground_tracking_id": "MPS100", "msp_tracking_id": "PKG002", "dim_length": "8"},
]
SINGLE = {"express_or_ground_tracking_id": "TRK001", "net_charge_amount": "50.00", "transportation_charge_amount": "50.00", "shipment_date": "20240115",
          "service_type": "Ground", "zone_code": "5", "dim_length": "10"}


@pytest.mark.parametrize("hot_rows", [1, multipiece.HOT_ROWS])
def test_multipiece_roles(fedex, hot_rows):
    lines = typed_lines(FEDEX, fedex(*GROUP, SINGLE))
    got = {(r.express_or_ground_tracking_id, r.msp_tracking_id): (r.mps_role, r.group_zone_code, r.group_service_type)
           for r in multipiece.with_roles(lines, hot_rows=hot_rows).collect()}
    assert got == {
        ("MPS100", None): ("MPS_HEADER", "5", "Ground"), ("MPS100", "MPS100"): ("MPS_PARENT", "5", "Ground"),
        ("MPS100", "PKG001"): ("MPS_CHILD", "5", "Ground"), ("MPS100", "PKG002"): ("MPS_CHILD", "5", "Ground"),
        ("TRK001", None): ("NORMAL_SINGLE", "5", "Ground"),
    }


def test_multipiece_golden_case(spark, fedex):
    lines = typed_lines(FEDEX, fedex(*GROUP))
    attributes = shipment_attributes(FEDEX, lines)
    assert {(r.tracking_number, r.billed_length_in, str(r.shipment_date)) for r in attributes.collect()} == {
        (t, D(v), "2024-01-15 00:00:00") for t, v in (("MPS100", "10.00"), ("PKG001", "12.00"), ("PKG002", "8.00"))
    }
    known = types(spark, (1, 1, "transportation charge", True, 11))
    charges = shipment_charges(FEDEX, lines, known)
    cost = {r.tracking_number: r.billed_shipping_cost for r in shipment_summary(attributes, charges).collect()}
    assert cost == {"MPS100": D("150.00"), "PKG001": D("0.00"), "PKG002": D("0.00")}


def test_group_without_parent_loses_its_charges_visibly(spark, fedex):
    orphaned = [GROUP[0], GROUP[2], GROUP[3]]
    bills, lines = normalise(FEDEX, fedex(*orphaned))
    known = types(spark, (1, 1, "Transportation Charge", True, 11))
    assert shipment_charges(FEDEX, lines, known).count() == 0
    lost = spark.createDataFrame([(1, 1, "I1", dt.date(2024, 1, 15), "MPS100", 1, D("150.00"))],
                                 "carrier_id int, file_id bigint, bill_number string, bill_date date, tracking_number string, charge_type_id int, amount decimal(18,2)")
    report = quality.orphan_charges(lost, shipment_attributes(FEDEX, lines), bills).first()
    assert (report.without_shipment_charges, report.without_shipment_amount, report.without_invoice_charges) == (1, D("150.00"), 0)


def test_shipment_numbers_equal_attributes(fedex):
    lines = typed_lines(FEDEX, fedex(*GROUP, SINGLE, {**SINGLE, "express_or_ground_tracking_id": "TRK002", "msp_tracking_id": "PK9"}))
    light = {r.tracking_number for r in multipiece.shipment_numbers(lines).collect()}
    assert light == {r.tracking_number for r in shipment_attributes(FEDEX, lines).collect()}


def test_fedex_rollup_counts_all_lines(fedex):
    got = invoice_rollup(FEDEX, fedex(*GROUP, {**SINGLE, "net_charge_amount": "1,050.00"}, {**SINGLE, "invoice_number": " "})).collect()
    assert [(r.bill_number, r.bill_date, r.total_amount, r.num_shipments, r.account_number) for r in got] == [
        ("I1", dt.date(2024, 1, 15), D("1200.00"), 5, "594")
    ]


def easypost(text_rows, *rows):
    base = {"file_id": 1, "created_at": "2025-01-18T10:00:00Z", "carrier_account_id": "ca_1", "service": "Ground", "carrier": "USPS"}
    return text_rows(staging(contracts.EASYPOST), *[{**base, **r} for r in rows])


EP_TYPES = [(1, 4, "Base Rate", True, 11), (2, 4, "Label Fee", False, 11), (3, 4, "Unknown Charges", False, 11)]


def no_refs(spark):
    return {
        "methods": spark.createDataFrame([], "shipping_method_id int, carrier_id int, method_name string, integrated_carrier_id int"),
        "carriers": spark.createDataFrame([], "carrier_id int, carrier_name string"),
    }


def test_synthetic_invoice_number(text_rows):
    got = invoice_rollup(EASYPOST, easypost(text_rows, {"tracking_code": "T1", "postage_fee": "5"}, {"tracking_code": "T2", "carrier_account_id": None}))
    assert {(r.bill_number, r.total_amount, r.num_shipments) for r in got.collect()} == {
        ("ca_1-2025-01-18", D("5.00"), 1), ("-2025-01-18", D("0.00"), 1)
    }


def test_corrections_accumulate(spark, text_rows):
    known = types(spark, *EP_TYPES)
    files = [("20", "25"), ("3", "3"), ("-2", "-2")]
    charges, seen = None, []
    for i, (rate, postage) in enumerate(files):
        lines = typed_lines(EASYPOST, easypost(text_rows, {"file_id": i, "tracking_code": "ABC123", "rate": rate, "postage_fee": postage}))
        found = shipment_charges(EASYPOST, lines, known)
        again = found if charges is None else charges.unionByName(new_charges(found, charges))
        # a second delivery of the same file adds nothing
        charges = again.unionByName(new_charges(found, again))
        attributes = shipment_attributes(EASYPOST, lines, **no_refs(spark))
        seen.append(shipment_summary(attributes, charges).first().billed_shipping_cost)
    assert seen == [D("25.00"), D("28.00"), D("26.00")]


def test_duplicate_charge_lines_are_summed_or_refused(spark, text_rows):
    lines = typed_lines(EASYPOST, easypost(text_rows, {"tracking_code": "A", "rate": "2", "postage_fee": "2"}, {"tracking_code": "A", "rate": "3", "postage_fee": "3"}))
    known = types(spark, *EP_TYPES)
    assert [r.amount for r in shipment_charges(EASYPOST, lines, known).collect()] == [D("5.00")]
    with pytest.raises(DuplicateKeys):
        shipment_charges(EASYPOST, lines, known, on_duplicate="error")


def test_eliteworks_one_invoice_per_file(text_rows):
    base = {"tracking_number": "E1", "platform_charged_with_corrections": "4.50", "user_account": "u"}
    rows = text_rows(
        staging(contracts.ELITEWORKS), {**base, "file_id": 1, "time_utc": "2026-02-01 10:00:00"}, {**base, "file_id": 1, "time_utc": "2026-02-03 09:00:00"},
        {**base, "file_id": 2, "time_utc": "2026-01-01 00:00:00"}, {**base, "file_id": 3, "time_utc": " "},
    )
    bills, lines = normalise(ELITEWORKS, rows)
    assert {(r.file_id, r.bill_number, r.total_amount) for r in bills.collect()} == {(1, "Eliteworks_2026-02-03", D("9.00")), (2, "Eliteworks_2026-01-01", D("4.50"))}
    assert {(r.file_id, r.bill_number) for r in lines.collect()} == {(1, "Eliteworks_2026-02-03"), (2, "Eliteworks_2026-01-01")}


def test_ups_consolidation_and_corrections(spark, text_rows):
    base = {"invoice_number": "U1", "invoice_date": "2026-01-15", "tracking_number": "1Z1", "charge_category_detail_code": "X"}
    rows = text_rows(
        staging(contracts.UPS),
        {**base, "file_id": 1, "charge_description": "UPS Ground", "charge_category_code": "SHP", "charge_classification_code": "FRT", "net_amount": "10",
         "billed_weight": "2", "billed_weight_unit": "L", "package_dimensions": "11.0x 8.0x 3.0", "transaction_date": "2026-01-10"},
        {**base, "file_id": 1, "charge_description": "Fuel", "charge_category_code": "ACC", "charge_classification_code": "FSC", "net_amount": "1.5", "billed_weight": "0", "zone": "002"},
        {**base, "file_id": 2, "charge_description": "Correction", "charge_category_code": "ADJ", "charge_classification_code": "ACC", "net_amount": "3",
         "billed_weight": "5", "billed_weight_unit": "L", "transaction_date": "2026-02-10"},
        {**base, "file_id": 1, "charge_description": "Service", "charge_category_code": "ACC", "charge_classification_code": "ACC", "net_amount": "7", "tracking_number": None},
    )
    bills, lines = normalise(UPS, rows)
    assert {(r.file_id, r.total_amount, r.num_shipments) for r in bills.collect()} == {(1, D("18.50"), 1), (2, D("3.00"), 1)}
    row = shipment_attributes(UPS, lines).first()
    assert (row.shipping_method, str(row.shipment_date), row.destination_zone, row.billed_weight_oz, row.billed_length_in) == (
        "UPS Ground", "2026-01-10 00:00:00", "002", D("80.00"), D("11.00"))
    loose = quality.invoice_level_charges(UPS, lines).first()
    assert (loose.charge_name, loose.amount) == ("Service - ACC", D("7.00"))
    # a known shipment keeps method and date, takes corrected measures, and nothing is erased by NULL
    old = shipment_attributes(UPS, lines.where("file_id = 1"))
    new = upsert_attributes(UPS, old, shipment_attributes(UPS, lines.where("file_id = 2"))).first()
    assert (new.shipping_method, new.billed_weight_oz, new.billed_length_in, new.destination_zone) == ("UPS Ground", D("80.00"), D("11.00"), "002")


def test_uniuni_two_merchants_on_one_invoice(text_rows):
    base = {"file_id": 1, "invoice_number": "123", "invoice_time": "2026-02-15", "total_billed_amount": "12.55"}
    rows = text_rows(staging(contracts.UNIUNI), {**base, "merchant_id": "A", "tracking_number": "1"}, {**base, "merchant_id": "B", "tracking_number": "2"})
    bills = invoice_rollup(UNIUNI, rows)
    assert bills.count() == 2
    with pytest.raises(DuplicateKeys, match="invoices"):
        check_bills(bills)


def test_aggregator_sync_is_stable(spark, text_rows):
    lines = typed_lines(EASYPOST, easypost(
        text_rows, {"tracking_code": "1", "carrier": "FedEx"}, {"tracking_code": "2", "carrier": "fedex "}, {"tracking_code": "3", "carrier": None}, {"tracking_code": "4", "carrier": "NewCo"}))
    carriers = spark.createDataFrame([(1, "FEDEX")], "carrier_id int, carrier_name string")
    assert [r.carrier_name for r in discover_carriers(lines, carriers).collect()] == ["NewCo"]
    none = no_refs(spark)["methods"]
    first = discover_methods(EASYPOST, lines, none, carriers)
    assert {(r.method_name, r.integrated_carrier_id, r.service_level) for r in first.collect()} == {("Ground", 1, "Standard"), ("Ground", None, "Standard")}
    # a method without a known carrier is not added again
    assert discover_methods(EASYPOST, lines, first, carriers).count() == 0


PACKAGE = "shipment_package_id bigint, tracking_number string, billed_weight_oz decimal(18,2), actual_weight_oz decimal(18,2), wms_shipping_cost decimal(18,2), billed_shipping_cost decimal(18,2)"


def test_fixed_variance(spark):
    rows = [
        (1, "in", D(10), D(10), D("10.00"), D("11.00")), (2, "high", D(20), D(15), D("10.00"), D("11.01")), (3, "low", D(10), D(10), D("10.00"), D("8.99")),
        (4, "null cost", D(10), D(10), None, D("5.00")), (5, "light", D("5"), D("9.5"), D("1.00"), D("2.00")), (6, "no weight", None, None, D("1.00"), D("2.00")),
    ]
    got = {r.tracking_number: r for r in variance.fixed_variance(spark.createDataFrame(rows, PACKAGE)).collect()}
    assert set(got) == {"high", "low", "light", "no weight"}
    assert (got["high"].cost_exception_type, got["high"].weight_exception_type, got["high"].weight_variance_percent) == ("cost_high", "weight_high", D("25.00"))
    assert (got["low"].cost_exception_type, got["low"].is_weight_exception) == ("cost_low", 0)
    assert (got["light"].weight_exception_type, got["light"].actual_weight_oz) == ("weight_low", D("10.00"))
    assert (got["no weight"].weight_exception_type, got["no weight"].weight_variance_percent) == ("Normal", D("100.00"))


RANGES = [("cost", 0, 50, "pct", 15, None), ("cost", 50, None, "abs", 8, None), ("weight", 0, 16, "abs", 2, "oz"), ("weight", 16, None, "pct", 10, "lb")]


def ranges(spark, rows=RANGES):
    data = [(m, D(a), None if b is None else D(b), t, D(str(v)), u) for m, a, b, t, v, u in rows]
    return spark.createDataFrame(data, thresholds.RANGE_FIELDS)


def test_dynamic_variance(spark):
    rows = [
        (1, "pct in", D(10), D(10), D("10.00"), D("11.50")), (2, "pct out", D(10), D("12.01"), D("10.00"), D("11.51")), (3, "abs in", D(17), D(15), D("60.00"), D("68.00")),
        (4, "abs out", D(17), D(15), D("60.00"), D("68.01")), (5, "no expected", D(17), D(15), None, D("68.01")),
    ]
    got = {r.tracking_number: r for r in variance.dynamic_variance(spark.createDataFrame(rows, PACKAGE), ranges(spark)).collect()}
    assert set(got) == {"pct out", "abs out"}
    assert (got["pct out"].weight_exception_type, got["pct out"].weight_variance) == ("weight_low", D("-2.01"))
    # 17 oz against 15 oz is two pounds against one
    assert (got["abs out"].billed_weight_cmp, got["abs out"].actual_weight_cmp, got["abs out"].weight_exception_type) == (D("2.0000"), D("1.0000"), "weight_high")


@pytest.mark.parametrize("row,issue", [
    (("volume", 0, 1, "pct", 1, None), "metric_type"), (("cost", 0, 1, "rel", 1, None), "threshold_type"), (("weight", 0, 1, "pct", 1, None), "weight_unit_required"),
    (("cost", 0, 1, "pct", 1, "oz"), "weight_unit_on_cost"), (("cost", 5, 5, "pct", 1, None), "range_order"), (("cost", 0, 1, "pct", 0, None), "threshold_value"),
    (("cost", -1, 1, "pct", 1, None), "range_min"),
])
def test_threshold_rules(spark, row, issue):
    frame = ranges(spark, [row]).withColumn("id", F.lit(1))
    assert [r.issue for r in thresholds.issues([], frame, "id").collect()] == [issue]
    with pytest.raises(thresholds.InvalidThresholds, match=issue):
        thresholds.replace_config(frame, "id")


def test_threshold_versions(spark):
    config = ranges(spark).withColumn("scope", F.lit("all"))
    header = {"version_id": F.lit(1), "effective_date": F.lit("2026-01-01").cast("date")}
    versions, stored = thresholds.migrate_to_versions(config, ["scope"], header)
    tighter = ranges(spark, [("cost", 0, None, "pct", 5, None)]).withColumn("scope", F.lit("all"))
    versions, stored = thresholds.save_version(versions, stored, tighter, ["scope"], {"version_id": F.lit(2), "effective_date": F.lit("2026-02-01").cast("date")})
    assert {(r.version_id, r.is_active) for r in versions.collect()} == {(1, False), (2, True)}
    target = spark.createDataFrame([("all", 1)], "scope string, version_id int")
    versions, stored = thresholds.rollback(versions, stored, ["scope"], target, {"version_id": F.lit(3), "effective_date": F.lit("2026-03-01").cast("date")})
    counted = {(r.version_id, r.is_active, r.total_ranges, r.cost_ranges) for r in thresholds.history(versions, stored, ["scope"]).collect()}
    assert counted == {(1, False, 4, 2), (2, False, 1, 1), (3, True, 4, 2)}
    assert thresholds.ranges_on(versions, stored, ["scope"], F.lit("2026-02-15").cast("date")).count() == 1


def test_markup_labels_and_prices(spark):
    methods = spark.createDataFrame([(101, 1, "Ground", None), (102, 5, "Ground", 1)], "shipping_method_id int, carrier_id int, method_name string, integrated_carrier_id int")
    carriers = spark.createDataFrame([(1, "FedEx"), (5, "Eliteworks")], "carrier_id int, carrier_name string")
    got = {r.shipping_method_id: (r.carrier_label, r.method_label, r.invoice_carrier_name) for r in gold.with_display_names(methods, carriers).collect()}
    assert got == {101: ("FedEx", "FedEx Ground", "FedEx"), 102: ("Eliteworks (FedEx)", "Eliteworks (FedEx) Ground", "FedEx")}
    items = spark.createDataFrame([(101, D("10.00")), (7, D("3.00"))], "shipping_method_id int, amount decimal(18,2)")
    markups = spark.createDataFrame([(101, D("15.0000"))], "shipping_method_id int, markup decimal(18,4)")
    assert sorted(r.customer_price for r in gold.marked_up(items, markups).collect()) == [D("3.00"), D("11.50")]
    assert sorted(r.customer_price for r in gold.marked_up(items, markups.withColumn("markup", F.expr("0.15BD").cast("decimal(18,4)")), as_fraction=True).collect()) == [D("3.00"), D("11.50")]


def test_default_markup_is_the_latest_active(spark):
    defaults = spark.createDataFrame(
        [(1, D(5), dt.datetime(2026, 1, 1), None), (2, D(7), dt.datetime(2026, 2, 1), dt.datetime(2026, 3, 1)), (3, D(6), dt.datetime(2026, 1, 1), None)],
        "id int, markup decimal(18,4), created_at timestamp, deleted_at timestamp")
    assert gold.latest_default_markup(defaults).first().markup == D(6)


def test_total_tolerance(spark, text_rows):
    base = {"file_id": 1, "invoice_number": "F1", "invoice_date": "Jan 25, 2026", "shipment_date": "01-22-2026", "due_date": "01-26-2026"}
    amounts = ["60.89", "74.16", "78.57", "21.92", "49.13", "13.97", "73.8"]
    rows = text_rows(
        staging(contracts.FLAVORCLOUD),
        *[{**base, "shipment_number": f"S{i}", "shipping_charges": a, "shipment_total_charges": a} for i, a in enumerate(amounts)],
        {"file_id": 1, "invoice_number": "Total", "shipment_number": "", "shipping_charges": "163.69"}, {"file_id": 1, "invoice_number": "Amount Due", "invoice_date": "372.44"},
    )
    bills, lines = normalise(FLAVORCLOUD, rows)
    only = bills.collect()
    assert [(r.total_amount, r.num_shipments) for r in only] == [(D("372.44"), 7)]
    known = types(spark, (1, 6, "Shipping Charges (USD)", True, 11))
    charges = shipment_charges(FLAVORCLOUD, lines, known)
    assert quality.totals_by_file(FLAVORCLOUD, rows, bills, charges).first().all_equal is True
    assert quality.component_mismatches(lines, ["shipping_charges", "commissions", "landed_cost", "insurance"], "shipment_total_charges", ["tracking_number"]).count() == 0


def test_adapter_rejects_unreadable_cells(text_rows):
    columns = [c for c in contracts.EASYPOST.columns]
    rows = text_rows(columns, {"tracking_code": "ok", "created_at": "1/2/06", "carrier_account_id": "ca", "rate": "1.5"},
                     {"tracking_code": "bad", "created_at": "yesterday", "carrier_account_id": "ca"}, {"tracking_code": "num", "created_at": "", "weight": "heavy"})
    got = {r.tracking_code: (r.reject, r.invoice_number) for r in adapter.parse_rows(rows).collect()}
    assert got == {"ok": (None, "ca-2006-01-02"), "bad": ("created_at", "ca-"), "num": ("weight", "-")}
    details = adapter.bill_details(adapter.parse_rows(rows))
    assert details.count() == 1
    assert adapter.account_mismatches(details, F.lit("other")).count() == 1
    assert adapter.account_mismatches(details, F.lit("ca")).count() == 0
