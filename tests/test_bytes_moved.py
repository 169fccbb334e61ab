"""What jobs write and exchange for a line: one row of charges, few numbers of a trial line, packed files."""

from __future__ import annotations

import glob
from decimal import Decimal as D

from pyspark.sql import functions as F

from waybill.plans.carriers import DHL, EASYPOST, ELITEWORKS, FEDEX, FLAVORCLOUD, UNIUNI
from waybill.plans.gold import cost_ledger
from waybill.plans.load_gold import FEW_BUCKETS, layouts
from waybill.plans.normalise import invoice_rollup
from waybill.plans.unify import shipment_charges
from waybill.session import BILLING_SETTINGS
from waybill.sources import contracts
from waybill.sources.files import read_named
from waybill.sources.store import Store
from waybill.workload import file_queries
from waybill.workload.fixtures import delivered


def _plan(frame, optimized=False):
    execution = frame._jdf.queryExecution()
    return (execution.optimizedPlan() if optimized else execution.executedPlan()).toString()


def _lines(spark):
    return spark.sql("""SELECT 4 AS carrier_id, CAST(1 AS BIGINT) AS file_id, bill AS bill_number, DATE '2024-01-01' AS bill_date, t AS tracking_code,
      CAST(rate AS DECIMAL(18,2)) AS rate, CAST(label AS DECIMAL(18,2)) AS label_fee, CAST(postage AS DECIMAL(18,2)) AS postage_fee,
      CAST(0 AS DECIMAL(18,2)) AS insurance_fee, CAST(NULL AS DECIMAL(18,2)) AS carbon_offset_fee
      FROM VALUES ('b', 'T1', 2, 1, 2), ('B', 't1 ', 3, -1, 3), ('b', 't2', 0, NULL, 0), ('b', NULL, 9, 9, 9), ('b', 't3', 1, 0, NULL), (NULL, 't4', 5, 0, 6)
      AS v(bill, t, rate, label, postage)""")


def _types(spark, *rows):
    return spark.createDataFrame(list(rows), "charge_type_id int, carrier_id int, charge_name string")


def test_charges_side_by_side(spark):
    types = _types(spark, (1, 4, "base rate "), (2, 4, "Label Fee"), (3, 4, "UNKNOWN CHARGES"), (4, 5, "Insurance Fee"))
    charges = shipment_charges(EASYPOST, _lines(spark), types)
    rows = sorted(((r.bill_number, r.tracking_number, r.charge_type_id, r.amount) for r in charges.collect()), key=str)
    # fees that cancel each other are a charge of zero, as before; zero or missing ones are none
    assert rows == sorted([("B", "T1", 1, D("5.00")), ("B", "T1", 2, D("0.00")), ("b", "t3", 1, D("1.00")), (None, "t4", 1, D("5.00")), (None, "t4", 3, D("1.00"))], key=str)
    plan = _plan(charges)
    assert plan.index("Generate stack") < plan.index("Exchange hashpartitioning(carrier_id")


def test_names_of_one_type_add_up(spark):
    types = _types(spark, (1, 4, "Base Rate"), (1, 4, "Unknown Charges"))
    got = {r.tracking_number: r.amount for r in shipment_charges(EASYPOST, _lines(spark), types).collect()}
    assert got == {"T1": D("5.00"), "t3": D("1.00"), "t4": D("6.00")}


def test_named_charges_are_the_charges(spark):
    for plan in (DHL, EASYPOST, ELITEWORKS, FLAVORCLOUD, UNIUNI):
        labels = [r[0] for r in spark.range(1).select(F.array(*[label for label, _ in plan.charges()])).collect()]
        assert labels == [list(plan.named_charges)] and len({n.lower() for n in plan.named_charges}) == len(plan.named_charges)
    assert not FEDEX.named_charges


def test_invoices_are_exchanged_once(spark, text_rows):
    names = ["file_id", *contracts.FEDEX.ordinals]
    row = {"file_id": 1, "invoice_date": "2024-01-01"}
    rows = text_rows(names, *[{**row, "invoice_number": n, "net_charge_amount": "1,000.50", "account_number": a} for n, a in (("i1", "7"), ("I1 ", "8"), ("i2", None))])
    bills = invoice_rollup(FEDEX, rows)
    assert _plan(bills).count("Exchange") == 1
    assert sorted((r.bill_number, r.account_number, r.total_amount, r.num_shipments) for r in bills.collect()) == [
        ("I1", "8", D("2001.00"), 2), ("i2", None, D("1000.50"), 1)]


def test_few_buckets_are_written_without_an_exchange(spark, tmp_path):
    assert not layouts()["charges"].gathered and layouts(FEW_BUCKETS + 1)["charges"].gathered
    rows = spark.range(0, 400, 1, 4).select("id", F.col("id").alias("file_id"))
    kept = {}
    for n in (4, FEW_BUCKETS + 1):
        store = Store(spark, f"{tmp_path}/s{n}", layouts(n))
        store.publish(append={"charges": rows})
        kept[n] = len(glob.glob(f"{tmp_path}/s{n}/data/charges/*/*/*.parquet"))
        assert store.read("charges").agg(F.count("id"), F.sum("id")).head()[:] == (400, 79800)
        assert store.read_beside("charges", rows.where("id = 7")).where("id = 7").count() == 1
    assert kept[4] == 16  # each of four tasks writes into each bucket itself
    assert BILLING_SETTINGS["spark.sql.parquet.compression.codec"] == "zstd"


def test_ledger_charges_travel_without_texts(spark):
    charges = spark.sql("""SELECT 4 AS carrier_id, CAST(1 AS BIGINT) AS file_id, 'b' AS bill_number, DATE '2024-01-01' AS bill_date, 't' AS tracking_number,
      id AS charge_type_id, CAST(1 AS DECIMAL(18,2)) AS amount FROM VALUES (1), (2), (9) AS v(id)""")
    attributes = spark.sql("SELECT 4 AS carrier_id, 'T' AS tracking_number, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS shipment_date, 'm' AS shipping_method, CAST(NULL AS INT) AS integrated_carrier_id")
    methods = spark.sql("SELECT 4 AS carrier_id, 'M' AS method_name, CAST(NULL AS INT) AS integrated_carrier_id, 5 AS shipping_method_id")
    types = spark.sql("SELECT id AS charge_type_id, 4 AS carrier_id, 'n' || id AS charge_name, 11 AS charge_category_id FROM VALUES (1), (2) AS v(id)")
    categories = spark.sql("SELECT 11 AS category_id, 'Standard' AS category")
    packages = spark.sql("""SELECT CAST(3 AS BIGINT) AS shipment_package_id, CAST(3 AS BIGINT) AS shipment_id, 't' AS tracking_number, CAST(1 AS DECIMAL(18,2)) AS actual_weight_oz,
      CAST(1 AS DECIMAL(18,2)) AS wms_shipping_cost, CAST(1 AS DECIMAL(18,2)) AS billed_weight_oz, CAST(1 AS DECIMAL(18,2)) AS billed_shipping_cost""")
    shipments = spark.sql("SELECT CAST(3 AS BIGINT) AS shipment_id, CAST(3 AS BIGINT) AS order_id, CAST(8 AS BIGINT) AS external_id")
    orders = spark.sql("SELECT CAST(3 AS BIGINT) AS order_id, CAST(6 AS BIGINT) AS customer_id")
    ledger = cost_ledger(charges, attributes, methods, types, categories, packages, shipments, orders)
    assert sorted((r.charge_type_id, r.category, r.cost_item, r.shipment_package_id, r.customer_id, r.shipping_method_id) for r in ledger.collect()) == [
        (1, "Standard", "n1", 3, 6, 5), (2, "Standard", "n2", 3, 6, 5)]
    known = cost_ledger(charges, attributes, methods, types, categories, packages, shipments, orders, ledger.where("charge_type_id = 1"))
    assert [r.charge_type_id for r in known.collect()] == [2]
    head = _plan(ledger, optimized=True).splitlines()[1]
    assert "Join Inner" in head and "charge_type_id" in head  # the last join of all


def test_trial_lines_are_dealt_out_as_numbers(spark, tmp_path):
    folder = f"{tmp_path}/tables"
    spark.sql("""SELECT CAST(IF(id % 50 = 49, NULL, id div 4) AS BIGINT) AS l_orderkey, id % 9 + 1 AS l_partkey, id % 7 + 1 AS l_suppkey, CAST(id % 4 + 1 AS INT) AS l_linenumber,
      CAST(id % 5 + 1 AS DOUBLE) AS l_quantity, CAST(id + 0.5 AS DOUBLE) AS l_extendedprice, 0.05D AS l_discount, 0.02D AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus,
      TIMESTAMP_NTZ '2024-01-01 00:00:00' AS l_shipdate FROM range(400)""").write.parquet(f"{folder}/lineitem.parquet")
    for name, deliveries in (("stg_easypost", 8), ("stg_corrections", 4)):
        rows = delivered(spark, folder, name, 20)
        plan = _plan(rows)
        assert plan.count("Exchange") == 1 and "concat" not in plan[plan.index("Exchange"):]  # no text is exchanged
        plain = file_queries.relation(spark, folder, name)
        assert sorted(map(str, rows.collect())) == sorted(map(str, plain.collect()))
        out = f"{tmp_path}/{name}"
        file_queries.write_delivery(rows.where("file_id is not null"), contracts.EASYPOST, out)
        files = glob.glob(f"{out}/file_id=*/*.csv.gz")
        assert len({f.split("/")[-2] for f in files}) == deliveries and len(files) > deliveries
        read = file_queries.with_file_id(read_named(spark, contracts.EASYPOST, f"{out}/*"))
        number = F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1)
        assert read.count() == plain.where("file_id is not null").count()
        of = read_named(spark, contracts.EASYPOST, f"{out}/*").where("trim(tracking_code) <> ''").withColumn("n", number)
        whole = of.groupBy(F.regexp_extract("file_path", r"file_id=(\d+)/", 1), "tracking_code").agg(F.count_distinct("n").alias("n"))
        assert whole.where("n > 1").isEmpty()
