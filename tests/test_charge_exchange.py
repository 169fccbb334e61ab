"""Charges are exchanged once."""

from __future__ import annotations

import re
from decimal import Decimal

from waybill.plans.carriers import EASYPOST
from waybill.plans.unify import shipment_charges


def test_charges_of_all_spellings_are_combined_by_one_exchange(spark):
    lines = spark.sql("""SELECT 4 AS carrier_id, CAST(1 AS BIGINT) AS file_id, bill AS bill_number, DATE '2024-01-01' AS bill_date, tracking AS tracking_code,
      CAST(1.5 AS DECIMAL(18,2)) AS rate, CAST(NULL AS DECIMAL(18,2)) AS label_fee, CAST(NULL AS DECIMAL(18,2)) AS postage_fee,
      CAST(NULL AS DECIMAL(18,2)) AS insurance_fee, CAST(2 AS DECIMAL(18,2)) AS carbon_offset_fee
      FROM VALUES ('b1', 't1'), ('B1 ', 'T1'), ('b1', 'T1 '), ('b1', ' '), ('b1', 't2') AS v(bill, tracking)""")
    types = spark.sql("SELECT CAST(i AS INT) AS charge_type_id, 4 AS carrier_id, n AS charge_name FROM VALUES (1, 'base rate '), (2, 'Carbon Offset Fee') AS v(i, n)")
    charges = shipment_charges(EASYPOST, lines, types)
    plan = charges._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(carrier_id", plan)) == 1
    rows = sorted((r.bill_number, r.tracking_number, r.charge_type_id, r.amount) for r in charges.collect())
    assert rows == [
        ("B1 ", "T1", 1, Decimal("4.50")), ("B1 ", "T1", 2, Decimal("6.00")), ("b1", "t2", 1, Decimal("1.50")), ("b1", "t2", 2, Decimal("2.00")),
    ]
