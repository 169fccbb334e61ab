"""The largest charge with the total of its shipment alone."""

from __future__ import annotations

from decimal import Decimal

from waybill.plans.quality import largest_charge

_COLUMNS = "carrier_id, file_id, bill_number, bill_date, tracking_number, charge_type_id, CAST(amount AS DECIMAL(18,2)) AS amount"


def _charges(spark, values: str):
    return spark.sql(f"SELECT {_COLUMNS} FROM VALUES {values} AS v(carrier_id, file_id, bill_number, bill_date, tracking_number, charge_type_id, amount)")


def test_total_is_of_the_first_shipment_alone(spark):
    types = spark.sql("SELECT * FROM VALUES (1, 'b'), (2, 'a') AS v(charge_type_id, charge_name)")
    charges = _charges(spark, """(4, 1, 'x', DATE '2024-01-01', 't2', 1, 9), (4, 1, 'x', DATE '2024-01-01', 't2', 2, -3), (4, 2, 'y', DATE '2024-01-01', 't2', 2, 9),
      (4, 1, 'x', DATE '2024-01-01', 't3', 2, 9), (5, 1, 'x', DATE '2024-01-01', 't2', 1, 7), (4, 1, 'x', DATE '2024-01-01', NULL, 1, 99), (4, 1, 'x', DATE '2024-01-01', 't9', 3, 99)""")
    found = largest_charge(charges, types)
    # the shipment is chosen before totals are made
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
    rows = found.collect()
    assert [(r.carrier_id, r.tracking_number, r.charge_name, r.amount, r.shipment_total) for r in rows] == [(4, "t2", "a", Decimal("9.00"), Decimal("15.00"))]


def test_no_charges(spark):
    types = spark.sql("SELECT * FROM VALUES (1, 'b') AS v(charge_type_id, charge_name)")
    none = _charges(spark, "(4, 1, 'x', DATE '2024-01-01', 't2', 1, 9)").where("amount < 0")
    assert largest_charge(none, types).collect() == []
