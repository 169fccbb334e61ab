"""Carrier-shaped inputs derived from the given tables.

Each relation is one SQL text that means the same in Spark SQL and DuckDB, so the jobs and the check
queries start from equal input. Every relation covers its whole source table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.contracts import FEDEX_CHARGE_PAIRS, PASSPORT_FEES, UNIUNI_FEES
from ..sources.tables import read_table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
LARGE = ("orders", "lineitem", "events")


def s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def money(cents: str) -> str:
    """Cents to text with two decimals."""
    return s(f"CAST(({cents}) / 100.0 AS DECIMAL(18,2))")


def comma_money(cents: str) -> str:
    """The same with a thousands comma; for amounts of at least zero and below a million."""
    whole = f"CAST(floor(({cents}) / 100) AS BIGINT)"
    return (
        f"CASE WHEN {cents} >= 100000 THEN {s(f'CAST(floor(({cents}) / 100000) AS BIGINT)')} || ',' || "
        f"lpad({s(f'{whole} % 1000')}, 3, '0') || '.' || lpad({s(f'({cents}) % 100')}, 2, '0') "
        f"ELSE {money(cents)} END"
    )


def compact(day: str) -> str:
    return f"replace({s(day)}, '-', '')"


def dashed(day: str) -> str:
    return f"lpad({s(f'month({day})')}, 2, '0') || '-' || lpad({s(f'day({day})')}, 2, '0') || '-' || {s(f'year({day})')}"


def long_date(day: str) -> str:
    return (
        f"substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * month({day}) - 2, 3) || ' ' || "
        f"lpad({s(f'day({day})')}, 2, '0') || ', ' || {s(f'year({day})')}"
    )


SIGNED = "CASE WHEN rf = 'R' THEN -cents ELSE cents END"
NULL_TEXT = "CAST(NULL AS STRING)"

RELATIONS: dict[str, str] = {}

RELATIONS["li"] = """
SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk,
  CAST(l_orderkey % 8 + 1 AS BIGINT) AS file_id,
  CAST(floor(l_orderkey / 16) AS BIGINT) AS inv,
  DATE '2024-01-01' + CAST(floor(l_orderkey / 16) % 365 AS INT) AS bd,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
  CAST(floor(round(l_extendedprice * 100) * round(l_discount * 100) / 100) AS BIGINT) AS fuel,
  CAST(floor(round(l_extendedprice * 100) * round(l_tax * 100) / 100) AS BIGINT) AS tax,
  CAST(round(l_discount * 100) AS BIGINT) AS disc,
  CAST(l_quantity AS BIGINT) AS qty,
  l_returnflag AS rf, l_linestatus AS ls, CAST(l_shipdate AS DATE) AS sd
FROM lineitem
"""

_fedex_pairs = {
    0: ("'Fuel Surcharge'", money("fuel")),
    1: ("CASE rf WHEN 'R' THEN 'Weight Adjustment' WHEN 'A' THEN 'Residential' ELSE '' END", comma_money("tax")),
    2: (f"CASE WHEN ls = 'O' THEN 'fuel surcharge ' ELSE {NULL_TEXT} END", money("disc * 10")),
    3: (f"'Unmapped Fee ' || {s('sk % 3')}", f"CASE WHEN ln = 5 THEN ' ' ELSE {money('-disc * 25')} END"),
    50: ("'Duty'", money("ln * 100")),
}
RELATIONS["stg_fedex"] = f"""
SELECT file_id, ' ' || {s('sk')} || ' ' AS account_number,
  {compact('bd')} AS invoice_date,
  CASE WHEN ok % 97 = 0 AND ln = 3 THEN '   ' WHEN ln % 2 = 0 THEN '  INV' || {s('inv')} || ' '
       ELSE 'INV' || {s('inv')} END AS invoice_number,
  'F' || {s('ok')} AS express_or_ground_tracking_id,
  CASE WHEN rf = 'R' THEN '-' ELSE '' END || {comma_money('cents')} AS transportation_charge_amount,
  CASE WHEN rf = 'R' THEN '-' ELSE '' END || {comma_money('cents')} AS net_charge_amount,
  CASE WHEN ln = 1 THEN 'Ground ' || rf WHEN ln = 2 THEN '' ELSE 'Home ' || ls END AS service_type,
  CASE WHEN ln IN (1, 4) THEN {compact('sd')} ELSE {NULL_TEXT} END AS shipment_date,
  {money('qty * 100')} AS rated_weight_amount,
  CASE (ok + ln) % 6 WHEN 0 THEN 'LB' WHEN 1 THEN 'kg ' WHEN 2 THEN 'OZ' WHEN 3 THEN NULL WHEN 4 THEN 'K' ELSE 'p' END AS rated_weight_units,
  {money('(pk % 40 + 1) * 100 + 50')} AS dim_length,
  {money('(pk % 30) * 100 + 25')} AS dim_width,
  CASE WHEN pk % 9 = 0 THEN '  ' ELSE {money('(pk % 20) * 100')} END AS dim_height,
  CASE pk % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'i' WHEN 2 THEN NULL ELSE 'CM' END AS dim_unit,
  lpad({s('sk')}, 5, '0') AS shipper_zip_code,
  CASE WHEN ln = 1 THEN {s('sk % 8 + 1')} ELSE {NULL_TEXT} END AS zone_code,
  CASE WHEN ln = 1 THEN '' WHEN ln = 2 THEN 'F' || {s('ok')} ELSE 'P' || {s('ok')} || '-' || {s('ln')} END AS msp_tracking_id,
  {', '.join(f"{_fedex_pairs.get(k, (NULL_TEXT, NULL_TEXT))[0]} AS charge_description_{k}, "
             f"{_fedex_pairs.get(k, (NULL_TEXT, NULL_TEXT))[1]} AS charge_amount_{k}"
             for k in range(FEDEX_CHARGE_PAIRS))}
FROM li
"""

RELATIONS["stg_ups"] = f"""
SELECT file_id, {s('sk')} AS account_number, {s('bd')} AS invoice_date, 'UPS' || {s('inv')} AS invoice_number,
  {s('sd')} AS transaction_date,
  CASE WHEN ln = 7 THEN NULL ELSE '1Z' || lpad({s('ok')}, 9, '0') END AS tracking_number,
  CASE WHEN ln % 3 = 0 THEN '0' ELSE {money('qty * 100')} END AS billed_weight,
  CASE ln % 4 WHEN 0 THEN 'L' WHEN 1 THEN 'K' WHEN 2 THEN 'o' ELSE NULL END AS billed_weight_unit,
  CASE WHEN pk % 11 = 0 THEN 'n/a' WHEN pk % 11 = 1 THEN NULL
       ELSE {s('pk % 30')} || '.0x  ' || {s('pk % 20 + 1')} || '.0X  ' || {s('pk % 7')} || '.0' END AS package_dimensions,
  CASE WHEN ln = 2 THEN NULL ELSE lpad({s('sk % 9')}, 3, '0') END AS zone,
  CASE rf WHEN 'A' THEN 'SHP' WHEN 'N' THEN 'ACC' ELSE 'ADJ' END AS charge_category_code,
  'D' || {s('ln')} AS charge_category_detail_code,
  CASE WHEN pk % 13 = 0 THEN '' WHEN ls = 'O' THEN 'FRT' ELSE 'FSC' END AS charge_classification_code,
  CASE WHEN pk % 17 = 0 THEN '  ' ELSE 'Service ' || {s('pk % 4')} END AS charge_description,
  CASE WHEN ln = 6 THEN '0.00' ELSE {money(SIGNED)} END AS net_amount,
  lpad({s('sk')}, 5, '0') AS sender_postal,
  CASE pk % 5 WHEN 0 THEN 'CM' WHEN 1 THEN 'mm' WHEN 2 THEN 'IN' WHEN 3 THEN NULL ELSE 'I' END AS dim_unit
FROM li
"""

RELATIONS["stg_dhl"] = f"""
SELECT file_id, 'DHL' || {s('inv')} AS invoice_number, {s('bd')} AS invoice_date,
  {s('sk % 50')} AS account_number, {s('sd')} AS shipping_date,
  CASE WHEN sk % 3 = 1 THEN '' ELSE ' GM' || {s('ok')} || '-' || {s('ln')} END AS international_tracking_number,
  'U' || {s('ok')} || '-' || {s('ln')} || ' ' AS unique_id,
  CASE WHEN pk % 7 = 0 THEN '0 2139' ELSE lpad({s('pk % 100000')}, 5, '0') || '-1234' END AS recipient_zip_postal_code,
  CASE WHEN ln = 5 THEN NULL WHEN sk % 3 = 0 THEN 'CA' WHEN sk % 3 = 1 THEN 'us ' ELSE 'US' END AS recipient_country,
  'DHL ' || rf AS shipping_method,
  {money('qty * 100')} AS shipped_weight, 'LB' AS shipped_weight_unit,
  {money('qty * 110')} AS billed_weight,
  CASE ln % 5 WHEN 0 THEN 'LB' WHEN 1 THEN 'kgs' WHEN 2 THEN 'OZ' WHEN 3 THEN NULL ELSE 'g' END AS billed_weight_unit,
  {s('sk % 8')} AS zone,
  {money('cents')} AS transportation_cost,
  CASE WHEN ln = 3 THEN '' ELSE {money('disc * 100')} END AS non_qualified_dimensional_charges,
  {money('fuel')} AS fuel_surcharge_amount,
  CASE WHEN rf = 'R' THEN {money('-tax')} ELSE {NULL_TEXT} END AS delivery_area_surcharge_amount
FROM li
"""

RELATIONS["stg_easypost"] = f"""
SELECT file_id, {s('bd')} || 'T' || lpad({s('ln')}, 2, '0') || ':15:30Z' AS created_at,
  CASE WHEN ok % 97 = 0 AND ln = 3 THEN '  ' ELSE ' T' || {s('ok')} END AS tracking_code,
  lpad({s('sk')}, 5, '0') AS from_zip,
  {money('(pk % 20 + 1) * 100')} AS length, {money('(pk % 15) * 100')} AS width,
  CASE WHEN pk % 10 = 0 THEN '' ELSE {money('(pk % 10) * 50')} END AS height,
  {money('qty * 100')} AS weight,
  CASE WHEN ln = 6 THEN '' ELSE {s('sd')} || 'T10:20:30Z' END AS postage_label_created_at,
  'Svc_' || rf AS service,
  CASE WHEN ln = 7 THEN NULL ELSE 'Carrier_' || {s('sk % 40')} END AS carrier,
  {money(SIGNED)} AS rate, CASE WHEN ln = 2 THEN ' ' ELSE {money('5')} END AS label_fee,
  {money(f'{SIGNED} + fuel')} AS postage_fee,
  CASE WHEN disc = 0 THEN '' ELSE {money('disc * 7')} END AS insurance_fee,
  CASE WHEN ls = 'O' THEN {money('3')} ELSE {NULL_TEXT} END AS carbon_offset_fee,
  CASE WHEN ln = 4 THEN '' ELSE {s('sk % 8 + 1')} END AS usps_zone,
  CASE WHEN sk % 41 = 0 THEN NULL ELSE 'ca_' || {s('sk % 5')} END AS carrier_account_id
FROM li
"""

RELATIONS["stg_eliteworks"] = f"""
SELECT file_id, {s('bd')} || ' 08:0' || {s('ln')} || ':00' AS time_utc, 'User ' || {s('sk % 3')} AS user_account,
  CASE WHEN ok % 97 = 0 AND ln = 3 THEN NULL ELSE 'E' || {s('ok')} || ' ' END AS tracking_number,
  'delivered' AS status, CASE WHEN ln = 7 THEN ' ' ELSE 'carrier_' || {s('sk % 40')} END AS carrier,
  'Svc_' || rf AS service, {money('qty * 100')} AS shipment_weight_oz,
  {money('(pk % 20 + 1) * 100')} AS package_length_in, {money('(pk % 15) * 100')} AS package_width_in,
  {money('(pk % 10) * 50')} AS package_height_in, lpad({s('sk')}, 5, '0') AS from_postal,
  {s('sd')} || ' 11:00:00' AS first_scan, {s('sk % 8 + 1')} AS zone, {money('cents')} AS charged,
  {money('disc * 10')} AS store_markup,
  CASE WHEN ln = 6 THEN '0' ELSE {money(SIGNED)} END AS platform_charged_with_corrections
FROM li
"""

RELATIONS["stg_flavorcloud"] = f"""
SELECT file_id,
  CASE WHEN ok % 97 = 0 AND ln = 3 THEN 'total ' WHEN ok % 97 = 1 AND ln = 3 THEN 'Taxes' ELSE 'FLCL-' || {s('inv')} END AS invoice_number,
  {long_date('bd')} AS invoice_date, {s('ok')} AS order_number,
  CASE WHEN ok % 97 = 1 AND ln = 3 THEN '' ELSE 'V' || {s('ok')} || '-' || {s('ln')} END AS shipment_number,
  'Svc_' || rf AS service_level, 'DDP' AS terms_of_trade, 'Site ' || {s('sk % 4')} AS origin_location,
  'IT' AS destination_country, {s('pk')} AS ship_to_zip,
  CASE WHEN ln = 7 THEN NULL ELSE 'CARRIER_' || {s('sk % 40')} END AS carrier,
  CASE ln % 4 WHEN 0 THEN 'LB' WHEN 1 THEN 'kg' WHEN 2 THEN 'OZ' ELSE NULL END AS weight_unit,
  {s('CAST((qty * 1000 + pk % 1000) / 1000.0 AS DECIMAL(18,6))')} AS total_weight,
  CASE pk % 4 WHEN 0 THEN 'cm' WHEN 1 THEN 'MM' WHEN 2 THEN 'IN' ELSE NULL END AS dimension_unit,
  {money('(pk % 40 + 1) * 100')} AS length, {money('(pk % 30) * 100 + 25')} AS width, {money('(pk % 20) * 50')} AS height,
  {money('disc * 100')} AS commissions, {money('0')} AS duties, {money('tax')} AS taxes, {money('fuel')} AS fees,
  {money('tax + fuel')} AS landed_cost, {money('0')} AS insurance, {money(SIGNED)} AS shipping_charges,
  {money('cents * 3')} AS order_value,
  {money(f'{SIGNED} + disc * 100 + tax + fuel + CASE WHEN pk % 29 = 0 THEN 100 ELSE 0 END')} AS shipment_total_charges,
  {dashed('sd')} AS shipment_date, 'Upon Receipt' AS payment_terms, {dashed('bd')} AS due_date
FROM li
"""

_passport_fees = {
    1: ("'Peak Fee'", money("disc * 12")),
    2: (f"CASE rf WHEN 'A' THEN 'Address Fee' WHEN 'N' THEN 'address fee ' ELSE {NULL_TEXT} END", money("tax")),
    3: (f"'Fee ' || {s('pk % 6')}", f"CASE WHEN ln = 2 THEN '' ELSE {money('-ln * 10')} END"),
    8: ("''", money("100")),
}
RELATIONS["stg_passport"] = f"""
SELECT file_id, 'PP' || {s('inv')} AS invoice_number, {s('bd')} AS invoice_date, {s('sd')} AS ship_date,
  'Company' AS company, 'CC' AS client_code, {s('ok')} AS order_id, 'Level ' || rf AS service_level,
  'Name' AS shipper_name, CASE WHEN sk % 9 = 0 THEN ' ' ELSE 'Shipper ' || {s('sk % 10')} END AS shipper_company,
  'Street' AS shipper_street, 'City' AS shipper_city, 'UT' AS shipper_state, lpad({s('sk')}, 5, '0') AS shipper_zip,
  'US' AS shipper_country, 'Street' AS dest_street, 'City' AS dest_city, 'ON' AS dest_state, {s('pk')} AS dest_zip,
  'CA' AS dest_country,
  CASE WHEN ok % 97 = 0 AND ln = 3 THEN ' ' ELSE 'PS' || {s('ok')} END AS tracking_id,
  {s('CAST((qty * 1000 + pk % 1000) / 1000.0 AS DECIMAL(18,6))')} AS actual_weight_oz,
  {s('CAST(qty AS DECIMAL(18,6))')} AS dimensional_weight_oz,
  {s('CAST((qty * 1000 + pk % 997) / 1000.0 AS DECIMAL(18,6))')} AS billable_weight_oz,
  {money('(pk % 40 + 1) * 100')} AS length_in, {money('(pk % 30) * 100')} AS width_in, {money('(pk % 20) * 50')} AS height_in,
  'USD' AS currency, {money(SIGNED)} AS rate, {money('fuel')} AS fuel_surcharge, {money('0')} AS tax,
  {money('disc * 9')} AS duty, {money('0')} AS insurance, {money('ln * 100')} AS clearance_fee,
  {', '.join(f"{_passport_fees.get(k, (NULL_TEXT, NULL_TEXT))[0]} AS fee_{k}_description, "
             f"{_passport_fees.get(k, (NULL_TEXT, NULL_TEXT))[1]} AS fee_{k}_amount"
             for k in range(1, PASSPORT_FEES + 1))},
  {money(f'{SIGNED} + fuel')} AS total
FROM li
"""

_uniuni_fees = {
    "base_fee": money("qty * 100 + ln"),
    "discount_fee": money("-disc * 10"),
    "billed_fee": money("qty * 100"),
    "signature_fee": f"CASE WHEN ln = 4 THEN {money('150')} ELSE '' END",
    "fuel_surcharge": money("disc * 15"),
    "delivery_area_surcharge": f"CASE WHEN sk % 3 = 0 THEN {money('350')} ELSE {NULL_TEXT} END",
    "credit": f"CASE WHEN rf = 'R' THEN {money('-500')} ELSE '0' END",
}
RELATIONS["stg_uniuni"] = f"""
SELECT file_id, ' ' || {s('inv + 1000000')} AS invoice_number, {s('bd')} || ' 00:00:00' AS invoice_time,
  'ACCT' || {s('inv % 3')} AS merchant_id,
  CASE WHEN ok % 97 = 0 AND ln = 3 THEN '' ELSE 'UU' || {s('ok')} END AS tracking_number,
  CASE WHEN ln = 7 THEN '' ELSE {money('qty * 100 + disc * 5')} END AS total_billed_amount,
  {money('qty * 100')} AS billable_weight, 'LBS' AS billable_weight_uom,
  {money('qty * 90')} AS scaled_weight, 'LBS' AS scaled_weight_uom,
  {money('qty * 110')} AS dim_weight,
  CASE ln % 4 WHEN 0 THEN 'LBS' WHEN 1 THEN ' ozs' WHEN 2 THEN 'KG' ELSE NULL END AS dim_weight_uom,
  CASE WHEN ln = 5 THEN ' ' ELSE {s('sk % 8 + 1')} END AS zone, lpad({s('sk')}, 5, '0') AS induction_facility_zipcode,
  {money('(pk % 40 + 1) * 100')} AS dim_length, {money('(pk % 30) * 100')} AS dim_width, {money('(pk % 20) * 50')} AS dim_height,
  CASE pk % 3 WHEN 0 THEN 'cm' WHEN 1 THEN 'IN' ELSE NULL END AS package_dim_uom,
  'Service ' || rf AS service_type, {s('sd')} AS shipped_time, {s('sd')} AS induction_time,
  {', '.join(f"{_uniuni_fees.get(f, NULL_TEXT)} AS {f}" for f in UNIUNI_FEES)}
FROM li
"""

# --- reference data -------------------------------------------------------------------------------

RELATIONS["carriers"] = """
SELECT CAST(n_nationkey + 101 AS INT) AS carrier_id, 'CARRIER_' || CAST(n_nationkey AS STRING) AS carrier_name FROM nation
"""
# methods that exist before a load: some of those on the lines, for carriers with and without an aggregator
RELATIONS["methods"] = """
SELECT CAST(n_nationkey + 1 AS INT) AS shipping_method_id,
  CAST(CASE n_regionkey WHEN 0 THEN 4 WHEN 1 THEN 5 WHEN 2 THEN 6 WHEN 3 THEN 4 ELSE 7 END AS INT) AS carrier_id,
  CASE n_regionkey WHEN 4 THEN 'level ' ELSE 'svc_' END || substr('ANR', n_nationkey % 3 + 1, 1) AS method_name,
  CASE n_regionkey WHEN 4 THEN NULL ELSE CAST(n_nationkey + 101 AS INT) END AS integrated_carrier_id
FROM nation
"""


def _values(rows: list[tuple], columns: str) -> str:
    def lit(v: object) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "true" if v else "false"
        return f"'{v}'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


_TYPE_NAMES: dict[int, list[tuple[str, bool, int]]] = {
    1: [("Transportation Charge", True, 11), ("FUEL SURCHARGE", False, 11), ("Residential", False, 11),
        ("Weight Adjustment", False, 16), ("Duty", False, 11)],
    2: [(f"Service {i}" + suffix, suffix == "", 16 if "ADJ" in suffix else 11)
        for i in range(3) for suffix in ("", " - ACC", " - ADJ")],
    3: [("Transportation Cost", True, 15), ("Non-Qualified Dim", False, 12), ("Fuel Surcharge", False, 8),
        ("Delivery Area Surcharge", False, 4)],
    4: [("Base Rate", True, 11), ("Label Fee", False, 11), ("Unknown Charges", False, 11),
        ("Carbon Offset Fee", False, 11), ("Insurance Fee", False, 11), ("Handling Fee", False, 11)],
    5: [("Platform Charged", False, 11)],
    6: [("Shipping Charges (USD)", True, 11), ("Commissions (USD)", False, 11),
        ("LandedCost (Duty + Taxes + Fees) (USD)", False, 11), ("Insurance (USD)", False, 11)],
    7: [("Rate", True, 11), ("Fuel Surcharge", False, 11), ("Tax", False, 11), ("Duty", False, 11),
        ("Insurance", False, 11), ("Clearance Fee", False, 11), ("Address Fee", False, 11), ("Peak Fee", False, 11)],
    8: [("Base Rate", True, 11), ("Discount Fee", False, 11), ("Signature Fee", False, 11),
        ("Fuel Surcharge", False, 11), ("Delivery Area Surcharge", False, 11), ("Credit", False, 11)],
}
RELATIONS["charge_types"] = _values(
    [(c * 100 + i, c, name, freight, category)
     for c, names in _TYPE_NAMES.items() for i, (name, freight, category) in enumerate(names)],
    "charge_type_id, carrier_id, charge_name, freight, charge_category_id",
)
RELATIONS["categories"] = _values(
    [(4, "Area"), (8, "Fuel"), (11, "Standard"), (12, "Dimension"), (15, "Transport"), (16, "Adjustment")],
    "category_id, category",
)
# the default configuration of the range thresholds
RELATIONS["thresholds"] = """
SELECT metric_type, CAST(range_min AS DECIMAL(12,2)) AS range_min, CAST(range_max AS DECIMAL(12,2)) AS range_max,
  threshold_type, CAST(threshold_value AS DECIMAL(10,2)) AS threshold_value, weight_unit
FROM (VALUES ('cost', 0, 50000, 'pct', 15, NULL), ('cost', 50000, 200000, 'pct', 10, NULL), ('cost', 200000, 400000, 'abs', 8000, NULL),
             ('weight', 0, 16, 'abs', 2, 'oz'), ('weight', 16, 160, 'pct', 10, 'lb'), ('weight', 160, 400, 'pct', 5, 'kg'))
  AS v(metric_type, range_min, range_max, threshold_type, threshold_value, weight_unit)
"""

# --- warehouse ------------------------------------------------------------------------------------

RELATIONS["ord"] = """
SELECT o_orderkey AS ok, o_custkey AS ck, o_orderstatus AS os, o_orderpriority AS pr, CAST(o_orderdate AS DATE) AS od,
  CAST(round(o_totalprice * 100) AS BIGINT) AS cents
FROM orders
"""
# packages before billing data arrives; every eleventh is not billed under its own number
RELATIONS["packages"] = """
SELECT ok AS shipment_package_id, ok AS shipment_id,
  CASE WHEN ok % 11 = 0 THEN 'X' WHEN ok % 13 = 0 THEN 't' ELSE 'T' END || CAST(ok AS STRING) AS tracking_number,
  CAST(ok % 50 + 0.5 AS DECIMAL(18,2)) AS actual_weight_oz,
  CASE WHEN ok % 17 = 0 THEN NULL ELSE CAST(CAST(floor(cents * (80 + ok % 40) / 100) AS BIGINT) / 100.0 AS DECIMAL(18,2)) END AS wms_shipping_cost,
  CAST(NULL AS TIMESTAMP) AS carrier_pickup_date, CAST(NULL AS INT) AS shipping_method_id,
  CAST(NULL AS DECIMAL(18,2)) AS billed_weight_oz, CAST(NULL AS DECIMAL(18,2)) AS billed_length_in,
  CAST(NULL AS DECIMAL(18,2)) AS billed_width_in, CAST(NULL AS DECIMAL(18,2)) AS billed_height_in,
  CAST(NULL AS DECIMAL(18,2)) AS billed_shipping_cost
FROM ord
"""
RELATIONS["shipments"] = """
SELECT ok AS shipment_id, ok AS order_id, ok + 500000 AS external_id, CAST(NULL AS STRING) AS destination_zone,
  CAST(9 AS INT) AS carrier_id
FROM ord
"""
RELATIONS["wms_orders"] = "SELECT ok AS order_id, ck AS customer_id FROM ord"
# packages with billed values, for the variance reports on their own
RELATIONS["billed_packages"] = """
SELECT ok AS shipment_package_id, 'T' || CAST(ok AS STRING) AS tracking_number,
  CASE WHEN ok % 19 = 0 THEN NULL ELSE CAST(ok % 300 + 0.25 * (ck % 4) AS DECIMAL(18,2)) END AS billed_weight_oz,
  CASE WHEN ok % 23 = 0 THEN NULL WHEN ok % 29 = 0 THEN CAST(0 AS DECIMAL(18,2))
       ELSE CAST((ok % 300) * (85 + ck % 30) / 100.0 AS DECIMAL(18,2)) END AS actual_weight_oz,
  CASE WHEN ok % 31 = 0 THEN NULL ELSE CAST(CAST(floor(cents * (85 + ok % 31) / 100) AS BIGINT) / 100.0 AS DECIMAL(18,2)) END AS wms_shipping_cost,
  CAST(cents / 100.0 AS DECIMAL(18,2)) AS billed_shipping_cost
FROM ord
"""

# --- threshold configurations per customer ----------------------------------------------------------

RELATIONS["config_ranges"] = """
SELECT ck AS scope, ok AS range_id,
  CASE WHEN ok % 41 = 0 THEN 'volume' WHEN os = 'O' THEN 'weight' ELSE 'cost' END AS metric_type,
  CAST(floor(cents / 100000) AS DECIMAL(12,2)) AS range_min,
  CASE WHEN pr = '1-URGENT' THEN NULL ELSE CAST(floor(cents / 100000) + ok % 300 AS DECIMAL(12,2)) END AS range_max,
  CASE WHEN ok % 37 = 0 THEN 'rel' WHEN ok % 2 = 0 THEN 'pct' ELSE 'abs' END AS threshold_type,
  CAST(ok % 43 AS DECIMAL(10,2)) AS threshold_value,
  CASE WHEN os = 'O' AND ok % 7 <> 0 THEN 'lb' WHEN os <> 'O' AND ok % 47 = 0 THEN 'oz' ELSE NULL END AS weight_unit
FROM ord
"""
RELATIONS["config_versions"] = """
SELECT ck AS scope, ok AS version_id, od AS effective_date, 'user ' || CAST(ok % 5 AS STRING) AS created_by
FROM ord
"""
# one configuration per part as JSON text
RELATIONS["json_configs"] = """
SELECT p_partkey AS scope,
  '[{"metric_type":"cost","range_min":0,"range_max":' || CAST(p_size + 1 AS STRING) || ',"threshold_type":"pct","threshold_value":15.0,"weight_unit":null},'
  || '{"metric_type":"cost","range_min":' || CAST(p_size + 1 - CASE WHEN p_size % 9 = 0 THEN 1 ELSE 0 END AS STRING)
  || ',"range_max":null,"threshold_type":"abs","threshold_value":' || CAST(p_size % 5 AS STRING) || ',"weight_unit":null},'
  || '{"metric_type":"weight","range_min":0,"range_max":16,"threshold_type":"abs","threshold_value":2.5,"weight_unit":"oz"}]' AS config_json
FROM part
"""

# --- file intake ---------------------------------------------------------------------------------------

RELATIONS["file_carriers"] = _values(
    [(1, "FedEx"), (2, "UPS"), (3, "DHL"), (4, "USPS - Easy Post"), (5, "Eliteworks"), (6, "Flavor Cloud"), (8, "UniUni")],
    "carrier_id, carrier_name",
)
RELATIONS["arrivals"] = """
SELECT 'https://host/bills/tenant%20' || CAST(ck % 3 AS STRING) || '/'
  || CASE ok % 9 WHEN 0 THEN 'fedex' WHEN 1 THEN 'UPS' WHEN 2 THEN 'dhl' WHEN 3 THEN 'usps%20-%20easy%20post'
       WHEN 4 THEN 'eliteworks' WHEN 5 THEN 'FlavorCloud' WHEN 6 THEN 'passport' WHEN 7 THEN 'uniuni' ELSE 'canpar' END
  || '/acc' || CAST(ck AS STRING) || '/bill%20' || CAST(ok AS STRING) || '.csv' AS file_path,
  '{"Prop_0":"x","Prop_1":"acc' || CAST(ck AS STRING) || '","Prop_2":"' || CASE WHEN ck % 10 = 0 THEN '' ELSE 'ACC' || CAST(ck AS STRING) END
  || '","Prop_6":"acc' || CAST(ck + CASE WHEN ok % 4 = 0 THEN 1 ELSE 0 END AS STRING) || '","Prop_32":"acc' || CAST(ck AS STRING) || '"}' AS first_row
FROM ord
"""
RELATIONS["tracker"] = """
SELECT ok AS file_id, 'BILL ' || CAST(ok AS STRING) || '.csv' AS file_name,
  CAST(CASE ok % 9 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 5 WHEN 5 THEN 6 ELSE 8 END AS INT) AS carrier_id,
  CAST(od AS TIMESTAMP) AS created_at, CASE WHEN os = 'F' THEN CAST(od AS TIMESTAMP) ELSE NULL END AS completed_at
FROM ord WHERE pr <> '5-LOW'
"""

# --- older jobs ----------------------------------------------------------------------------------------

RELATIONS["legacy_dhl"] = """
SELECT 'DHL' || CAST(inv AS STRING) AS invoice_number, bd AS invoice_date,
  CASE WHEN ln % 2 = 0 THEN 'T' || CAST(ok AS STRING) ELSE NULL END AS overall_tracking_number,
  CASE WHEN ln = 3 THEN NULL ELSE 'T' || CAST(ok + ln % 2 AS STRING) END AS domestic_tracking_number,
  CAST(sk % 8 AS STRING) AS zone, 'svc_' || rf AS shipping_method, CAST(sd AS STRING) AS shipment_date,
  CAST(qty AS DECIMAL(18,2)) AS billed_weight, CASE ln % 3 WHEN 0 THEN 'LB' WHEN 1 THEN 'OZ' ELSE NULL END AS billed_weight_unit,
  CAST(cents / 100.0 AS DECIMAL(18,2)) AS transportation_cost, CAST(fuel / 100.0 AS DECIMAL(18,2)) AS fuel_surcharge,
  CASE WHEN ln = 5 THEN NULL ELSE CAST(disc AS DECIMAL(18,2)) END AS non_qualified_dim_charges,
  CAST(tax / 100.0 AS DECIMAL(18,2)) AS delivery_area_surcharge, CAST(sd AS TIMESTAMP) AS created_date
FROM li
"""
RELATIONS["run_tracker"] = """
SELECT 'job ' || CAST(n_nationkey AS STRING) AS procedure_name, CAST(DATE '1996-01-01' + n_nationkey AS TIMESTAMP) AS last_run_time FROM nation
"""
# --- single operators ----------------------------------------------------------------------------------

RELATIONS["date_texts"] = f"""
SELECT ok, CASE ok % 6 WHEN 0 THEN {compact('od')} WHEN 1 THEN ' ' || {s('od')} || ' ' WHEN 2 THEN {s('od')} || ' 13:45:00'
    WHEN 3 THEN {s('month(od)')} || '/' || {s('day(od)')} || '/' || {s('year(od)')} WHEN 4 THEN '   ' ELSE {NULL_TEXT} END AS any_date,
  {long_date('od')} AS long_date, {dashed('od')} AS dashed_date, {s('od')} || 'T23:59:58Z' AS rfc_date,
  CASE ok % 4 WHEN 0 THEN {s('od')} || 'T01:02:03Z' WHEN 1 THEN {s('month(od)')} || '/' || {s('day(od)')} || '/' || substr({s('year(od)')}, 3, 2)
    WHEN 2 THEN '' ELSE 'on ' || {s('od')} END AS two_forms
FROM ord
"""
RELATIONS["dim_texts"] = """
SELECT p_partkey AS pk, CASE p_size % 6 WHEN 0 THEN '12x10' WHEN 1 THEN 'axbxc'
    ELSE CAST(p_size AS STRING) || '.0x  ' || CAST(p_size % 20 + 1 AS STRING) || '.0x  ' || CAST(p_size % 7 AS STRING) || '.0' END AS dims
FROM part
"""
RELATIONS["file_headers"] = """
SELECT ok AS file_id, 'created_at,tracking_code,from_zip,length,width,height,weight,postage_label_created_at,service,carrier,rate,label_fee,postage_fee,'
  || CASE ok % 5 WHEN 0 THEN 'insurance,' WHEN 1 THEN 'insurance_fee,new_fee,' ELSE 'insurance_fee,' END
  || CASE WHEN ok % 7 = 0 THEN '' ELSE 'carbon_offset_fee,' END || 'usps_zone,carrier_account_id' AS header
FROM ord
"""
RELATIONS["catalog_methods"] = """
SELECT p_partkey AS shipping_method_id, CAST(p_size % 24 + 101 AS INT) AS carrier_id, p_type || ' ' || p_brand AS method_name,
  CASE p_size % 3 WHEN 0 THEN NULL ELSE CAST(p_partkey % 30 + 101 AS INT) END AS integrated_carrier_id
FROM part
"""
RELATIONS["catalog_markups"] = """
SELECT s_suppkey * 3 AS shipping_method_id, CAST(5 + s_suppkey % 20 AS DECIMAL(18,4)) AS markup FROM supplier
"""
RELATIONS["default_markups"] = """
SELECT ok AS id, CAST(10 + ok % 20 AS DECIMAL(18,4)) AS markup, CAST(od AS TIMESTAMP) AS created_at,
  CASE WHEN os = 'F' THEN CAST(od AS TIMESTAMP) ELSE NULL END AS deleted_at FROM ord
"""
RELATIONS["priced_items"] = """
SELECT ok, ln, pk AS shipping_method_id, CAST(cents / 100.0 AS DECIMAL(18,2)) AS amount FROM li
"""
RELATIONS["method_uses"] = """
SELECT ok AS use_id, CAST(sk % 8 + 1 AS INT) AS carrier_id, CASE WHEN ln = 1 THEN 'SVC_' ELSE 'Level ' END || rf AS shipping_method,
  CASE WHEN ln % 2 = 0 THEN NULL ELSE CAST(sk % 25 + 101 AS INT) END AS integrated_carrier_id FROM li
"""
RELATIONS["ev"] = """
SELECT event_id, event_type, CAST(user_id AS BIGINT) AS user_id, CAST(ts AS TIMESTAMP) AS ts FROM events
"""
# one delivery per line number: later deliveries correct shipments of earlier ones
RELATIONS["stg_corrections"] = RELATIONS["stg_easypost"].replace("SELECT file_id,", "SELECT CAST(ln AS BIGINT) AS file_id,", 1)

# what is already loaded, as the state before a second run
RELATIONS["loaded_files"] = "SELECT DISTINCT file_id FROM li WHERE ok % 8 < 3"

def _needs(name: str, seen: list[str]) -> None:
    text = RELATIONS[name]
    for word in dict.fromkeys(re.findall(r"\b(?:FROM|JOIN)\s+([a-z_0-9]+)", text)):
        if word in RELATIONS and word not in seen:
            _needs(word, seen)
    if name not in seen:
        seen.append(name)


def ctes(*names: str) -> str:
    """`a AS (...), b AS (...)` with everything the named relations build on."""
    ordered: list[str] = []
    for n in names:
        _needs(n, ordered)
    return ",\n".join(f"{n} AS ({RELATIONS[n].strip()})" for n in ordered)


TASK_ROWS = 500_000  # of a given table, whose rows become wide lines of text and many charges


def spread(rows: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """A table that comes in fewer splits than there are cores, or in larger ones than a task takes, is dealt out before text is
    made of it; one of many splits stays as it is read."""
    cores, splits = rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()
    wanted = max(cores, -(-rows.count() // task_rows))  # the count is in the files' footers
    return rows.repartition(wanted) if splits < wanted else rows


def _delivery_of(name: str) -> str:
    """The file id of a staged relation over the columns of `lineitem`."""
    line = {"ok": "l_orderkey", "ln": "l_linenumber"}
    own = re.search(r"SELECT (.*?)(?: AS)? ?file_id\b", RELATIONS[name])[1] or re.search(r"(CAST\(l_orderkey.*\)) AS file_id", RELATIONS["li"])[1]
    return re.sub(r"\b(ok|ln)\b", lambda m: line[m[0]], own)


def delivered(spark: SparkSession, folder: str, name: str, file_lines: int) -> DataFrame:
    """The rows of a staged relation as a carrier delivers them: a task holds the lines of one file, of about as many lines at most,
    and the lines of an order are in one file of its delivery.

    The given rows are dealt out, a few numbers each, and text is made of them where it is written.
    """
    given = read_table(spark, folder, "lineitem")
    own = F.expr(_delivery_of(name))
    deliveries = given.groupBy(own.alias("file_id")).count().orderBy("file_id").collect()  # a row for each delivery
    parts = max(1, -(-max([d["count"] for d in deliveries], default=0) // file_lines))
    place = F.coalesce(F.array_position(F.array(*[F.lit(d["file_id"]).cast("bigint") for d in deliveries]), own.cast("bigint")), F.lit(0)).cast("int")
    order = F.coalesce(F.xxhash64(F.col("l_orderkey")), F.xxhash64(*given.columns))
    number = F.greatest(place - 1, F.lit(0)) * parts + F.pmod(order, F.lit(parts)).cast("int")
    given.repartitionById(max(1, len(deliveries)) * parts, number).createOrReplaceTempView("lineitem")
    return spark.sql(f"WITH {ctes(name)} SELECT * FROM {name}")


def relation(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One derived relation over the tables of ``folder``."""
    text = f"WITH {ctes(name)} SELECT * FROM {name}"
    for table in TABLES:
        if re.search(rf"\bFROM {table}\b", text):
            rows = read_table(spark, folder, table)
            (spread(rows) if table in LARGE else rows).createOrReplaceTempView(table)
    return spark.sql(text)
