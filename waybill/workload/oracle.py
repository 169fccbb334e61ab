"""Check queries in DuckDB SQL, written from the rules and not from the jobs.

They share only the input relations of ``fixtures`` with the jobs.
"""

from __future__ import annotations

from .fixtures import ctes

BILL = "carrier_id, file_id, bill_number, bill_date, account_number, total_amount, num_shipments"
ATTR = (
    "carrier_id, tracking_number, shipment_date, shipping_method, destination_zone, billed_weight_oz, "
    "billed_length_in, billed_width_in, billed_height_in, integrated_carrier_id"
)
CHARGE_KEY = "carrier_id, file_id, bill_number, bill_date, tracking_number, charge_type_id"
IDS = {"fedex": 1, "ups": 2, "dhl": 3, "easypost": 4, "eliteworks": 5, "flavorcloud": 6, "passport": 7, "uniuni": 8}
INTEGRATED = ("easypost", "eliteworks", "flavorcloud")


def t(c: str) -> str:
    return f"NULLIF(trim({c}), '')"


def d(c: str, p: int = 18, s: int = 2) -> str:
    return f"CAST({t(c)} AS DECIMAL({p},{s}))"


def z(c: str, p: int = 18, s: int = 2) -> str:
    return f"CAST(COALESCE({t(c)}, '0') AS DECIMAL({p},{s}))"


def m(c: str) -> str:
    return f"CAST(NULLIF(replace(trim({c}), ',', ''), '') AS DECIMAL(18,2))"


def ymd(c: str) -> str:
    return f"CAST(strptime({t(c)}, '%Y%m%d') AS DATE)"


def cols(fmt, names: list[str]) -> str:
    return ", ".join(f"{fmt(n)} AS {n}" for n in names)


def plain(*names: str) -> str:
    return ", ".join(names)


FX_PAIRS = range(51)
UNI_FEES = [
    "base_fee", "discount_fee", "billed_fee", "signature_fee", "pickup_fee", "over_dimension_fee",
    "over_max_size_fee", "over_weight_fee", "fuel_surcharge", "peak_season_surcharge", "delivery_area_surcharge",
    "delivery_area_surcharge_extend", "truck_fee", "relabel_fee", "miscellaneous_fee", "credit_card_surcharge",
    "credit", "approved_claim",
]

# carrier -> (filter for invoices, filter for lines, bill_number, bill_date, typed columns)
LINE = {
    "fedex": (
        "trim(invoice_number) <> '' AND trim(invoice_date) <> ''", "true", "trim(invoice_number)", ymd("invoice_date"),
        f"{t('service_type')} AS service_type, {ymd('shipment_date')} AS shipment_date, "
        f"{cols(t, ['express_or_ground_tracking_id', 'msp_tracking_id', 'zone_code'])}, {m('net_charge_amount')} AS net_charge_amount, "
        f"{d('rated_weight_amount')} AS rated_weight_amount, {t('rated_weight_units')} AS rated_weight_units, "
        f"{cols(d, ['dim_length', 'dim_width', 'dim_height'])}, {cols(t, ['dim_unit', 'shipper_zip_code'])}, "
        f"{m('transportation_charge_amount')} AS transportation_charge_amount, "
        f"{cols(t, [f'charge_description_{k}' for k in FX_PAIRS])}, {cols(m, [f'charge_amount_{k}' for k in FX_PAIRS])}",
    ),
    "ups": (
        "trim(invoice_date) <> ''", "trim(charge_description) <> '' AND trim(charge_classification_code) <> ''",
        "trim(invoice_number)", "CAST(invoice_date AS DATE)",
        f"{cols(t, ['charge_description', 'charge_classification_code', 'charge_category_code', 'charge_category_detail_code'])}, "
        f"CAST(transaction_date AS TIMESTAMP) AS transaction_date, {cols(t, ['tracking_number', 'zone'])}, "
        f"{cols(d, ['net_amount', 'billed_weight'])}, {t('billed_weight_unit')} AS billed_weight_unit, "
        + ", ".join(
            f"NULLIF(TRY_CAST(NULLIF(regexp_extract(package_dimensions, '^\\s*([^xX]*)[xX]\\s*([^xX]*)[xX]\\s*([^xX]*)$', {i}), '') AS DECIMAL(18,2)), 0) AS {n}"
            for i, n in ((1, "dim_length"), (2, "dim_width"), (3, "dim_height"))
        )
        + f", {cols(t, ['dim_unit', 'sender_postal'])}",
    ),
    "dhl": (
        "invoice_number IS NOT NULL AND trim(invoice_date) <> ''", "true", "invoice_number", "CAST(invoice_date AS DATE)",
        f"CAST({t('shipping_date')} AS DATE) AS shipping_date, {t('international_tracking_number')} AS international_tracking_number, "
        "'420' || left(replace(recipient_zip_postal_code, ' ', ''), 5) || trim(unique_id) AS domestic_tracking_number, "
        "recipient_zip_postal_code, recipient_country, shipping_method, "
        f"{d('shipped_weight')} AS shipped_weight, shipped_weight_unit, {d('billed_weight')} AS billed_weight, billed_weight_unit, zone, "
        f"{cols(d, ['transportation_cost', 'non_qualified_dimensional_charges', 'fuel_surcharge_amount', 'delivery_area_surcharge_amount'])}",
    ),
    "easypost": (
        "trim(created_at) <> '' AND trim(tracking_code) <> ''", "true",
        "COALESCE(carrier_account_id, '') || '-' || left(created_at, 10)", "CAST(left(created_at, 10) AS DATE)",
        f"trim(tracking_code) AS tracking_code, {cols(z, ['weight', 'rate', 'label_fee', 'postage_fee'])}, "
        f"CAST({t('usps_zone')} AS SMALLINT) AS usps_zone, from_zip, {cols(z, ['length', 'width', 'height'])}, "
        f"CAST(replace({t('postage_label_created_at')}, 'Z', '') AS TIMESTAMP) AS postage_label_created_at, "
        f"{cols(z, ['insurance_fee', 'carbon_offset_fee'])}, service, {t('carrier')} AS integrated_carrier",
    ),
    "eliteworks": (
        "trim(time_utc) <> '' AND trim(tracking_number) <> ''", "true",
        "'Eliteworks_' || strftime(max(CAST(time_utc AS DATE)) OVER (PARTITION BY file_id), '%Y-%m-%d')",
        "max(CAST(time_utc AS DATE)) OVER (PARTITION BY file_id)",
        "trim(tracking_number) AS tracking_number, CAST(first_scan AS TIMESTAMP) AS shipment_date, service AS service_method, zone, "
        f"{d('charged')} AS charged_amount, {d('store_markup')} AS store_markup, {d('platform_charged_with_corrections')} AS platform_charged, "
        f"{d('shipment_weight_oz')} AS billed_weight_oz, {cols(d, ['package_length_in', 'package_width_in', 'package_height_in'])}, "
        f"from_postal, status AS shipment_status, {t('carrier')} AS integrated_carrier",
    ),
    "flavorcloud": (
        "trim(invoice_number) <> '' AND lower(trim(invoice_number)) <> 'total' AND trim(shipment_number) <> ''", "true",
        "invoice_number", "CAST(strptime(invoice_date, '%b %d, %Y') AS DATE)",
        "order_number, trim(shipment_number) AS tracking_number, service_level, terms_of_trade, origin_location, destination_country, "
        f"ship_to_zip, {t('carrier')} AS integrated_carrier, {d('total_weight', 18, 6)} AS total_weight, weight_unit, "
        f"{cols(d, ['length', 'width', 'height'])}, dimension_unit, "
        f"{cols(d, ['commissions', 'duties', 'taxes', 'fees', 'landed_cost', 'insurance', 'shipping_charges', 'order_value', 'shipment_total_charges'])}, "
        "CAST(strptime(shipment_date, '%m-%d-%Y') AS DATE) AS shipment_date, payment_terms, CAST(strptime(due_date, '%m-%d-%Y') AS DATE) AS due_date",
    ),
    "passport": (
        "trim(invoice_number) <> '' AND trim(tracking_id) <> ''", "true", "invoice_number", "CAST(invoice_date AS DATE)",
        "CAST(ship_date AS DATE) AS ship_date, "
        + plain("company", "client_code", "order_id", "service_level", "shipper_name", "shipper_company", "shipper_street", "shipper_city",
                "shipper_state", "shipper_zip", "shipper_country", "dest_street", "dest_city", "dest_state", "dest_zip", "dest_country")
        + ", trim(tracking_id) AS tracking_number, "
        + cols(lambda c: d(c, 18, 6), ["actual_weight_oz", "dimensional_weight_oz", "billable_weight_oz"])
        + f", {cols(d, ['length_in', 'width_in', 'height_in'])}, currency, "
        + cols(d, ["rate", "fuel_surcharge", "tax", "duty", "insurance", "clearance_fee"])
        + ", " + plain(*[f"fee_{k}_description" for k in range(1, 9)]) + ", " + cols(z, [f"fee_{k}_amount" for k in range(1, 9)])
        + f", {d('total')} AS total",
    ),
    "uniuni": (
        "true", "true", "trim(invoice_number)", "CAST(left(invoice_time, 10) AS DATE)",
        f"{t('tracking_number')} AS tracking_number, {d('total_billed_amount')} AS total_billed_amount, "
        + ", ".join(f"{d(w, 18, 4)} AS {w}, trim({w}_uom) AS {w}_uom" for w in ("billable_weight", "scaled_weight", "dim_weight"))
        + f", CAST({t('zone')} AS INT) AS zone, CAST({t('induction_facility_zipcode')} AS INT) AS induction_facility_zipcode, "
        + cols(lambda c: d(c, 18, 4), ["dim_length", "dim_width", "dim_height"])
        + ", trim(package_dim_uom) AS package_dim_uom, trim(service_type) AS service_type, CAST(shipped_time AS DATE) AS shipment_date, "
        "CAST(induction_time AS DATE) AS induction_time, " + cols(lambda c: z(c, 10, 2), UNI_FEES),
    ),
}


def lines(c: str, name: str | None = None) -> str:
    need, line_need, number, day, typed = LINE[c]
    inner = (
        f"SELECT CAST({IDS[c]} AS INT) AS carrier_id, file_id, {number} AS bill_number, {day} AS bill_date, {typed}, "
        f"({line_need}) AS __keep FROM stg_{c} WHERE {need}"
    )
    return f"{name or 'lines_' + c} AS (SELECT * EXCLUDE (__keep) FROM ({inner}) q WHERE __keep)"


_BILL_PARTS = {
    "fedex": (m("net_charge_amount"), "count(*)", f"max({t('account_number')})"),
    "ups": (d("net_amount"), "count(DISTINCT rtrim(tracking_number))", f"max({t('account_number')})"),
    "dhl": (
        " + ".join(f"COALESCE({d(x)}, 0)" for x in ("transportation_cost", "non_qualified_dimensional_charges", "fuel_surcharge_amount", "delivery_area_surcharge_amount")),
        "count(*)", f"max({t('account_number')})",
    ),
    "easypost": (z("postage_fee"), "count(tracking_code)", "max(carrier_account_id)"),
    "eliteworks": (d("platform_charged_with_corrections"), "count(*)", f"max({t('user_account')})"),
    "flavorcloud": (d("shipment_total_charges"), "count(*)", f"max({t('origin_location')})"),
    "passport": (d("total"), "count(*)", f"max({t('shipper_company')})"),
    "uniuni": (z("total_billed_amount"), "count(tracking_number)", "trim(merchant_id)"),
}


def bills(c: str) -> str:
    need, _, number, day, _ = LINE[c]
    amount, n, account = _BILL_PARTS[c]
    if c == "eliteworks":
        number = "'Eliteworks_' || strftime(max(CAST(time_utc AS DATE)), '%Y-%m-%d')"
        day, group = "max(CAST(time_utc AS DATE))", "file_id"
    else:
        group = f"file_id, {number}, {day}" + (", trim(merchant_id)" if c == "uniuni" else "")
    return (
        f"bills_{c} AS (SELECT CAST({IDS[c]} AS INT) AS carrier_id, file_id, {number} AS bill_number, {day} AS bill_date, "
        f"{account} AS account_number, CAST(sum({amount}) AS DECIMAL(18,2)) AS total_amount, CAST({n} AS INT) AS num_shipments "
        f"FROM stg_{c} WHERE {need} GROUP BY {group})"
    )


def num(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def fedex_weight(v: str, u: str) -> str:
    return num(f"CASE WHEN upper({u}) IN ('L','LB','LBS','P') THEN {v} * 16.0 WHEN upper({u}) IN ('K','KG','KGS') THEN {v} * 35.27396195 ELSE {v} END")


def fedex_dim(v: str, u: str) -> str:
    return num(f"CASE WHEN upper({u}) = 'C' THEN {v} / 2.54 ELSE {v} END")


def ups_weight(v: str, u: str) -> str:
    return num(f"CASE WHEN {v} <> 0 THEN CASE upper({u}) WHEN 'L' THEN {v} * 16 WHEN 'K' THEN {v} * 35.274 ELSE {v} END END")


def ups_dim(v: str, u: str) -> str:
    return num(f"CASE WHEN {v} <> 0 THEN CASE upper({u}) WHEN 'CM' THEN {v} / 2.54 WHEN 'MM' THEN {v} / 25.4 ELSE {v} END END")


def dhl_weight(v: str, u: str) -> str:
    return num(f"CASE WHEN upper({u}) IN ('LB','LBS') THEN {v} * 16.0 WHEN upper({u}) IN ('KG','KGS') THEN {v} * 35.274 ELSE {v} END")


def flavor_weight(v: str, u: str) -> str:
    return num(f"CASE upper({u}) WHEN 'LB' THEN {v} * 16 WHEN 'KG' THEN {v} * 35.274 ELSE {v} END")


def flavor_dim(v: str, u: str) -> str:
    return num(f"CASE upper({u}) WHEN 'CM' THEN {v} / 2.54 WHEN 'MM' THEN {v} / 25.4 ELSE {v} END")


def uni_weight(v: str, u: str) -> str:
    return num(f"CASE upper(trim({u})) WHEN 'LBS' THEN {v} * 16.0 WHEN 'OZS' THEN {v} END")


def uni_dim(v: str, u: str) -> str:
    return num(f"CASE upper(trim({u})) WHEN 'CM' THEN {v} * 0.393701 WHEN 'IN' THEN {v} END")


# multi-piece groups: size, role and the header's values, by window functions
FEDEX_ROLES = """
fx_counted AS (SELECT *, count(*) OVER (PARTITION BY file_id, express_or_ground_tracking_id) AS group_rows FROM lines_fedex),
fx_roles AS (SELECT *, CASE WHEN group_rows = 1 THEN 'NORMAL_SINGLE' WHEN msp_tracking_id IS NULL THEN 'MPS_HEADER'
    WHEN msp_tracking_id = express_or_ground_tracking_id THEN 'MPS_PARENT' ELSE 'MPS_CHILD' END AS mps_role FROM fx_counted),
fx_hoisted AS (SELECT *,
    max(CASE WHEN mps_role IN ('MPS_HEADER','NORMAL_SINGLE') THEN net_charge_amount END) OVER g AS group_net_charge_amount,
    max(CASE WHEN mps_role IN ('MPS_HEADER','NORMAL_SINGLE') THEN shipment_date END) OVER g AS group_shipment_date,
    max(CASE WHEN mps_role IN ('MPS_HEADER','NORMAL_SINGLE') THEN service_type END) OVER g AS group_service_type,
    max(CASE WHEN mps_role IN ('MPS_HEADER','NORMAL_SINGLE') THEN zone_code END) OVER g AS group_zone_code
  FROM fx_roles WINDOW g AS (PARTITION BY file_id, express_or_ground_tracking_id))
"""

DHL_TRACKING = "CASE WHEN upper(trim(recipient_country)) = 'US' THEN domestic_tracking_number ELSE international_tracking_number END"
_NONE = "CAST(NULL AS DECIMAL(18,2))"

# carrier -> tracking, date, method, zone, weight, length, width, height
_ATTR_PARTS = {
    "fedex": (
        "COALESCE(msp_tracking_id, express_or_ground_tracking_id)", "CAST(group_shipment_date AS TIMESTAMP)", "group_service_type", "group_zone_code",
        fedex_weight("rated_weight_amount", "rated_weight_units"), *[fedex_dim(f"dim_{x}", "dim_unit") for x in ("length", "width", "height")],
    ),
    "dhl": (DHL_TRACKING, "CAST(shipping_date AS TIMESTAMP)", "shipping_method", "zone", dhl_weight("billed_weight", "billed_weight_unit"), _NONE, _NONE, _NONE),
    "easypost": ("tracking_code", "postage_label_created_at", "service", "CAST(usps_zone AS VARCHAR)", "weight", "length", "width", "height"),
    "eliteworks": ("tracking_number", "shipment_date", "service_method", "zone", "billed_weight_oz", "package_length_in", "package_width_in", "package_height_in"),
    "flavorcloud": (
        "tracking_number", "CAST(shipment_date AS TIMESTAMP)", "service_level", "CAST(NULL AS VARCHAR)", flavor_weight("total_weight", "weight_unit"),
        *[flavor_dim(x, "dimension_unit") for x in ("length", "width", "height")],
    ),
    "passport": ("tracking_number", "CAST(ship_date AS TIMESTAMP)", "service_level", "CAST(NULL AS VARCHAR)", num("billable_weight_oz"), "length_in", "width_in", "height_in"),
    "uniuni": (
        "tracking_number", "CAST(shipment_date AS TIMESTAMP)", "service_type", "CAST(zone AS VARCHAR)", uni_weight("dim_weight", "dim_weight_uom"),
        *[uni_dim(f"dim_{x}", "package_dim_uom") for x in ("length", "width", "height")],
    ),
}


def attributes(c: str) -> str:
    """CTEs up to attr_<c>: one row per shipment."""
    if c == "ups":
        w, (l, wd, h) = ups_weight("billed_weight", "billed_weight_unit"), [ups_dim(f"dim_{x}", "dim_unit") for x in ("length", "width", "height")]
        last = lambda x: f"arg_max({x}, file_id) FILTER (WHERE {x} IS NOT NULL) AS {x}"
        return (
            "ups_files AS (SELECT carrier_id, file_id, tracking_number, max(transaction_date) AS shipment_date, "
            "max(CASE WHEN charge_category_code = 'SHP' AND charge_classification_code = 'FRT' THEN charge_description END) AS shipping_method, "
            f"max(zone) AS destination_zone, max({w}) AS billed_weight_oz, max({l}) AS billed_length_in, max({wd}) AS billed_width_in, max({h}) AS billed_height_in, "
            "row_number() OVER (PARTITION BY tracking_number ORDER BY file_id) AS nth FROM lines_ups WHERE tracking_number IS NOT NULL GROUP BY 1, 2, 3), "
            "attr_ups AS (SELECT carrier_id, tracking_number, max(CASE WHEN nth = 1 THEN shipment_date END) AS shipment_date, "
            "max(CASE WHEN nth = 1 THEN shipping_method END) AS shipping_method, "
            + ", ".join(last(x) for x in ("destination_zone", "billed_weight_oz", "billed_length_in", "billed_width_in", "billed_height_in"))
            + ", CAST(NULL AS INT) AS integrated_carrier_id FROM ups_files GROUP BY 1, 2)"
        )
    tracking, day, method, zone, weight, length, width, height = _ATTR_PARTS[c]
    own = c in INTEGRATED
    source = "fx_hoisted WHERE mps_role <> 'MPS_HEADER'" if c == "fedex" else f"lines_{c}"
    fields = "carrier_id, tracking_number, shipping_method, destination_zone, billed_weight_oz, billed_length_in, billed_width_in, billed_height_in".split(", ")
    order = ", ".join(f"{x} DESC NULLS LAST" for x in ["shipment_date", *fields, *(["integrated_carrier"] if own else [])])
    rows = (
        f"attr_rows_{c} AS (SELECT carrier_id, {tracking} AS tracking_number, {day} AS shipment_date, {method} AS shipping_method, {zone} AS destination_zone, "
        f"{num(weight)} AS billed_weight_oz, {num(length)} AS billed_length_in, {num(width)} AS billed_width_in, {num(height)} AS billed_height_in"
        f"{', integrated_carrier' if own else ''} FROM {source}), "
        f"attr_one_{c} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(rtrim(tracking_number)) ORDER BY {order}) AS rn "
        f"FROM attr_rows_{c} WHERE trim(tracking_number) <> '') q WHERE rn = 1), "
    )
    if c == "fedex":
        rows = FEDEX_ROLES + ", " + rows
    if not own:
        return rows + f"attr_{c} AS (SELECT carrier_id, {', '.join(ATTR.split(', ')[1:-1])}, CAST(NULL AS INT) AS integrated_carrier_id FROM attr_one_{c})"
    return rows + (
        f"attr_{c} AS (SELECT a.carrier_id, {', '.join('a.' + x for x in ATTR.split(', ')[1:-1])}, sm.integrated_carrier_id FROM attr_one_{c} a "
        "LEFT JOIN carriers ca ON lower(ca.carrier_name) = lower(a.integrated_carrier) "
        f"LEFT JOIN methods sm ON sm.carrier_id = {IDS[c]} AND lower(rtrim(sm.method_name)) = lower(rtrim(a.shipping_method)) AND sm.integrated_carrier_id = ca.carrier_id)"
    )


# carrier -> tracking, [(name expression, amount expression)]
CHARGES = {
    "fedex": ("express_or_ground_tracking_id", [("'Transportation Charge'", "transportation_charge_amount"), *[(f"charge_description_{k}", f"charge_amount_{k}") for k in FX_PAIRS]]),
    "ups": ("tracking_number", [("CASE WHEN charge_category_code = 'SHP' THEN charge_description ELSE charge_description || ' - ' || charge_category_code END", "net_amount")]),
    "dhl": (DHL_TRACKING, [("'Transportation Cost'", "transportation_cost"), ("'Non-Qualified Dim'", "non_qualified_dimensional_charges"), ("'Fuel Surcharge'", "fuel_surcharge_amount"), ("'Delivery Area Surcharge'", "delivery_area_surcharge_amount")]),
    "easypost": ("tracking_code", [("'Base Rate'", "rate"), ("'Label Fee'", "label_fee"), ("'Unknown Charges'", "postage_fee - rate"), ("'Carbon Offset Fee'", "carbon_offset_fee"), ("'Insurance Fee'", "insurance_fee")]),
    "eliteworks": ("tracking_number", [("'Platform Charged'", "platform_charged")]),
    "flavorcloud": ("tracking_number", [("'Shipping Charges (USD)'", "shipping_charges"), ("'Commissions (USD)'", "commissions"), ("'LandedCost (Duty + Taxes + Fees) (USD)'", "landed_cost"), ("'Insurance (USD)'", "insurance")]),
    "passport": ("tracking_number", [("'Rate'", "rate"), ("'Fuel Surcharge'", "fuel_surcharge"), ("'Tax'", "tax"), ("'Duty'", "duty"), ("'Insurance'", "insurance"), ("'Clearance Fee'", "clearance_fee"), *[(f"fee_{k}_description", f"fee_{k}_amount") for k in range(1, 9)]]),
    "uniuni": ("tracking_number", list(zip(
        [f"'{x}'" for x in ("Base Rate", "Discount Fee", "Signature Fee", "Pick Up Fee", "Over Dimension Fee", "Over Max Size Fee", "Over Weight Fee", "Fuel Surcharge",
                            "Peak Season Surcharge", "Delivery Area Surcharge", "Delivery Area Surcharge Extend", "Truck Fee", "Relabel Fee", "Miscellaneous Fee",
                            "Credit Card Surcharge", "Credit", "Approved Claim")],
        [f for f in UNI_FEES if f != "billed_fee"],
    ))),
}


def tall(c: str) -> str:
    """tall_<c>: one row per line and charge."""
    tracking, pairs = CHARGES[c]
    union = " UNION ALL ".join(
        f"SELECT carrier_id, file_id, bill_number, bill_date, {tracking} AS tracking_number, {name} AS charge_name, {num(amount)} AS amount FROM lines_{c}"
        for name, amount in pairs
    )
    return f"tall_{c} AS (SELECT * FROM ({union}) u WHERE trim(charge_name) <> '' AND amount <> 0)"


def charges(c: str) -> str:
    only = " AND EXISTS (SELECT 1 FROM attr_fedex a WHERE lower(a.tracking_number) = lower(t.tracking_number))" if c == "fedex" else ""
    return (
        f"chg_{c} AS (SELECT t.carrier_id, t.file_id, t.bill_number, t.bill_date, t.tracking_number, ct.charge_type_id, {num('sum(t.amount)')} AS amount "
        f"FROM tall_{c} t JOIN charge_types ct ON ct.carrier_id = t.carrier_id AND lower(rtrim(ct.charge_name)) = lower(rtrim(t.charge_name)) "
        f"WHERE trim(t.tracking_number) <> ''{only} GROUP BY ALL)"
    )


def unified(c: str, *, with_attributes: bool = True) -> str:
    """Input relations and everything up to chg_<c>."""
    extra = ["carriers", "methods"] if c in INTEGRATED else []
    parts = [ctes(f"stg_{c}", "charge_types", *extra), lines(c)]
    if with_attributes or c == "fedex":
        parts.append(attributes(c))
    parts += [tall(c), charges(c)]
    return "WITH " + ", ".join(parts) + " "


SUMMARY = """
cost AS (SELECT carrier_id, lower(rtrim(tracking_number)) AS k, CAST(sum(amount) AS DECIMAL(18,2)) AS v, count(*) AS n FROM chg_easypost GROUP BY 1, 2),
summary AS (SELECT a.*, COALESCE(c.v, CAST(0 AS DECIMAL(18,2))) AS billed_shipping_cost, COALESCE(c.n, 0) AS charge_count
  FROM attr_easypost a LEFT JOIN cost c ON c.carrier_id = a.carrier_id AND c.k = lower(rtrim(a.tracking_number)))
"""


def fixed_variance(source: str) -> str:
    """CTE `fixed_var` over a package relation."""
    return f"""
fv1 AS (SELECT shipment_package_id, tracking_number, CAST(ceil(actual_weight_oz / 16.0) AS DECIMAL(18,2)) AS actual_weight_lb,
    CAST(billed_weight_oz / 16.0 AS DECIMAL(18,6)) AS billed_weight_lb, billed_weight_oz, CAST(ceil(actual_weight_oz) AS DECIMAL(18,2)) AS actual_weight_oz,
    wms_shipping_cost, billed_shipping_cost FROM {source}),
fv2 AS (SELECT *, CASE WHEN billed_shipping_cost > wms_shipping_cost * 1.1 OR billed_shipping_cost < wms_shipping_cost * 0.9 THEN 1 ELSE 0 END AS is_cost_exception,
    CASE WHEN billed_shipping_cost > wms_shipping_cost * 1.1 THEN 'cost_high' WHEN billed_shipping_cost < wms_shipping_cost * 0.9 THEN 'cost_low' ELSE 'Normal' END AS cost_exception_type,
    CAST(billed_shipping_cost - wms_shipping_cost AS DECIMAL(10,2)) AS cost_variance_amount FROM fv1),
fixed_var AS (SELECT *,
    CASE WHEN is_cost_exception = 0 THEN 0
      WHEN billed_weight_oz < 16 THEN CASE WHEN billed_weight_oz > actual_weight_oz * 1.1 OR billed_weight_oz < actual_weight_oz * 0.9 THEN 1 ELSE 0 END
      ELSE CASE WHEN billed_weight_lb > actual_weight_lb * 1.1 OR billed_weight_lb < actual_weight_lb * 0.9 THEN 1 ELSE 0 END END AS is_weight_exception,
    CASE WHEN is_cost_exception = 0 THEN 'Normal'
      WHEN billed_weight_oz < 16 THEN CASE WHEN billed_weight_oz > actual_weight_oz * 1.1 THEN 'weight_high' WHEN billed_weight_oz < actual_weight_oz * 0.9 THEN 'weight_low' ELSE 'Normal' END
      ELSE CASE WHEN billed_weight_lb > actual_weight_lb * 1.1 THEN 'weight_high' WHEN billed_weight_lb < actual_weight_lb * 0.9 THEN 'weight_low' ELSE 'Normal' END END AS weight_exception_type,
    CAST(CASE WHEN COALESCE(actual_weight_oz, 0) = 0 THEN 100.0
      WHEN billed_weight_oz < 16 THEN round(CAST(billed_weight_oz - actual_weight_oz AS DOUBLE) / CAST(actual_weight_oz AS DOUBLE) * 100, 2)
      ELSE round(CAST(billed_weight_lb - actual_weight_lb AS DOUBLE) / CAST(actual_weight_lb AS DOUBLE) * 100, 2) END AS DECIMAL(10,2)) AS weight_variance_percent
  FROM fv2)
"""


# packages after enrichment with the billed shipments, the warehouse side of the ledger
def wms_chain() -> str:
    return f"""
in_files AS (SELECT DISTINCT carrier_id, tracking_number FROM chg_easypost),
billed AS (SELECT s.* FROM summary s JOIN in_files f ON f.carrier_id = s.carrier_id AND f.tracking_number = s.tracking_number),
enriched AS (SELECT p.shipment_package_id, p.shipment_id, p.tracking_number, p.actual_weight_oz, p.wms_shipping_cost,
    b.shipment_date AS carrier_pickup_date, sm.shipping_method_id, b.billed_weight_oz, b.billed_length_in, b.billed_width_in, b.billed_height_in, b.billed_shipping_cost
  FROM packages p LEFT JOIN billed b ON lower(rtrim(b.tracking_number)) = lower(rtrim(p.tracking_number))
  LEFT JOIN methods sm ON sm.carrier_id = b.carrier_id AND lower(rtrim(sm.method_name)) = lower(rtrim(b.shipping_method))
    AND COALESCE(sm.integrated_carrier_id, 0) = COALESCE(b.integrated_carrier_id, 0)),
{fixed_variance('enriched')},
wms AS (SELECT lower(rtrim(e.tracking_number)) AS k, e.shipment_package_id, s.external_id AS shipment_external_id, o.customer_id,
    v.is_cost_exception, v.cost_exception_type, v.is_weight_exception, v.weight_exception_type
  FROM enriched e JOIN fixed_var v ON v.shipment_package_id = e.shipment_package_id
  LEFT JOIN shipments s ON s.shipment_id = e.shipment_id LEFT JOIN wms_orders o ON o.order_id = s.order_id),
ledger AS (SELECT c.carrier_id, c.file_id, c.bill_number, c.bill_date, c.tracking_number, c.charge_type_id, a.shipment_date,
    w.shipment_external_id, w.customer_id, sm.shipping_method_id, cc.category, ct.charge_name AS cost_item, c.amount, w.shipment_package_id,
    CASE WHEN w.is_weight_exception = 1 THEN w.weight_exception_type WHEN w.is_cost_exception = 1 THEN w.cost_exception_type
      WHEN w.shipment_package_id IS NOT NULL THEN 'matched' ELSE 'unknown' END AS status
  FROM chg_easypost c JOIN charge_types ct ON ct.charge_type_id = c.charge_type_id JOIN categories cc ON cc.category_id = ct.charge_category_id
  LEFT JOIN attr_easypost a ON a.carrier_id = c.carrier_id AND lower(a.tracking_number) = lower(c.tracking_number)
  LEFT JOIN methods sm ON sm.carrier_id = a.carrier_id AND lower(rtrim(sm.method_name)) = lower(rtrim(a.shipping_method))
    AND COALESCE(sm.integrated_carrier_id, 0) = COALESCE(a.integrated_carrier_id, 0)
  LEFT JOIN wms w ON w.k = lower(rtrim(c.tracking_number)))
"""


def gold(select: str) -> str:
    return unified("easypost") + ", " + SUMMARY + ", " + ctes_more("packages", "shipments", "wms_orders", "categories") + ", " + wms_chain() + select


def ctes_more(*names: str) -> str:
    """Relations beyond those that ``unified('easypost')`` brings in (they share no ancestor)."""
    return ctes(*names)


def simple(names: list[str], select: str) -> str:
    return f"WITH {ctes(*names)} {select}"
