"""What differs between the eight carriers: required cells, invoice roll-up, typed line, attributes, charges.

A plan holds functions that return column expressions over the staged (text) or typed (line) columns.
The jobs in ``normalise``, ``reference`` and ``unify`` are the same for all carriers.

Staged frames carry ``file_id`` and typed lines carry (file_id, bill_number, bill_date): the invoice's
own key. With it a line needs no join to find its invoice, and invoices of the same number in two
files (corrections) stay apart.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from ..functions import (
    blank_to_null, decimal_of, fold, not_blank, null_as_zero, parse_date, parse_long_date,
    parse_rfc3339, parse_us_dashed, to_inches, to_ounces,
)
from ..operators.unpivot import described, fixed
from ..sources.contracts import FEDEX_CHARGE_PAIRS, PASSPORT_FEES, UNIUNI_FEES

Pairs = list[tuple[Column, Column]]


@dataclass(frozen=True)
class Invoice:
    number: Callable[[], Column]
    date: Callable[[], Column]
    amount: Callable[[], Column]
    account: Callable[[], Column]
    count_distinct: Callable[[], Column] | None = None  # shipments = distinct values of this
    by_account: bool = False  # one invoice per account even under the same number
    per_file: bool = False  # number and date come from an aggregate over the file


@dataclass(frozen=True)
class Attributes:
    tracking: Callable[[], Column]
    shipment_date: Callable[[], Column]
    method: Callable[[], Column]
    zone: Callable[[], Column]
    weight_oz: Callable[[], Column]
    length_in: Callable[[], Column]
    width_in: Callable[[], Column]
    height_in: Callable[[], Column]


@dataclass(frozen=True)
class CarrierPlan:
    key: str
    carrier_id: int
    required: Callable[[], Column]
    invoice: Invoice
    line: Callable[[], dict[str, Column]]
    attributes: Attributes
    charges: Callable[[], Pairs]
    line_required: Callable[[], Column] = lambda: F.lit(True)
    seeds: list[tuple[str, bool, int]] = field(default_factory=list)  # charge name, freight, category
    integrated: bool = False  # lines name the carrier that did the work
    not_null: tuple[str, ...] = ()  # line columns without which the file is refused
    named_charges: tuple[str, ...] = ()  # the names of ``charges`` where they are the same on every line, in their order


STANDARD, ADJUSTMENT = 11, 16  # fixed values: ids of charge categories


def _text(*names: str) -> dict[str, Column]:
    return {n: blank_to_null(F.col(n)) for n in names}


def _strict(*names: str, precision: int = 18, scale: int = 2, commas: bool = False) -> dict[str, Column]:
    return {n: decimal_of(F.col(n), precision, scale, commas=commas) for n in names}


def _zero(*names: str, precision: int = 18, scale: int = 2) -> dict[str, Column]:
    return {n: decimal_of(F.col(n), precision, scale, blank="0") for n in names}


def _col(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def _null(kind: str) -> Callable[[], Column]:
    return lambda: F.lit(None).cast(kind)


# --- FedEx: one wide row per package, up to 51 named charges -----------------------------------

FEDEX_CHARGES = [(f"charge_description_{k}", f"charge_amount_{k}") for k in range(FEDEX_CHARGE_PAIRS)]

FEDEX = CarrierPlan(
    key="fedex",
    carrier_id=1,
    required=lambda: not_blank(F.col("invoice_number")) & not_blank(F.col("invoice_date")),
    invoice=Invoice(
        number=lambda: blank_to_null(F.col("invoice_number")),
        date=lambda: parse_date(F.col("invoice_date")),
        amount=lambda: decimal_of(F.col("net_charge_amount"), commas=True),
        account=lambda: blank_to_null(F.col("account_number")),
    ),
    line=lambda: {
        **_text("service_type"),
        "shipment_date": parse_date(F.col("shipment_date")),
        **_text("express_or_ground_tracking_id", "msp_tracking_id", "zone_code"),
        **_strict("net_charge_amount", commas=True),
        **_strict("rated_weight_amount"),
        **_text("rated_weight_units"),
        **_strict("dim_length", "dim_width", "dim_height"),
        **_text("dim_unit", "shipper_zip_code"),
        **_strict("transportation_charge_amount", commas=True),
        **_text(*[d for d, _ in FEDEX_CHARGES]),
        **_strict(*[a for _, a in FEDEX_CHARGES], commas=True),
    },
    # the date, method and zone named here are the ones hoisted to the group by ``multipiece``
    attributes=Attributes(
        tracking=lambda: F.coalesce(blank_to_null(F.col("msp_tracking_id")), F.col("express_or_ground_tracking_id")),
        shipment_date=lambda: F.col("group_shipment_date").cast("timestamp_ntz"),
        method=_col("group_service_type"),
        zone=_col("group_zone_code"),
        weight_oz=lambda: to_ounces(F.col("rated_weight_amount"), F.col("rated_weight_units"), "fedex"),
        length_in=lambda: to_inches(F.col("dim_length"), F.col("dim_unit"), "fedex"),
        width_in=lambda: to_inches(F.col("dim_width"), F.col("dim_unit"), "fedex"),
        height_in=lambda: to_inches(F.col("dim_height"), F.col("dim_unit"), "fedex"),
    ),
    charges=lambda: fixed(("Transportation Charge", "transportation_charge_amount")) + described(*FEDEX_CHARGES),
    not_null=("express_or_ground_tracking_id",),
)


# --- UPS: one row per charge -------------------------------------------------------------------

def split_dimensions(c: Column) -> tuple[Column, Column, Column]:
    """`11.0x  8.0x  3.0` to length, width, height. Zero or unreadable gives NULL, as does a text
    without two separators."""
    parts = F.split(F.lower(c), "x", 3)

    def one(i: int) -> Column:
        return F.when(F.size(parts) == 3, F.nullif(decimal_of(parts[i], lenient=True), F.lit(0)))

    return one(0), one(1), one(2)


def ups_charge_name(description: Column, category: Column) -> Column:
    return F.when(category == "SHP", description).otherwise(F.concat(description, F.lit(" - "), category))


def _ups_line() -> dict[str, Column]:
    length, width, height = split_dimensions(F.col("package_dimensions"))
    return {
        **_text(
            "charge_description", "charge_classification_code", "charge_category_code",
            "charge_category_detail_code",
        ),
        "transaction_date": parse_date(F.col("transaction_date")).cast("timestamp_ntz"),
        **_text("tracking_number", "zone"),
        **_strict("net_amount", "billed_weight"),
        **_text("billed_weight_unit"),
        "dim_length": length,
        "dim_width": width,
        "dim_height": height,
        **_text("dim_unit", "sender_postal"),
    }


UPS = CarrierPlan(
    key="ups",
    carrier_id=2,
    required=lambda: not_blank(F.col("invoice_date")),
    line_required=lambda: not_blank(F.col("charge_description")) & not_blank(F.col("charge_classification_code")),
    invoice=Invoice(
        number=lambda: blank_to_null(F.col("invoice_number")),
        date=lambda: parse_date(F.col("invoice_date")),
        amount=lambda: decimal_of(F.col("net_amount")),
        account=lambda: blank_to_null(F.col("account_number")),
        count_distinct=lambda: F.rtrim(F.col("tracking_number")),
    ),
    line=_ups_line,
    attributes=Attributes(
        tracking=_col("tracking_number"),
        shipment_date=_col("transaction_date"),
        method=lambda: F.when(
            (F.col("charge_category_code") == "SHP") & (F.col("charge_classification_code") == "FRT"),
            F.col("charge_description"),
        ),
        zone=_col("zone"),
        weight_oz=lambda: to_ounces(F.col("billed_weight"), F.col("billed_weight_unit"), "ups"),
        length_in=lambda: to_inches(F.col("dim_length"), F.col("dim_unit"), "ups"),
        width_in=lambda: to_inches(F.col("dim_width"), F.col("dim_unit"), "ups"),
        height_in=lambda: to_inches(F.col("dim_height"), F.col("dim_unit"), "ups"),
    ),
    charges=lambda: [
        (ups_charge_name(F.col("charge_description"), F.col("charge_category_code")), F.col("net_amount"))
    ],
    not_null=("charge_category_code", "charge_category_detail_code", "net_amount"),
)


# --- DHL ---------------------------------------------------------------------------------------

DHL_CHARGES = (
    ("Transportation Cost", "transportation_cost"),
    ("Non-Qualified Dim", "non_qualified_dimensional_charges"),
    ("Fuel Surcharge", "fuel_surcharge_amount"),
    ("Delivery Area Surcharge", "delivery_area_surcharge_amount"),
)


def dhl_domestic_tracking(zip_code: Column, unique_id: Column) -> Column:
    """`420` + first five of the zip + unique id; NULL when either is. The zip stays text, so that
    leading zeros survive."""
    zip5 = F.left(F.replace(zip_code, F.lit(" "), F.lit("")), F.lit(5))
    return F.concat(F.lit("420"), zip5, F.trim(unique_id))


def dhl_tracking(country: Column, domestic: Column, international: Column) -> Column:
    return F.when(F.upper(F.trim(country)) == "US", domestic).otherwise(international)


def dhl_total(cost: Callable[[str], Column]) -> Column:
    total = None
    for _, name in DHL_CHARGES:
        part = null_as_zero(cost(name))
        total = part if total is None else total + part
    return total


DHL = CarrierPlan(
    key="dhl",
    carrier_id=3,
    required=lambda: F.col("invoice_number").isNotNull() & not_blank(F.col("invoice_date")),
    invoice=Invoice(
        number=lambda: F.trim(F.col("invoice_number")),
        date=lambda: parse_date(F.col("invoice_date")),
        amount=lambda: dhl_total(lambda n: decimal_of(F.col(n))),
        account=lambda: blank_to_null(F.col("account_number")),
    ),
    line=lambda: {
        "shipping_date": parse_date(F.col("shipping_date")),
        "international_tracking_number": blank_to_null(F.col("international_tracking_number")),
        "domestic_tracking_number": dhl_domestic_tracking(
            F.col("recipient_zip_postal_code"), F.col("unique_id")
        ),
        "recipient_zip_postal_code": F.col("recipient_zip_postal_code"),
        "recipient_country": F.col("recipient_country"),
        "shipping_method": F.col("shipping_method"),
        **_strict("shipped_weight"),
        "shipped_weight_unit": F.col("shipped_weight_unit"),
        **_strict("billed_weight"),
        "billed_weight_unit": F.col("billed_weight_unit"),
        "zone": F.col("zone"),
        **_strict(*[c for _, c in DHL_CHARGES]),
    },
    attributes=Attributes(
        tracking=lambda: dhl_tracking(
            F.col("recipient_country"), F.col("domestic_tracking_number"), F.col("international_tracking_number")
        ),
        shipment_date=lambda: F.col("shipping_date").cast("timestamp_ntz"),
        method=_col("shipping_method"),
        zone=_col("zone"),
        weight_oz=lambda: to_ounces(F.col("billed_weight"), F.col("billed_weight_unit"), "dhl"),
        length_in=_null("decimal(18,2)"),
        width_in=_null("decimal(18,2)"),
        height_in=_null("decimal(18,2)"),
    ),
    charges=lambda: fixed(*DHL_CHARGES),
    named_charges=tuple(name for name, _ in DHL_CHARGES),
    # fixed values: charge types with their category ids
    seeds=[
        ("Transportation Cost", True, 15),
        ("Non-Qualified Dim", False, 12),
        ("Fuel Surcharge", False, 8),
        ("Delivery Area Surcharge", False, 4),
    ],
)


# --- EasyPost: invoice number made of account and day --------------------------------------------

def _easypost_bill_date() -> Column:
    return parse_rfc3339(F.col("created_at")).cast("date")


EASYPOST = CarrierPlan(
    key="easypost",
    carrier_id=4,
    required=lambda: not_blank(F.col("created_at")) & not_blank(F.col("tracking_code")),
    invoice=Invoice(
        number=lambda: F.concat(
            F.coalesce(F.trim(F.col("carrier_account_id")), F.lit("")),
            F.lit("-"),
            F.date_format(_easypost_bill_date(), "yyyy-MM-dd"),
        ),
        date=_easypost_bill_date,
        amount=lambda: decimal_of(F.col("postage_fee"), blank="0"),
        account=lambda: F.trim(F.col("carrier_account_id")),
    ),
    line=lambda: {
        "tracking_code": F.trim(F.col("tracking_code")),
        **_zero("weight", "rate", "label_fee", "postage_fee"),
        "usps_zone": blank_to_null(F.col("usps_zone")).cast("smallint"),
        "from_zip": F.col("from_zip"),
        **_zero("length", "width", "height"),
        "postage_label_created_at": parse_rfc3339(F.col("postage_label_created_at")),
        **_zero("insurance_fee", "carbon_offset_fee"),
        "service": F.col("service"),
        "integrated_carrier": blank_to_null(F.col("carrier")),
    },
    attributes=Attributes(
        tracking=_col("tracking_code"),
        shipment_date=_col("postage_label_created_at"),
        method=_col("service"),
        zone=lambda: F.col("usps_zone").cast("string"),
        weight_oz=_col("weight"),
        length_in=_col("length"),
        width_in=_col("width"),
        height_in=_col("height"),
    ),
    charges=lambda: [
        *fixed(("Base Rate", "rate"), ("Label Fee", "label_fee")),
        (F.lit("Unknown Charges"), F.col("postage_fee") - F.col("rate")),
        *fixed(("Carbon Offset Fee", "carbon_offset_fee"), ("Insurance Fee", "insurance_fee")),
    ],
    named_charges=("Base Rate", "Label Fee", "Unknown Charges", "Carbon Offset Fee", "Insurance Fee"),
    seeds=[
        ("Base Rate", True, STANDARD),
        ("Label Fee", False, STANDARD),
        ("Unknown Charges", False, STANDARD),
        ("Carbon Offset Fee", False, STANDARD),
        ("Insurance Fee", False, STANDARD),
    ],
    integrated=True,
)


# --- Eliteworks: one invoice per file ------------------------------------------------------------

ELITEWORKS = CarrierPlan(
    key="eliteworks",
    carrier_id=5,
    required=lambda: not_blank(F.col("time_utc")) & not_blank(F.col("tracking_number")),
    invoice=Invoice(
        number=lambda: F.concat(F.lit("Eliteworks_"), F.date_format(F.col("last_day"), "yyyy-MM-dd")),
        date=_col("last_day"),
        amount=lambda: decimal_of(F.col("platform_charged_with_corrections")),
        account=lambda: blank_to_null(F.col("user_account")),
        per_file=True,
    ),
    line=lambda: {
        "tracking_number": F.trim(F.col("tracking_number")),
        "shipment_date": parse_rfc3339(F.col("first_scan")),
        "service_method": F.col("service"),
        "zone": F.col("zone"),
        "charged_amount": decimal_of(F.col("charged")),
        **_strict("store_markup"),
        "platform_charged": decimal_of(F.col("platform_charged_with_corrections")),
        "billed_weight_oz": decimal_of(F.col("shipment_weight_oz")),
        **_strict("package_length_in", "package_width_in", "package_height_in"),
        "from_postal": F.col("from_postal"),
        "shipment_status": F.col("status"),
        "integrated_carrier": blank_to_null(F.col("carrier")),
    },
    attributes=Attributes(
        tracking=_col("tracking_number"),
        shipment_date=_col("shipment_date"),
        method=_col("service_method"),
        zone=_col("zone"),
        weight_oz=_col("billed_weight_oz"),
        length_in=_col("package_length_in"),
        width_in=_col("package_width_in"),
        height_in=_col("package_height_in"),
    ),
    charges=lambda: fixed(("Platform Charged", "platform_charged")),
    named_charges=("Platform Charged",),
    seeds=[("Platform Charged", False, STANDARD)],
    integrated=True,
    not_null=("tracking_number",),
)


# --- FlavorCloud: trailer rows below the shipments -------------------------------------------------

FLAVORCLOUD_CHARGES = (
    ("Shipping Charges (USD)", "shipping_charges"),
    ("Commissions (USD)", "commissions"),
    ("LandedCost (Duty + Taxes + Fees) (USD)", "landed_cost"),
    ("Insurance (USD)", "insurance"),
)

FLAVORCLOUD = CarrierPlan(
    key="flavorcloud",
    carrier_id=6,
    required=lambda: (
        not_blank(F.col("invoice_number"))
        & (fold(F.col("invoice_number")) != "total")
        & not_blank(F.col("shipment_number"))
    ),
    invoice=Invoice(
        number=lambda: F.trim(F.col("invoice_number")),
        date=lambda: parse_long_date(F.col("invoice_date")),
        amount=lambda: decimal_of(F.col("shipment_total_charges")),
        account=lambda: blank_to_null(F.col("origin_location")),
    ),
    line=lambda: {
        "order_number": F.col("order_number"),
        "tracking_number": F.trim(F.col("shipment_number")),
        **{
            n: F.col(n)
            for n in ("service_level", "terms_of_trade", "origin_location", "destination_country", "ship_to_zip")
        },
        "integrated_carrier": blank_to_null(F.col("carrier")),
        **_strict("total_weight", scale=6),
        "weight_unit": F.col("weight_unit"),
        **_strict("length", "width", "height"),
        "dimension_unit": F.col("dimension_unit"),
        **_strict(
            "commissions", "duties", "taxes", "fees", "landed_cost", "insurance", "shipping_charges",
            "order_value", "shipment_total_charges",
        ),
        "shipment_date": parse_us_dashed(F.col("shipment_date")),
        "payment_terms": F.col("payment_terms"),
        "due_date": parse_us_dashed(F.col("due_date")),
    },
    attributes=Attributes(
        tracking=_col("tracking_number"),
        shipment_date=lambda: F.col("shipment_date").cast("timestamp_ntz"),
        method=_col("service_level"),
        zone=_null("string"),
        weight_oz=lambda: to_ounces(F.col("total_weight"), F.col("weight_unit"), "flavorcloud"),
        length_in=lambda: to_inches(F.col("length"), F.col("dimension_unit"), "flavorcloud"),
        width_in=lambda: to_inches(F.col("width"), F.col("dimension_unit"), "flavorcloud"),
        height_in=lambda: to_inches(F.col("height"), F.col("dimension_unit"), "flavorcloud"),
    ),
    charges=lambda: fixed(*FLAVORCLOUD_CHARGES),
    named_charges=tuple(name for name, _ in FLAVORCLOUD_CHARGES),
    seeds=[(name, name.startswith("Shipping"), STANDARD) for name, _ in FLAVORCLOUD_CHARGES],
    integrated=True,
    not_null=("tracking_number",),
)


# --- Passport: six fixed charges and eight named fees ----------------------------------------------

PASSPORT_CHARGES = (
    ("Rate", "rate"),
    ("Fuel Surcharge", "fuel_surcharge"),
    ("Tax", "tax"),
    ("Duty", "duty"),
    ("Insurance", "insurance"),
    ("Clearance Fee", "clearance_fee"),
)
PASSPORT_FEE_PAIRS = [(f"fee_{k}_description", f"fee_{k}_amount") for k in range(1, PASSPORT_FEES + 1)]

PASSPORT = CarrierPlan(
    key="passport",
    carrier_id=7,
    required=lambda: not_blank(F.col("invoice_number")) & not_blank(F.col("tracking_id")),
    invoice=Invoice(
        number=lambda: F.trim(F.col("invoice_number")),
        date=lambda: parse_date(F.col("invoice_date")),
        amount=lambda: decimal_of(F.col("total")),
        account=lambda: blank_to_null(F.col("shipper_company")),
    ),
    line=lambda: {
        "ship_date": parse_date(F.col("ship_date")),
        **{
            n: F.col(n)
            for n in (
                "company", "client_code", "order_id", "service_level", "shipper_name", "shipper_company",
                "shipper_street", "shipper_city", "shipper_state", "shipper_zip", "shipper_country",
                "dest_street", "dest_city", "dest_state", "dest_zip", "dest_country",
            )
        },
        "tracking_number": F.trim(F.col("tracking_id")),
        **_strict("actual_weight_oz", "dimensional_weight_oz", "billable_weight_oz", scale=6),
        **_strict("length_in", "width_in", "height_in"),
        "currency": F.col("currency"),
        **_strict(*[c for _, c in PASSPORT_CHARGES]),
        **{d: F.col(d) for d, _ in PASSPORT_FEE_PAIRS},
        **_zero(*[a for _, a in PASSPORT_FEE_PAIRS]),
        **_strict("total"),
    },
    attributes=Attributes(
        tracking=_col("tracking_number"),
        shipment_date=lambda: F.col("ship_date").cast("timestamp_ntz"),
        method=_col("service_level"),
        zone=_null("string"),
        weight_oz=_col("billable_weight_oz"),
        length_in=_col("length_in"),
        width_in=_col("width_in"),
        height_in=_col("height_in"),
    ),
    charges=lambda: fixed(*PASSPORT_CHARGES) + described(*PASSPORT_FEE_PAIRS),
    seeds=[(name, name == "Rate", STANDARD) for name, _ in PASSPORT_CHARGES],
    not_null=("tracking_number",),
)


# --- UniUni: 17 charges, dimensional weight ---------------------------------------------------------

UNIUNI_CHARGES = (
    ("Base Rate", "base_fee"),
    ("Discount Fee", "discount_fee"),
    ("Signature Fee", "signature_fee"),
    ("Pick Up Fee", "pickup_fee"),
    ("Over Dimension Fee", "over_dimension_fee"),
    ("Over Max Size Fee", "over_max_size_fee"),
    ("Over Weight Fee", "over_weight_fee"),
    ("Fuel Surcharge", "fuel_surcharge"),
    ("Peak Season Surcharge", "peak_season_surcharge"),
    ("Delivery Area Surcharge", "delivery_area_surcharge"),
    ("Delivery Area Surcharge Extend", "delivery_area_surcharge_extend"),
    ("Truck Fee", "truck_fee"),
    ("Relabel Fee", "relabel_fee"),
    ("Miscellaneous Fee", "miscellaneous_fee"),
    ("Credit Card Surcharge", "credit_card_surcharge"),
    ("Credit", "credit"),
    ("Approved Claim", "approved_claim"),
)

UNIUNI = CarrierPlan(
    key="uniuni",
    carrier_id=8,
    required=lambda: F.lit(True),
    invoice=Invoice(
        number=lambda: F.trim(F.col("invoice_number")),
        date=lambda: parse_date(F.col("invoice_time")),
        amount=lambda: decimal_of(F.col("total_billed_amount"), blank="0"),
        account=lambda: F.trim(F.col("merchant_id")),
        by_account=True,
    ),
    line=lambda: {
        "tracking_number": blank_to_null(F.col("tracking_number")),
        **_strict("total_billed_amount"),
        **_strict("billable_weight", scale=4),
        "billable_weight_uom": F.trim(F.col("billable_weight_uom")),
        **_strict("scaled_weight", scale=4),
        "scaled_weight_uom": F.trim(F.col("scaled_weight_uom")),
        **_strict("dim_weight", scale=4),
        "dim_weight_uom": F.trim(F.col("dim_weight_uom")),
        "zone": blank_to_null(F.col("zone")).cast("int"),
        "induction_facility_zipcode": blank_to_null(F.col("induction_facility_zipcode")).cast("int"),
        **_strict("dim_length", "dim_width", "dim_height", scale=4),
        "package_dim_uom": F.trim(F.col("package_dim_uom")),
        "service_type": F.trim(F.col("service_type")),
        "shipment_date": parse_date(F.col("shipped_time")),
        "induction_time": parse_date(F.col("induction_time")),
        **_zero(*UNIUNI_FEES, precision=10),
    },
    attributes=Attributes(
        tracking=_col("tracking_number"),
        shipment_date=lambda: F.col("shipment_date").cast("timestamp_ntz"),
        method=_col("service_type"),
        zone=lambda: F.col("zone").cast("string"),
        weight_oz=lambda: to_ounces(F.col("dim_weight"), F.col("dim_weight_uom"), "uniuni"),
        length_in=lambda: to_inches(F.col("dim_length"), F.col("package_dim_uom"), "uniuni"),
        width_in=lambda: to_inches(F.col("dim_width"), F.col("package_dim_uom"), "uniuni"),
        height_in=lambda: to_inches(F.col("dim_height"), F.col("package_dim_uom"), "uniuni"),
    ),
    charges=lambda: fixed(*UNIUNI_CHARGES),
    named_charges=tuple(name for name, _ in UNIUNI_CHARGES),
    seeds=[(name, name == "Base Rate", STANDARD) for name, _ in UNIUNI_CHARGES],
    not_null=("tracking_number",),
)

PLANS = {p.key: p for p in (FEDEX, UPS, DHL, EASYPOST, ELITEWORKS, FLAVORCLOUD, PASSPORT, UNIUNI)}
