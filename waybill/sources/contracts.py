"""Staging contracts: which cell of a carrier's file becomes which staging column.

All staging columns are nullable text. A positional file is bound by ordinal because its header names
repeat; a named file is bound by header. Only columns that drive results are bound.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Contract:
    carrier: str
    width: int = 0  # number of cells, positional files only
    ordinals: dict[str, int] = field(default_factory=dict)  # column -> 1-based cell
    headers: dict[str, str] = field(default_factory=dict)  # column -> header text
    account_ordinal: int = 0  # 0-based cell of the first row that names the account
    has_header: bool = True  # positional files: whether the first line holds names
    header_record: bool = False  # the file begins with a record of its own about the invoice

    @property
    def positional(self) -> bool:
        return bool(self.ordinals)

    @property
    def columns(self) -> list[str]:
        return list(self.ordinals or self.headers)


# Cell positions, header texts and account positions of each carrier's file layout.
FEDEX_CHARGE_PAIRS = 51
FEDEX_FIRST_PAIR = 108  # description and amount alternate from this cell on

FEDEX = Contract(
    "fedex",
    width=210,
    ordinals={
        "account_number": 2,
        "invoice_date": 3,
        "invoice_number": 4,
        "express_or_ground_tracking_id": 10,
        "transportation_charge_amount": 11,
        "net_charge_amount": 12,
        "service_type": 13,
        "shipment_date": 15,
        "rated_weight_amount": 22,
        "rated_weight_units": 23,
        "dim_length": 29,
        "dim_width": 30,
        "dim_height": 31,
        "dim_unit": 33,
        "shipper_zip_code": 48,
        "zone_code": 65,
        "msp_tracking_id": 107,
        **{f"charge_description_{k}": FEDEX_FIRST_PAIR + 2 * k for k in range(FEDEX_CHARGE_PAIRS)},
        **{f"charge_amount_{k}": FEDEX_FIRST_PAIR + 2 * k + 1 for k in range(FEDEX_CHARGE_PAIRS)},
    },
    account_ordinal=1,
)

UPS = Contract(
    "ups",
    width=244,
    ordinals={
        "account_number": 3,
        "invoice_date": 5,
        "invoice_number": 6,
        "transaction_date": 12,
        "tracking_number": 21,
        "billed_weight": 29,
        "billed_weight_unit": 30,
        "package_dimensions": 33,
        "zone": 34,
        "charge_category_code": 35,
        "charge_category_detail_code": 36,
        "charge_classification_code": 44,
        "charge_description": 46,
        "net_amount": 53,
        "sender_postal": 73,
        "dim_unit": 196,
    },
    account_ordinal=2,
    has_header=False,
)

DHL = Contract(
    "dhl",
    width=79,
    ordinals={
        "account_number": 2,
        "shipping_date": 9,
        "international_tracking_number": 12,
        "unique_id": 13,
        "recipient_zip_postal_code": 19,
        "recipient_country": 20,
        "shipping_method": 22,
        "shipped_weight": 23,
        "shipped_weight_unit": 24,
        "billed_weight": 25,
        "billed_weight_unit": 26,
        "zone": 29,
        "transportation_cost": 30,
        "non_qualified_dimensional_charges": 48,
        "fuel_surcharge_amount": 65,
        "delivery_area_surcharge_amount": 79,
    },
    account_ordinal=1,
    has_header=False,
    header_record=True,
)
# cells of the DHL header record, the first line of the file
DHL_HEADER = {"bill_date": 2, "bill_number": 3, "account_number": 4, "total_amount": 12, "num_shipments": 14}

EASYPOST = Contract(
    "usps - easy post",
    headers={
        c: c
        for c in (
            "created_at", "tracking_code", "from_zip", "length", "width", "height", "weight",
            "postage_label_created_at", "service", "carrier", "rate", "label_fee", "postage_fee",
            "insurance_fee", "carbon_offset_fee", "usps_zone", "carrier_account_id",
        )
    },
    account_ordinal=32,
)

ELITEWORKS = Contract(
    "eliteworks",
    headers={
        "time_utc": "Time (UTC)",
        "user_account": "USER",
        "tracking_number": "Tracking",
        "status": "Status",
        "carrier": "Carrier",
        "service": "Service",
        "shipment_weight_oz": "Shipment Weight (Oz)",
        "package_length_in": "Package Length (In)",
        "package_width_in": "Package Width (In)",
        "package_height_in": "Package Height (In)",
        "from_postal": "From Postal",
        "first_scan": "First Scan",
        "zone": "Zone",
        "charged": "Charged",
        "store_markup": "Store Markup",
        "platform_charged_with_corrections": "Platform Charged (With Corrections)",
    },
    account_ordinal=2,
)

FLAVORCLOUD = Contract(
    "flavor cloud",
    headers={
        "invoice_number": "Invoice Number",
        "invoice_date": "Date",
        "order_number": "Order Number",
        "shipment_number": "Shipment Number",
        "service_level": "Service Level",
        "terms_of_trade": "Terms Of Trade",
        "origin_location": "Origin Location",
        "destination_country": "Destination Country",
        "ship_to_zip": "Ship To Address Zip",
        "carrier": "Carrier",
        "weight_unit": "Weight Unit",
        "total_weight": "Total Weight",
        "dimension_unit": "Dimension Unit",
        "length": "Length",
        "width": "Width",
        "height": "Height",
        "commissions": "Commissions (USD)",
        "duties": "Duties (USD)",
        "taxes": "Taxes (USD)",
        "fees": "Fees (USD)",
        "landed_cost": "LandedCost (Duty + Taxes + Fees) (USD)",
        "insurance": "Insurance (USD)",
        "shipping_charges": "Shipping Charges (USD)",
        "order_value": "Order Value (USD)",
        "shipment_total_charges": "Shipment Total Charges (USD)",
        "shipment_date": "Shipment Date",
        "payment_terms": "Payment Terms",
        "due_date": "Due Date",
    },
    account_ordinal=6,
)

PASSPORT_FEES = 8
PASSPORT = Contract(
    "passport",
    headers={
        **{
            c: c.replace("_", " ").upper()
            for c in (
                "invoice_number", "invoice_date", "ship_date", "company", "client_code", "order_id",
                "service_level", "shipper_name", "shipper_company", "shipper_street", "shipper_city",
                "shipper_state", "shipper_zip", "shipper_country", "dest_street", "dest_city",
                "dest_state", "dest_zip", "dest_country", "tracking_id", "currency", "rate",
                "fuel_surcharge", "tax", "duty", "insurance", "clearance_fee", "total",
            )
        },
        "actual_weight_oz": "ACTUAL WEIGHT (OZ)",
        "dimensional_weight_oz": "DIMENSIONAL WEIGHT (OZ)",
        "billable_weight_oz": "BILLABLE WEIGHT (OZ)",
        "length_in": "LENGTH (IN)",
        "width_in": "WIDTH (IN)",
        "height_in": "HEIGHT (IN)",
        **{f"fee_{k}_description": f"FEE {k} DESCRIPTION" for k in range(1, PASSPORT_FEES + 1)},
        **{f"fee_{k}_amount": f"FEE {k} AMOUNT" for k in range(1, PASSPORT_FEES + 1)},
    },
    account_ordinal=7,
)

UNIUNI_FEES = {
    "base_fee": "Base Fee",
    "discount_fee": "Discount Fee",
    "billed_fee": "Billed Fee",
    "signature_fee": "Signature Fee",
    "pickup_fee": "Pickup Fee",
    "over_dimension_fee": "Over Dimension Fee",
    "over_max_size_fee": "Over Max Size Fee",
    "over_weight_fee": "Over-weight Fee",
    "fuel_surcharge": "Fuel Surcharge",
    "peak_season_surcharge": "Peak Season Surcharge",
    "delivery_area_surcharge": "Delivery Area Surcharge",
    "delivery_area_surcharge_extend": "Delivery Area Surcharge Extend",
    "truck_fee": "Truck Fee",
    "relabel_fee": "Relabel Fee",
    "miscellaneous_fee": "Miscellaneous Fee",
    "credit_card_surcharge": "Credit Card Surcharge",
    "credit": "Credit",
    "approved_claim": "Approved Claim",
}
UNIUNI = Contract(
    "uniuni",
    headers={
        "invoice_number": "Invoice Number",
        "invoice_time": "Invoice Time",
        "merchant_id": "Merchant ID",
        "tracking_number": "Tracking Number",
        "total_billed_amount": "Total Billed Amount",
        "billable_weight": "Billable Weight",
        "billable_weight_uom": "Billable Weight UOM",
        "scaled_weight": "Scaled Weight",
        "scaled_weight_uom": "Scaled Weight UOM",
        "dim_weight": "Dim Weight",
        "dim_weight_uom": "Dim Weight UOM",
        "zone": "Zone",
        "induction_facility_zipcode": "Induction Facility ZipCode",
        "dim_length": "Package Length",
        "dim_width": "Package Width",
        "dim_height": "Package Height",
        "package_dim_uom": "Package DIM UOM",
        "service_type": "Service Type",
        "shipped_time": "Shipped Time",
        "induction_time": "Induction Time",
        **UNIUNI_FEES,
    },
    account_ordinal=6,
)

CONTRACTS = {c.carrier: c for c in (FEDEX, UPS, DHL, EASYPOST, ELITEWORKS, FLAVORCLOUD, PASSPORT, UNIUNI)}
# other spellings under which a carrier folder may appear
CARRIER_ALIASES = {"flavorcloud": "flavor cloud", "easypost": "usps - easy post"}
