"""Warehouse enrichment, cost ledger, markups and ledger backfill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fold, not_blank
from ..operators.groups import last_per_key
from ..operators.lookup import lookup_join
from ..operators.merge import append_new, joined_update
from .unify import SHIPMENT_KEY
from .variance import fixed_variance

PACKAGE_UPDATES = [
    "carrier_pickup_date", "shipping_method_id", "billed_weight_oz", "billed_length_in", "billed_width_in",
    "billed_height_in", "billed_shipping_cost",
]
LEDGER_KEY = ["carrier_id", "file_id", "bill_number", "bill_date", "tracking_number", "charge_type_id"]


def file_shipments(charges: DataFrame, file_ids: DataFrame | None = None) -> DataFrame:
    """The shipments that the charges of some files (or of all) belong to."""
    if file_ids is not None:
        charges = lookup_join(charges, file_ids.select("file_id").distinct(), ["file_id"], "left_semi")
    return charges.select(*SHIPMENT_KEY).distinct()


def of_files(attributes: DataFrame, in_files: DataFrame) -> DataFrame:
    """The attributes of some files' shipments."""
    keyed = attributes.withColumn("__shipment", fold(F.col("tracking_number")))
    wanted = in_files.select("carrier_id", fold(F.col("tracking_number")).alias("__shipment"))
    return keyed.join(wanted, ["carrier_id", "__shipment"], "left_semi").select(*attributes.columns)


def _by_tracking(rows: DataFrame, latest_first: list[str]) -> DataFrame:
    """One row per tracking number over all carriers: warehouse tables know no carrier at this point.
    Several candidates agree on the latest shipment."""
    tracked = rows.where(not_blank(F.col("tracking_number")))
    return last_per_key(tracked, [fold(F.col("tracking_number"))], latest_first).withColumn(
        "__tracking", fold(F.col("tracking_number"))
    )


def method_ids(methods: DataFrame) -> DataFrame:
    return methods.groupBy(
        F.col("carrier_id"), fold(F.col("method_name")).alias("method_key"), F.col("integrated_carrier_id")
    ).agg(F.min("shipping_method_id").alias("shipping_method_id"))


def with_method_id(shipments: DataFrame, methods: DataFrame) -> DataFrame:
    """Method id by (carrier, method, integrated carrier), where no integrated carrier equals none."""
    keyed = shipments.withColumn("method_key", fold(F.col("shipping_method")))
    return lookup_join(
        keyed, method_ids(methods), ["carrier_id", "method_key", "integrated_carrier_id"], "left", null_safe=True
    ).drop("method_key")


def enrich_shipments(shipments: DataFrame, packages: DataFrame, attributes: DataFrame, in_files: DataFrame) -> DataFrame:
    """Warehouse shipments get zone and carrier of the billed shipment of one of their packages."""
    billed = of_files(attributes, in_files).select(
        "tracking_number", "shipment_date", "destination_zone", "carrier_id"
    )
    one = _by_tracking(billed, ["shipment_date"])
    updates = (
        packages.select("shipment_id", fold(F.col("tracking_number")).alias("__tracking"))
        .where(not_blank(F.col("__tracking")))
        .join(one, "__tracking")
        .select("shipment_id", "shipment_date", "tracking_number", "destination_zone", "carrier_id")
    )
    latest = last_per_key(updates, [F.col("shipment_id")], ["shipment_date", "tracking_number"])
    return joined_update(
        shipments, latest.select("shipment_id", "destination_zone", "carrier_id"), "shipment_id",
        ["destination_zone", "carrier_id"],
    )


def enrich_packages(packages: DataFrame, summary: DataFrame, methods: DataFrame) -> DataFrame:
    """Warehouse packages get date, method, weight, size and cost of the billed shipment.

    ``summary`` is that of the shipments to carry over, see :func:`of_files`.
    """
    values = with_method_id(_by_tracking(summary, ["shipment_date"]), methods).select(
        "__tracking",
        F.col("shipment_date").alias("carrier_pickup_date"),
        *PACKAGE_UPDATES[1:],
    )
    keyed = packages.withColumn("__tracking", fold(F.col("tracking_number")))
    return joined_update(keyed, values, "__tracking", PACKAGE_UPDATES).drop("__tracking")


def ledger_status(package_id: Column, unmatched: str | None = "unknown") -> Column:
    status = F.when(F.col("is_weight_exception") == 1, F.col("weight_exception_type")).when(
        F.col("is_cost_exception") == 1, F.col("cost_exception_type")
    )
    if unmatched is None:
        return status.otherwise("matched")
    return status.when(package_id.isNotNull(), "matched").otherwise(unmatched)


def warehouse_view(packages: DataFrame, shipments: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per tracking number: package, its variance flags, external id and customer.

    Flags are computed on the package row itself, so the (already enriched) packages are read once.
    """
    flagged = fixed_variance(packages, exceptions_only=False, keep=("shipment_id",)).select(
        "shipment_package_id", "shipment_id", "tracking_number", "is_cost_exception", "cost_exception_type",
        "is_weight_exception", "weight_exception_type",
    )
    one = _by_tracking(flagged, ["shipment_package_id"])
    return (
        one.join(shipments.select("shipment_id", "order_id", "external_id"), "shipment_id", "left")
        .join(orders.select("order_id", "customer_id"), "order_id", "left")
        .select(
            "__tracking", "shipment_package_id", F.col("external_id").alias("shipment_external_id"), "customer_id",
            "is_cost_exception", "cost_exception_type", "is_weight_exception", "weight_exception_type",
        )
    )


def cost_ledger(
    charges: DataFrame,
    attributes: DataFrame,
    methods: DataFrame,
    charge_types: DataFrame,
    categories: DataFrame,
    packages: DataFrame,
    shipments: DataFrame,
    orders: DataFrame,
    existing: DataFrame | None = None,
) -> DataFrame:
    """One ledger row per charge with its warehouse match and status.

    Everything that hangs on the tracking number is first put on the shipment row, which is far
    smaller than the charges; the charges are then exchanged once, for one join.
    """
    wms = warehouse_view(packages, shipments, orders)
    known = with_method_id(attributes, methods).withColumn("__tracking", fold(F.col("tracking_number")))
    shipment = known.join(wms, "__tracking", "left").select(
        "carrier_id", "__tracking", "shipment_date", "shipping_method_id", "shipment_package_id",
        "shipment_external_id", "customer_id", ledger_status(F.col("shipment_package_id")).alias("status"),
    )
    items = charge_types.join(
        categories.select(F.col("category_id").alias("charge_category_id"), "category"), "charge_category_id"
    ).select("charge_type_id", "category", F.col("charge_name").alias("cost_item"))
    if existing is not None:
        charges = append_new(charges, existing, LEDGER_KEY, text_keys=("tracking_number",))
    # the texts of an item follow after the exchange
    matched = charges.withColumn("__tracking", fold(F.col("tracking_number"))).join(shipment, ["carrier_id", "__tracking"], "left")
    return (
        lookup_join(matched, items, ["charge_type_id"], "inner")
        .select(
            *LEDGER_KEY, "shipment_date", "shipment_external_id", "customer_id", "shipping_method_id", "category",
            "cost_item", "amount", "shipment_package_id", F.coalesce("status", F.lit("unknown")).alias("status"),
        )
    )


def match_waiting(
    waiting: DataFrame, attributes: DataFrame, methods: DataFrame, packages: DataFrame, shipments: DataFrame, orders: DataFrame,
) -> DataFrame:
    """Ledger rows without a package, with the package where the warehouse knows one by now."""
    wms = warehouse_view(packages, shipments, orders)
    known = with_method_id(attributes, methods).select(
        "carrier_id", fold(F.col("tracking_number")).alias("__tracking"), "shipping_method_id"
    )
    found = wms.join(known, "__tracking").select(
        "carrier_id", "__tracking",
        F.struct(
            "shipment_package_id", "shipment_external_id", "customer_id", "shipping_method_id",
            ledger_status(F.col("shipment_package_id"), unmatched=None).alias("status"),
        ).alias("__u"),
    )
    updated = ["shipment_package_id", "shipment_external_id", "customer_id", "shipping_method_id", "status"]
    return waiting.withColumn("__tracking", fold(F.col("tracking_number"))).join(found, ["carrier_id", "__tracking"], "left").select(
        *[
            F.when(F.col("__u").isNotNull(), F.col(f"__u.{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c)
            for c in waiting.columns
        ]
    )


def backfill_ledger(
    ledger: DataFrame, attributes: DataFrame, methods: DataFrame, packages: DataFrame, shipments: DataFrame,
    orders: DataFrame,
) -> DataFrame:
    """Ledger rows without a package get one as soon as the warehouse knows it; the rest stay as they are."""
    open_row = F.col("shipment_package_id").isNull()
    matched = match_waiting(ledger.where(open_row), attributes, methods, packages, shipments, orders)
    return ledger.where(~open_row).unionByName(matched)


def latest_default_markup(defaults: DataFrame) -> DataFrame:
    return defaults.where(F.col("deleted_at").isNull()).orderBy(F.desc("created_at"), F.desc("id")).limit(1).select("markup")


def missing_markups(methods: DataFrame, markups: DataFrame, defaults: DataFrame) -> DataFrame:
    """The default markup for every method that has none."""
    return (
        append_new(methods, markups, ["shipping_method_id"])
        .crossJoin(F.broadcast(latest_default_markup(defaults)))
        .select(
            "carrier_id", "shipping_method_id", "markup", F.lit("percentage").alias("markup_type"),
            "integrated_carrier_id",
        )
    )


def with_display_names(methods: DataFrame, carriers: DataFrame) -> DataFrame:
    """`Aggregator (Carrier)` for markup screens; the working carrier alone for customer invoices."""
    names = carriers.select("carrier_id", "carrier_name")
    own = lookup_join(methods, names, ["carrier_id"], "inner")
    working = names.select(
        F.col("carrier_id").alias("integrated_carrier_id"), F.col("carrier_name").alias("integrated_carrier_name")
    )
    both = lookup_join(own, working, ["integrated_carrier_id"], "left")
    inner = F.col("integrated_carrier_name")
    label = F.when(
        inner.isNotNull(), F.concat(F.col("carrier_name"), F.lit(" ("), inner, F.lit(")"))
    ).otherwise(F.col("carrier_name"))
    return both.select(
        *methods.columns,
        label.alias("carrier_label"),
        F.concat(label, F.lit(" "), F.col("method_name")).alias("method_label"),
        F.coalesce("integrated_carrier_id", "carrier_id").alias("invoice_carrier_id"),
        F.coalesce(inner, F.col("carrier_name")).alias("invoice_carrier_name"),
    )


def marked_up(ledger: DataFrame, markups: DataFrame, *, as_fraction: bool = False) -> DataFrame:
    """Ledger amounts with the customer's price. A markup of 15 means 15 % unless ``as_fraction``."""
    share = F.col("markup") if as_fraction else F.col("markup") / F.expr("100BD")
    rates = markups.groupBy("shipping_method_id").agg(F.max("markup").alias("markup"))
    return lookup_join(ledger, rates, ["shipping_method_id"], "left").withColumn(
        "customer_price",
        (F.col("amount") * (1 + F.coalesce(share, F.lit(0).cast("decimal(18,4)")))).cast("decimal(18,2)"),
    )
