"""Typed lines of any carrier to shipment attributes and shipment charges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fold, not_blank
from ..operators.groups import last_per_key
from ..operators.lookup import lookup_join
from ..operators.merge import append_new, duplicate_keys, require_unique, upsert
from ..operators.unpivot import unpivot_charges
from . import multipiece
from .carriers import FEDEX, UPS, CarrierPlan
from .normalise import BILL_KEY

SHIPMENT_KEY = ["carrier_id", "tracking_number"]
CHARGE_KEY = ["carrier_id", *BILL_KEY, "tracking_number", "charge_type_id"]
TEXT_KEYS = ("bill_number", "tracking_number")  # compared without case and trailing blanks
MEASURES = ["destination_zone", "billed_weight_oz", "billed_length_in", "billed_width_in", "billed_height_in"]
ATTRIBUTES = [*SHIPMENT_KEY, "shipment_date", "shipping_method", *MEASURES, "integrated_carrier_id"]


def arrival(lines: DataFrame) -> Column:
    """The order in which files came: the rows' own number, else their file's."""
    return F.col("arrival" if "arrival" in lines.columns else "file_id")


def _attribute_rows(plan: CarrierPlan, lines: DataFrame, extra: list[str]) -> DataFrame:
    a = plan.attributes
    money = "decimal(18,2)"
    return lines.select(
        "carrier_id",
        a.tracking().alias("tracking_number"),
        a.shipment_date().alias("shipment_date"),
        a.method().alias("shipping_method"),
        a.zone().alias("destination_zone"),
        a.weight_oz().cast(money).alias("billed_weight_oz"),
        a.length_in().cast(money).alias("billed_length_in"),
        a.width_in().cast(money).alias("billed_width_in"),
        a.height_in().cast(money).alias("billed_height_in"),
        *extra,
    ).where(not_blank(F.col("tracking_number")))


def integrated_methods(plan: CarrierPlan, methods: DataFrame, carriers: DataFrame) -> DataFrame:
    """The aggregator's methods by folded (method, carrier name), one row each."""
    own = methods.where((F.col("carrier_id") == plan.carrier_id) & F.col("integrated_carrier_id").isNotNull())
    named = carriers.select(F.col("carrier_id").alias("integrated_carrier_id"), fold(F.col("carrier_name")).alias("carrier_key"))
    return (
        own.join(named, "integrated_carrier_id")
        .groupBy(fold(F.col("method_name")).alias("method_key"), "carrier_key")
        .agg(F.min("integrated_carrier_id").cast("int").alias("integrated_carrier_id"))
    )


def shipment_attributes(
    plan: CarrierPlan, lines: DataFrame, *, methods: DataFrame | None = None, carriers: DataFrame | None = None
) -> DataFrame:
    """One row per shipment of the carrier, from all files in ``lines``.

    The first file to name a shipment decides, so it does not matter which files are loaded together.
    Several lines of it in that file agree on one row: the latest by date, then the greatest value.
    """
    if plan is UPS:
        return _merge_files(_consolidate(plan, lines))
    if plan is FEDEX:
        lines = multipiece.packages(lines)
    extra = ["integrated_carrier"] if plan.integrated else []
    rows = _attribute_rows(plan, lines, [*extra, (-arrival(lines)).alias("__earliness")])
    one = last_per_key(rows, [F.col("carrier_id"), fold(F.col("tracking_number"))], ["__earliness", "shipment_date"])
    one = one.drop("__earliness")
    if not plan.integrated:
        return one.withColumn("integrated_carrier_id", F.lit(None).cast("int"))
    keyed = one.withColumns(
        {"method_key": fold(F.col("shipping_method")), "carrier_key": fold(F.col("integrated_carrier"))}
    )
    known = integrated_methods(plan, methods, carriers)
    return lookup_join(keyed, known, ["method_key", "carrier_key"], "left").select(*ATTRIBUTES)


def _consolidate(plan: CarrierPlan, lines: DataFrame) -> DataFrame:
    """Charge rows of one shipment and file to one row: the greatest value of each attribute."""
    rows = _attribute_rows(plan, lines, ["file_id", arrival(lines).alias("__arrival")])
    return rows.groupBy("carrier_id", "file_id", "__arrival", fold(F.col("tracking_number")).alias("__key")).agg(
        *[F.max(c).alias(c) for c in ("tracking_number", "shipment_date", "shipping_method", *MEASURES)]
    )


def _merge_files(per_file: DataFrame) -> DataFrame:
    """Files in order of arrival: the first one sets date and method, later ones correct the measures."""
    when = F.struct("__arrival", "file_id")
    return (
        per_file.groupBy("carrier_id", "__key").agg(
            F.min_by("tracking_number", when).alias("tracking_number"),
            F.min_by("shipment_date", when).alias("shipment_date"),
            F.min_by("shipping_method", when).alias("shipping_method"),
            *[F.max_by(c, F.when(F.col(c).isNotNull(), when)).alias(c) for c in MEASURES],
        )
        .withColumn("integrated_carrier_id", F.lit(None).cast("int"))
        .select(*ATTRIBUTES)
    )


def upsert_attributes(plan: CarrierPlan, existing: DataFrame, found: DataFrame) -> DataFrame:
    """The attribute table after a load: UPS corrects known shipments, the others only add new ones."""
    if plan is UPS:
        return upsert(
            existing.select(*ATTRIBUTES), found, SHIPMENT_KEY, refresh=MEASURES,
            insert_only=["shipment_date", "shipping_method", "integrated_carrier_id"], text_keys=("tracking_number",),
        ).select(*ATTRIBUTES)
    new = append_new(found, existing, SHIPMENT_KEY, text_keys=("tracking_number",))
    return existing.select(*ATTRIBUTES).unionByName(new.select(*ATTRIBUTES))


def charge_rows(plan: CarrierPlan, lines: DataFrame) -> DataFrame:
    """Every charge of every line, by name, before charge types are looked up."""
    tracking = F.col("express_or_ground_tracking_id") if plan is FEDEX else plan.attributes.tracking()
    keyed = lines.withColumn("__tracking", tracking)
    return unpivot_charges(keyed, plan.charges(), ["carrier_id", *BILL_KEY, "__tracking"]).withColumnRenamed(
        "__tracking", "tracking_number"
    )


def shipment_charges(
    plan: CarrierPlan,
    lines: DataFrame,
    charge_types: DataFrame,
    *,
    attributes: DataFrame | None = None,
    on_duplicate: str = "sum",
) -> DataFrame:
    """One row per (invoice, shipment, charge type).

    Charges without a known type or shipment are left out (``quality`` reports them). Every shipment
    of a line is in the attributes by construction, so only FedEx has to check: its charges go to the
    group id, which is no shipment when the group has no parent. Charges are combined before that
    check, so a hot shipment is small by the time rows are exchanged.

    A carrier whose lines all name the same charges has them combined side by side, one row for each
    (invoice, shipment), and put one below the other afterwards. The least spelling of invoice and
    shipment is then that of all their charges together, else that of each charge.
    """
    known = (
        charge_types.where(F.col("carrier_id") == plan.carrier_id)
        .groupBy(fold(F.col("charge_name")).alias("charge_key"))
        .agg(F.min("charge_type_id").alias("charge_type_id"))
    )
    # names that share a type add up to one charge, which side by side they would not
    if plan.named_charges and on_duplicate == "sum" and duplicate_keys(known, ["charge_type_id"]).isEmpty():
        return lookup_join(_side_by_side(plan, lines), known, ["charge_key"], "inner").select(*CHARGE_KEY, "amount")
    rows = charge_rows(plan, lines).where(not_blank(F.col("tracking_number")))
    typed = lookup_join(rows.withColumn("charge_key", fold(F.col("charge_name"))), known, ["charge_key"], "inner")
    if on_duplicate == "error":
        require_unique(typed.withColumns({c: fold(F.col(c)) for c in TEXT_KEYS}), CHARGE_KEY, "charges")
    # combined before the exchange, and exchanged once, by the keys that are compared
    blind = {f"__k_{c}": fold(F.col(c)) for c in TEXT_KEYS}
    plain = [c for c in CHARGE_KEY if c not in TEXT_KEYS]
    charges = typed.withColumns(blind).groupBy(*plain, *blind).agg(
        F.sum("amount").cast("decimal(18,2)").alias("amount"), *[F.min(c).alias(c) for c in TEXT_KEYS]
    ).select(*CHARGE_KEY, "amount")
    if plan is FEDEX:
        known_shipments = multipiece.shipment_numbers(lines) if attributes is None else attributes
        shipments = known_shipments.select("carrier_id", fold(F.col("tracking_number")).alias("__shipment"))
        charges = (
            charges.withColumn("__shipment", fold(F.col("tracking_number")))
            .join(shipments, ["carrier_id", "__shipment"], "left_semi")
            .drop("__shipment")
        )
    return charges


def _side_by_side(plan: CarrierPlan, lines: DataFrame) -> DataFrame:
    """Charges by (invoice, shipment, folded name) of a carrier whose lines all name the same ones.

    A charge that is zero or missing on every line has no sum and goes; one whose lines cancel each other stays, as zero.
    """
    values = [value.cast("decimal(18,2)") for _, value in plan.charges()]
    named = [f"__c{i}" for i in range(len(values))]
    plain = [c for c in CHARGE_KEY if c not in (*TEXT_KEYS, "charge_type_id")]
    slim = lines.select(
        *plain, "bill_number", plan.attributes.tracking().alias("tracking_number"), *[F.nullif(v, F.lit(0)).alias(n) for v, n in zip(values, named)]
    ).where(not_blank(F.col("tracking_number")) & F.coalesce(*named).isNotNull())
    blind = {f"__k_{c}": fold(F.col(c)) for c in TEXT_KEYS}
    wide = slim.withColumns(blind).groupBy(*plain, *blind).agg(
        *[F.sum(n).alias(n) for n in named], *[F.min(c).alias(c) for c in TEXT_KEYS]
    )
    cells = [cell for name, n in zip(plan.named_charges, named) for cell in (F.lit(name.rstrip().lower()), F.col(n).cast("decimal(18,2)"))]
    tall = wide.select(*plain, *TEXT_KEYS, F.stack(F.lit(len(named)), *cells).alias("charge_key", "amount"))
    return tall.where(F.col("amount").isNotNull())


def new_charges(charges: DataFrame, existing: DataFrame) -> DataFrame:
    return append_new(charges, existing, CHARGE_KEY, text_keys=TEXT_KEYS)


def file_costs(charges: DataFrame) -> DataFrame:
    """What each file bills for each shipment: the part of its cost and of its number of charges."""
    return charges.groupBy("carrier_id", "file_id", fold(F.col("tracking_number")).alias("tracking_number")).agg(
        F.sum("amount").cast("decimal(18,2)").alias("amount"), F.count(F.lit(1)).alias("n_charges")
    )


def shipment_summary(attributes: DataFrame, charges: DataFrame) -> DataFrame:
    """Each shipment with its billed cost, summed over all invoices, and its number of charges.

    ``charges`` are single ones or what :func:`file_costs` has made of them.
    """
    count = F.sum("n_charges") if "n_charges" in charges.columns else F.count(F.lit(1))
    cost = charges.groupBy("carrier_id", fold(F.col("tracking_number")).alias("__shipment")).agg(
        F.sum("amount").cast("decimal(18,2)").alias("__cost"), count.alias("__n")
    )
    keyed = attributes.withColumn("__shipment", fold(F.col("tracking_number")))
    return keyed.join(cost, ["carrier_id", "__shipment"], "left").select(
        *[F.col(c) for c in attributes.columns],
        F.coalesce("__cost", F.lit(0).cast("decimal(18,2)")).alias("billed_shipping_cost"),
        F.coalesce("__n", F.lit(0)).cast("bigint").alias("charge_count"),
    )
