"""Reconciliation and data-quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fold, not_blank
from ..operators.lookup import lookup_join
from ..session import written
from .carriers import CarrierPlan, Invoice
from .normalise import BILL_KEY
from .unify import SHIPMENT_KEY, charge_rows

TOLERANCE = "0.01"  # fixed value: allowed difference of money totals


def _within(a: Column, b: Column) -> Column:
    return F.abs(a - b) < F.expr(f"{TOLERANCE}BD")


def _money(c: Column | str) -> Column:
    return F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit(0)).cast("decimal(18,2)")


def totals_by_file(plan: CarrierPlan, staged: DataFrame, bills: DataFrame, charges: DataFrame) -> DataFrame:
    """Per file: money in the file, on the invoices and in the charges, and whether they agree."""
    invoice: Invoice = plan.invoice
    in_file = (
        staged.where(plan.required()).select("file_id", invoice.amount().alias("v")).groupBy("file_id")
        .agg(F.sum("v").alias("file_total"))
    )
    on_bills = bills.groupBy("file_id").agg(F.sum("total_amount").alias("bill_total"))
    in_charges = charges.groupBy("file_id").agg(F.sum("amount").alias("charge_total"))
    joined = in_file.join(on_bills, "file_id", "left").join(in_charges, "file_id", "left")
    f, b, c = (_money(n) for n in ("file_total", "bill_total", "charge_total"))
    return joined.select(
        "file_id",
        f.alias("file_total"),
        b.alias("bill_total"),
        c.alias("charge_total"),
        _within(f, b).alias("file_equals_bills"),
        _within(b, c).alias("bills_equal_charges"),
        _within(f, c).alias("all_equal"),
    )


def charge_breakdown(charges: DataFrame, charge_types: DataFrame) -> DataFrame:
    """Count, total, mean and extremes per charge type, largest total first."""
    stats = charges.groupBy("charge_type_id").agg(
        F.count(F.lit(1)).alias("charge_count"),
        F.sum("amount").cast("decimal(18,2)").alias("total_amount"),
        (F.sum("amount") / F.count(F.lit(1))).cast("decimal(18,2)").alias("avg_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )
    named = charge_types.select("charge_type_id", "charge_name", "freight", "charge_category_id")
    return stats.join(named, "charge_type_id").orderBy(F.desc("total_amount"))


def charge_usage(charges: DataFrame, charge_types: DataFrame) -> DataFrame:
    """Every charge type with its number of uses, also those never used."""
    used = charges.groupBy("charge_type_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("v")
    )
    return (
        charge_types.join(used, "charge_type_id", "left")
        .select(
            "charge_type_id", "charge_name", "freight", F.coalesce("n", F.lit(0)).cast("bigint").alias("usage_count"),
            _money("v").alias("total_amount"),
        )
        .orderBy(F.desc("freight"), "charge_name")
    )


def seeding_check(charge_types: DataFrame, expected: DataFrame) -> DataFrame:
    """Per carrier: distinct charge types present against the number expected."""
    present = charge_types.groupBy("carrier_id").agg(F.count_distinct(fold(F.col("charge_name"))).alias("actual"))
    actual = F.coalesce("actual", F.lit(0)).cast("bigint")
    return expected.join(present, "carrier_id", "left").select(
        "carrier_id", F.col("expected").cast("bigint").alias("expected"), actual.alias("actual"),
        (actual == F.col("expected")).alias("complete"),
    )


def shipment_counts(plan: CarrierPlan, lines: DataFrame, attributes: DataFrame) -> DataFrame:
    """Distinct shipments on the lines against rows in the attributes."""
    on_lines = lines.select(plan.attributes.tracking().alias("t")).agg(
        F.count_distinct(F.nullif(fold(F.col("t")), F.lit(""))).alias("line_shipments"),
        F.count_if(~F.coalesce(not_blank(F.col("t")), F.lit(False))).alias("lines_without_tracking"),
    )
    unified = attributes.agg(F.count(F.lit(1)).alias("attribute_rows"))
    difference = F.col("line_shipments") - F.col("attribute_rows")
    return on_lines.crossJoin(F.broadcast(unified)).select(
        "line_shipments", "attribute_rows", difference.alias("difference"), "lines_without_tracking",
        (difference == 0).alias("complete"),
    )


def charge_share(charges: DataFrame) -> DataFrame:
    """Each charge beside the total of its shipment.

    The total comes from an aggregate joined back, not from a window, so that a shipment with very
    many charges is not brought into one task.
    """
    totals = charges.groupBy(*SHIPMENT_KEY).agg(F.sum("amount").cast("decimal(18,2)").alias("shipment_total"))
    return charges.join(totals, SHIPMENT_KEY)


def largest_charge(charges: DataFrame, charge_types: DataFrame) -> DataFrame:
    """One sample row: the largest charge with its shipment's total.

    The order needs no totals, so the total is made for the shipment that comes first and not for all.
    """
    charges = written(charges, "charges")
    names = charge_types.select("charge_type_id", "charge_name")

    def first(rows: DataFrame) -> DataFrame:
        named = lookup_join(rows, names, ["charge_type_id"], "inner")
        return named.orderBy(F.desc("amount"), "tracking_number", "charge_name").limit(1)

    shipment = first(charges.dropna(subset=SHIPMENT_KEY)).select(*SHIPMENT_KEY)
    return first(charge_share(charges.join(F.broadcast(shipment), SHIPMENT_KEY, "left_semi")))


def unmapped_charges(plan: CarrierPlan, lines: DataFrame, charge_types: DataFrame) -> DataFrame:
    """Charges whose name is no known charge type: the money that unification leaves out."""
    known = charge_types.where(F.col("carrier_id") == plan.carrier_id).select(
        fold(F.col("charge_name")).alias("charge_key")
    ).distinct()
    rows = charge_rows(plan, lines).withColumn("charge_key", fold(F.col("charge_name")))
    return lookup_join(rows, known, ["charge_key"], "left_anti").groupBy("charge_name").agg(
        F.count(F.lit(1)).alias("n_charges"), F.sum("amount").cast("decimal(18,2)").alias("amount")
    )


def invoice_level_charges(plan: CarrierPlan, lines: DataFrame) -> DataFrame:
    """Charges without a tracking number, kept per invoice so that no money is lost."""
    rows = charge_rows(plan, lines)
    loose = rows.where(~F.coalesce(not_blank(F.col("tracking_number")), F.lit(False)))
    return loose.groupBy("carrier_id", *BILL_KEY, "charge_name").agg(
        F.count(F.lit(1)).alias("n_charges"), F.sum("amount").cast("decimal(18,2)").alias("amount")
    )


def orphan_charges(charges: DataFrame, attributes: DataFrame, bills: DataFrame) -> DataFrame:
    """Number and money of charges without a shipment or without an invoice."""
    shipments = attributes.select("carrier_id", fold(F.col("tracking_number")).alias("__t"), F.lit(True).alias("__a"))
    invoices = bills.select("carrier_id", *BILL_KEY, F.lit(True).alias("__b")).distinct()
    # pre-aggregated to shipment and invoice: all charges of one pair share their fate
    grouped = charges.groupBy("carrier_id", *BILL_KEY, fold(F.col("tracking_number")).alias("__t")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("v")
    )
    checked = grouped.join(shipments, ["carrier_id", "__t"], "left").join(invoices, ["carrier_id", *BILL_KEY], "left")

    def lost(name: str, flag: str) -> list[Column]:
        missing = F.col(flag).isNull()
        return [
            F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).cast("bigint").alias(f"{name}_charges"),
            F.coalesce(F.sum(F.when(missing, F.col("v"))), F.lit(0)).cast("decimal(18,2)").alias(f"{name}_amount"),
        ]

    return checked.groupBy("carrier_id").agg(*lost("without_shipment", "__a"), *lost("without_invoice", "__b"))


def component_mismatches(lines: DataFrame, parts: list[str], total: str, keep: list[str]) -> DataFrame:
    """Lines whose components do not add up to their total."""
    added = None
    for p in parts:
        added = _money(p) if added is None else added + _money(p)
    return lines.where(~F.coalesce(_within(added, F.col(total)), F.lit(False))).select(
        *keep, added.cast("decimal(18,2)").alias("component_sum"), F.col(total).alias("stated_total")
    )


def freshness(rows: DataFrame, changed_at: str, now: Column, hours: int = 24, by: list[str] | None = None) -> DataFrame:
    """The latest change and whether it lies within the last hours before ``now``."""
    newest = rows.groupBy(*(by or [])).agg(F.max(changed_at).alias("last_change"))
    return newest.withColumn("is_fresh", F.col("last_change") >= now - F.expr(f"INTERVAL {hours} HOURS"))


def blank_required(rows: DataFrame, required: list[str], keep: list[str]) -> DataFrame:
    """Rows with a blank required cell and the names of the cells: their file is rejected."""
    missing = F.array_compact(
        F.array(*[F.when(~F.coalesce(not_blank(F.col(c)), F.lit(False)), F.lit(c)) for c in required])
    )
    return rows.select(*keep, F.array_join(missing, ",").alias("missing")).where("missing != ''")


def header_drift(files: DataFrame, header: str, expected: list[str], keep: list[str]) -> DataFrame:
    """Header lines of files against the expected columns. Equal hashes mean an equal header; only
    the others are compared name by name."""
    names = F.transform(F.split(F.col(header), ","), F.trim)
    wanted = F.array(*[F.lit(n) for n in expected])
    return files.select(
        *keep,
        (F.xxhash64(F.array_join(names, ",")) != F.xxhash64(F.array_join(wanted, ","))).alias("drifted"),
        F.array_join(F.array_sort(F.array_except(wanted, names)), ",").alias("missing"),
        F.array_join(F.array_sort(F.array_except(names, wanted)), ",").alias("unexpected"),
    ).where("drifted")
