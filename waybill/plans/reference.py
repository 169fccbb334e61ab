"""Discovery of carriers, shipping methods and charge types in billing lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fold, not_blank
from ..operators.lookup import lookup_join
from ..operators.merge import append_new
from ..operators.unpivot import described, unpivot_charges
from .carriers import ADJUSTMENT, FEDEX, PASSPORT, PASSPORT_FEE_PAIRS, STANDARD, UPS, CarrierPlan, ups_charge_name

METHOD_KEY = ["carrier_id", "method_name", "integrated_carrier_id"]


def _distinct_folded(rows: DataFrame, text: str, other_keys: list[str]) -> DataFrame:
    """Distinct names; of spellings that differ in case or trailing blanks the smallest is kept.

    Exact duplicates go first (hash aggregate, combined map-side), so the text minimum sees few rows.
    """
    return (
        rows.select(text, *other_keys)
        .distinct()
        .groupBy(fold(F.col(text)).alias("__key"), *other_keys)
        .agg(F.min(F.rtrim(text)).alias(text))
        .drop("__key")
    )


def discover_carriers(lines: DataFrame, carriers: DataFrame) -> DataFrame:
    """Carriers named on aggregator lines that the carrier table lacks."""
    named = lines.where(not_blank(F.col("integrated_carrier"))).select(F.col("integrated_carrier").alias("carrier_name"))
    found = append_new(
        _distinct_folded(named, "carrier_name", []), carriers, ["carrier_name"], text_keys=("carrier_name",)
    )
    return found.select("carrier_name", F.lit(True).alias("is_active"), F.lit(False).alias("is_aggregator"))


def carrier_ids(carriers: DataFrame) -> DataFrame:
    """Carrier id by folded name, one row per name."""
    return carriers.groupBy(fold(F.col("carrier_name")).alias("carrier_key")).agg(
        F.min("carrier_id").cast("int").alias("integrated_carrier_id")
    )


def discover_methods(
    plan: CarrierPlan, lines: DataFrame, methods: DataFrame, carriers: DataFrame | None = None
) -> DataFrame:
    """Shipping methods on the lines that the method table lacks, with default settings.

    The comparison is null-safe on the integrated carrier, so a method without a known one is added
    once, not on each run.
    """
    # FedEx lines name their own service; the group's one only serves the attributes
    method: Column = F.col("service_type") if plan is FEDEX else plan.attributes.method()
    named = lines.select(
        method.alias("method_name"),
        *([F.col("integrated_carrier")] if plan.integrated else [F.lit(None).cast("string").alias("integrated_carrier")]),
    ).where(not_blank(F.col("method_name")))
    distinct = named.distinct()
    if plan.integrated:
        keyed = distinct.withColumn("carrier_key", fold(F.col("integrated_carrier")))
        distinct = lookup_join(keyed, carrier_ids(carriers), ["carrier_key"], "left")
    else:
        distinct = distinct.withColumn("integrated_carrier_id", F.lit(None).cast("int"))
    unique = _distinct_folded(distinct, "method_name", ["integrated_carrier_id"]).withColumn(
        "carrier_id", F.lit(plan.carrier_id)
    )
    new = append_new(unique, methods, METHOD_KEY, text_keys=("method_name",))
    return new.select(
        "carrier_id",
        "method_name",
        F.lit("Standard").alias("service_level"),
        F.lit(None).cast("decimal(18,4)").alias("average_transit_days"),
        F.lit(False).alias("guaranteed_delivery"),
        F.lit(True).alias("is_active"),
        "integrated_carrier_id",
    )


def seed_charge_types(plan: CarrierPlan, lines: DataFrame) -> DataFrame:
    spark = lines.sparkSession
    return spark.createDataFrame(plan.seeds, "charge_name string, freight boolean, charge_category_id int")


def _named_charges(plan: CarrierPlan, lines: DataFrame) -> DataFrame:
    """Charge names on the lines with their freight flag and category."""
    name = F.col("charge_name")
    if plan is FEDEX:
        category = F.when(F.lower(name).contains("adjustment"), ADJUSTMENT).otherwise(STANDARD)
        return unpivot_charges(lines, plan.charges(), []).select(
            F.trim(name).alias("charge_name"), F.lit(False).alias("freight"), category.alias("charge_category_id")
        )
    if plan is UPS:
        code = F.col("charge_category_code")
        return lines.where(F.col("charge_description").isNotNull()).select(
            ups_charge_name(F.col("charge_description"), code).alias("charge_name"),
            F.coalesce(code == "SHP", F.lit(False)).alias("freight"),
            F.when(code == "ADJ", ADJUSTMENT).otherwise(STANDARD).alias("charge_category_id"),
        )
    if plan is PASSPORT:
        fees = unpivot_charges(lines, described(*PASSPORT_FEE_PAIRS), []).select(
            name, F.lit(False).alias("freight"), F.lit(STANDARD).alias("charge_category_id")
        )
        return fees.unionByName(seed_charge_types(plan, lines))
    return seed_charge_types(plan, lines)


def discover_charge_types(plan: CarrierPlan, lines: DataFrame, charge_types: DataFrame) -> DataFrame:
    """Charge types on the lines (or seeded for the carrier) that the charge type table lacks."""
    named = _named_charges(plan, lines).where(not_blank(F.col("charge_name")))
    flags = ["freight", "charge_category_id"]
    unique = (
        named.distinct()
        .groupBy(fold(F.col("charge_name")).alias("__key"))
        .agg(F.min(F.struct("charge_name", *flags)).alias("__row"))
        .select(F.lit(plan.carrier_id).alias("carrier_id"), "__row.*")
    )
    new = append_new(unique, charge_types, ["carrier_id", "charge_name"], text_keys=("charge_name",))
    return new.select(
        "carrier_id", "charge_name", "freight", F.lit(False).alias("dt"), F.lit(False).alias("markup"),
        "charge_category_id",
    )
