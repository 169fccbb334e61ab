"""FedEx multi-piece shipments: a header row, a parent and children share one ground id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import blank_to_null, fold
from ..operators.groups import HOT_ROWS, attach_group_values

GROUP = ["file_id", "express_or_ground_tracking_id"]
# differ between the packages of a group; few, so that unused columns of the wide line stay unread
SPREAD_BY = ["msp_tracking_id", "bill_number", "net_charge_amount", "rated_weight_amount", "dim_length", "dim_width"]
HOISTED = ("net_charge_amount", "shipment_date", "service_type", "zone_code")


def role(size: Column, package_id: Column, group_id: Column) -> Column:
    package_id = blank_to_null(package_id)
    return (
        F.when(size == 1, "NORMAL_SINGLE")
        .when(package_id.isNull(), "MPS_HEADER")
        .when(fold(package_id) == fold(group_id), "MPS_PARENT")
        .when(fold(package_id) != fold(group_id), "MPS_CHILD")
        .otherwise("UNKNOWN")
    )


def group_values(lines: DataFrame) -> DataFrame:
    """Groups of several rows: their size and the values of their header, the row without package id.

    Sizes count all rows over the two key columns; the header's texts, whose maximum needs sorting,
    are taken from header rows only.
    """
    sizes = lines.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("group_rows")).where("group_rows > 1")
    headers = (
        lines.where(blank_to_null(F.col("msp_tracking_id")).isNull())
        .groupBy(*GROUP)
        .agg(*[F.max(n).alias(f"header_{n}") for n in HOISTED])
    )
    return sizes.join(headers, GROUP, "left")


def with_roles(lines: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Lines with group size, role and the header's values carried to the whole group.

    A row that is alone in its group keeps its own values.
    """
    grouped = lines.where(F.col(GROUP[1]).isNotNull())
    joined = attach_group_values(grouped, GROUP, group_values(grouped), "group_rows", SPREAD_BY, hot_rows=hot_rows)
    single = F.col("group_rows").isNull()
    size = F.coalesce("group_rows", F.lit(1).cast("bigint"))
    return joined.select(
        *lines.columns,
        size.alias("group_rows"),
        role(size, F.col("msp_tracking_id"), F.col(GROUP[1])).alias("mps_role"),
        *[F.when(single, F.col(n)).otherwise(F.col(f"header_{n}")).alias(f"group_{n}") for n in HOISTED],
    )


def shipment_numbers(lines: DataFrame) -> DataFrame:
    """The tracking numbers of all packages: every package id, and the ground id of a group that is
    one row without package id. Reads three columns and needs no group values."""
    package_id, group_id = blank_to_null(F.col("msp_tracking_id")), F.col(GROUP[1])
    named = lines.where(package_id.isNotNull()).select("carrier_id", package_id.alias("tracking_number"))
    single = (
        lines.where(group_id.isNotNull())
        .groupBy("carrier_id", *GROUP)
        .agg(F.count(F.lit(1)).alias("n"), F.count(package_id).alias("with_id"))
        .where("n = 1 AND with_id = 0")
        .select("carrier_id", group_id.alias("tracking_number"))
    )
    return named.unionByName(single).distinct()


def packages(lines: DataFrame) -> DataFrame:
    """The rows that are packages: all but the headers."""
    return with_roles(lines).where("mps_role != 'MPS_HEADER'")
