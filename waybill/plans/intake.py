"""File intake: which carrier job a file goes to, whether it may run, and its completion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fold
from ..operators.lookup import lookup_join
from ..sources.contracts import CONTRACTS
from ..sources.files import carrier_key, first_row_account, path_parts


class RejectedFile(ValueError):
    pass


def file_id(file_name: Column, carrier_id: Column) -> Column:
    """The same file of the same carrier always gets the same id, on any machine and in any retry."""
    return F.xxhash64(fold(file_name), carrier_id)


def route_files(arrivals: DataFrame, carriers: DataFrame, tracker: DataFrame) -> DataFrame:
    """One row per arrived file: the job it goes to, `Skip` when it was completed before, or an error.

    ``arrivals`` has (file_path, first_row). Errors are reported per file, so one bad file does not
    stop the others.
    """
    parts = path_parts(F.col("file_path"))
    named = arrivals.select(
        parts.getField("tenant").alias("tenant"),
        carrier_key(parts.getField("carrier")).alias("carrier"),
        parts.getField("account").alias("expected_account"),
        parts.getField("file_name").alias("file_name"),
        "first_row",
    )
    ordinals = {name: c.account_ordinal for name, c in CONTRACTS.items()}
    found = named.withColumn("found_account", first_row_account(F.col("first_row"), F.col("carrier"), ordinals))
    ids = carriers.groupBy(carrier_key(F.col("carrier_name")).alias("carrier")).agg(F.min("carrier_id").alias("carrier_id"))
    identified = lookup_join(found, ids, ["carrier"], "left").withColumn("__name", fold(F.col("file_name")))
    known = tracker.select(
        "carrier_id", fold(F.col("file_name")).alias("__name"), F.lit(True).alias("__known"), "completed_at"
    )
    tracked = identified.join(known, ["carrier_id", "__name"], "left")
    error = (
        F.when(~F.col("carrier").isin(list(CONTRACTS)), "unsupported carrier")
        .when(F.col("carrier_id").isNull(), "carrier not registered")
        .when(
            F.coalesce(fold(F.col("found_account")) != fold(F.col("expected_account")), F.lit(True))
            | (F.col("found_account") == ""),
            "account mismatch",
        )
    )
    return tracked.select(
        "tenant", "carrier", "carrier_id", "file_name", "expected_account", "found_account",
        error.alias("error"),
        F.when(error.isNotNull(), F.lit(None))
        .when(F.col("completed_at").isNotNull(), "Skip")
        .otherwise(F.col("carrier"))
        .alias("route"),
        (error.isNull() & F.col("__known").isNull()).alias("is_new"),
    )


def require_routed(routed: DataFrame) -> DataFrame:
    bad = routed.where(F.col("error").isNotNull()).limit(1).collect()
    if bad:
        row = bad[0]
        raise RejectedFile(
            f"{row['file_name']}: {row['error']} (carrier {row['carrier']}, expected account "
            f"{row['expected_account']}, found {row['found_account']})"
        )
    return routed


def register_files(routed: DataFrame, tracker: DataFrame, run_ts: Column) -> DataFrame:
    """The tracker with a row for every new accepted file."""
    new = routed.where("is_new").select(
        file_id(F.col("file_name"), F.col("carrier_id")).alias("file_id"), "file_name", "carrier_id",
        run_ts.alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("completed_at"),
    )
    return tracker.unionByName(new.dropDuplicates(["file_id"]).select(*tracker.columns))


def complete_files(tracker: DataFrame, done: DataFrame, run_ts: Column) -> DataFrame:
    """The tracker with the completion time of the files in ``done``."""
    marked = lookup_join(
        tracker, done.select("file_id").distinct().withColumn("__done", F.lit(True)), ["file_id"], "left"
    )
    return marked.select(
        *[
            F.when(F.col("__done"), run_ts).otherwise(F.col(c)).alias(c) if c == "completed_at" else F.col(c)
            for c in tracker.columns
        ]
    )


def require_known(tracker: DataFrame, done: DataFrame) -> None:
    """Completing a file that was never registered is an error."""
    unknown = done.select("file_id").join(tracker.select("file_id"), "file_id", "left_anti").limit(1).collect()
    if unknown:
        raise RejectedFile(f"File record not found for file_id={unknown[0]['file_id']}")
