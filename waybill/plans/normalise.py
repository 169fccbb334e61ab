"""Staged text to invoices and typed lines."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fold, parse_rfc3339
from ..functions.text import unreadable_cells
from ..operators.lookup import lookup_join
from ..operators.merge import require_unique
from .carriers import CarrierPlan

BILL_KEY = ["file_id", "bill_number", "bill_date"]


class Normalised(NamedTuple):
    bills: DataFrame
    lines: DataFrame


def skip_loaded_files(staged: DataFrame, loaded: DataFrame) -> DataFrame:
    """Drop the rows of files that are loaded already: the same file is the same data."""
    return lookup_join(staged, loaded.select("file_id").distinct(), ["file_id"], "left_anti")


def invoice_rollup(plan: CarrierPlan, staged: DataFrame) -> DataFrame:
    """One row per invoice and file.

    Lines are combined to their invoice before the one exchange. Where shipments are counted by their
    numbers, a first aggregate leaves a row for each of them and account; it keeps only fixed-width
    buffers (sum, count), so it is a hash aggregate. The second one runs over what is left.
    """
    invoice = plan.invoice
    rows = staged.where(plan.required())
    keys = ["file_id"] if invoice.per_file else BILL_KEY
    own = [] if invoice.per_file else [invoice.number().alias("bill_number"), invoice.date().alias("bill_date")]
    extra = []
    if invoice.per_file:
        extra.append(parse_rfc3339(F.col("time_utc")).cast("date").alias("last_day"))
    if invoice.count_distinct is not None:
        extra.append(invoice.count_distinct().alias("shipment"))
    typed = rows.select(
        "file_id", *own, invoice.account().alias("account_number"), invoice.amount().alias("amount"), *extra
    )
    if invoice.count_distinct is not None:
        partial = typed.groupBy(*keys, "account_number", "shipment").agg(
            F.sum("amount").alias("amount"), *([F.max("last_day").alias("last_day")] if invoice.per_file else [])
        )
    else:
        partial = typed
    shipments = F.count_distinct("shipment") if invoice.count_distinct is not None else F.count(F.lit(1))
    grain = [*keys, "account_number"] if invoice.by_account else keys
    # one invoice however its number is spelled
    spelled = "bill_number" in grain
    if spelled:
        partial = partial.withColumn("__bill", fold(F.col("bill_number")))
        grain = ["__bill" if c == "bill_number" else c for c in grain]
    bills = partial.groupBy(*grain).agg(
        *([F.min("bill_number").alias("bill_number")] if spelled else []),
        F.sum("amount").cast("decimal(18,2)").alias("total_amount"),
        shipments.cast("int").alias("num_shipments"),
        *([] if invoice.by_account else [F.max("account_number").alias("account_number")]),
        *([F.max("last_day").alias("last_day")] if invoice.per_file else []),
    )
    if invoice.per_file:
        bills = bills.withColumns({"bill_number": invoice.number(), "bill_date": invoice.date()})
    return bills.select(
        F.lit(plan.carrier_id).alias("carrier_id"), *BILL_KEY, "account_number", "total_amount", "num_shipments"
    )


def typed_lines(
    plan: CarrierPlan, staged: DataFrame, bills: DataFrame | None = None, *, bills_are_stored: bool = False
) -> DataFrame:
    """Typed lines with their invoice's key.

    The key is computed from the line itself. Only a carrier whose invoice is made from the whole
    file looks it up, by file, in its invoices.
    """
    invoice = plan.invoice
    rows = staged.where(plan.required() & plan.line_required())
    if invoice.per_file:
        if bills is None:
            bills = invoice_rollup(plan, staged)
        by_file = bills.select("file_id", F.col("bill_date").alias("last_day"))
        rows = lookup_join(rows, by_file, ["file_id"], "inner", derived=not bills_are_stored)
    return rows.select(
        F.lit(plan.carrier_id).alias("carrier_id"),
        "file_id",
        invoice.number().alias("bill_number"),
        invoice.date().alias("bill_date"),
        *[c.alias(n) for n, c in plan.line().items()],
        *(["arrival"] if "arrival" in staged.columns else []),
    )


def normalise(plan: CarrierPlan, staged: DataFrame, loaded: DataFrame | None = None) -> Normalised:
    if loaded is not None:
        staged = skip_loaded_files(staged, loaded)
    bills = invoice_rollup(plan, staged)
    return Normalised(bills, typed_lines(plan, staged, bills))


class IncompleteLines(ValueError):
    """Lines lack a value that the model requires; their file is refused."""


def incomplete_files(plan: CarrierPlan, lines: DataFrame) -> DataFrame:
    """Files with lines that lack a required value: number of such lines and the columns concerned."""
    required = ("bill_number", "bill_date", *plan.not_null)
    lacking = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return (
        lines.select("file_id", lacking.alias("lacking"))
        .where(F.size("lacking") > 0)
        .groupBy("file_id")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("lacking")))), ",").alias("missing"))
    )


def unreadable_files(plan: CarrierPlan, staged: DataFrame) -> DataFrame:
    """Files with numbers or dates that cannot be read: the number of such lines, in one pass over all files.

    What it finds is what strict typing would fail on, cell by cell.
    """
    invoice = plan.invoice
    with unreadable_cells() as of_bills:
        invoice.amount()
        if not invoice.per_file:
            invoice.number(), invoice.date()
        else:
            parse_rfc3339(F.col("time_utc"))
    with unreadable_cells() as of_lines:
        plan.line()
    no = F.lit(False)
    any_of = lambda cells: F.coalesce(reduce(lambda a, b: a | b, cells, no), no)
    required = F.coalesce(plan.required(), no)
    bad = required & (any_of(of_bills) | (F.coalesce(plan.line_required(), no) & any_of(of_lines)))
    return staged.where(bad).groupBy("file_id").agg(F.count(F.lit(1)).alias("n_lines"))


def require_complete(plan: CarrierPlan, lines: DataFrame) -> DataFrame:
    bad = incomplete_files(plan, lines).limit(1).collect()
    if bad:
        row = bad[0]
        raise IncompleteLines(f"{plan.key}: file {row['file_id']} has {row['n_lines']} lines without {row['missing']}")
    return lines


def check_bills(bills: DataFrame) -> DataFrame:
    """Before a write: one invoice per number, day, carrier and file (two accounts on one invoice fail)."""
    return require_unique(bills.withColumn("bill_number", fold(F.col("bill_number"))), ["carrier_id", *BILL_KEY], "invoices")


def lines_with_invoice(lines: DataFrame, bills: DataFrame, columns: list[str]) -> DataFrame:
    """Lines next to columns of their invoice."""
    key: list[str] = ["carrier_id", *BILL_KEY]
    picked: list[Column] = [F.col(c) for c in columns]
    blind = fold(F.col("bill_number"))
    own = bills.select(*[blind.alias("__bill") if c == "bill_number" else F.col(c) for c in key], *picked)
    keys = ["__bill" if c == "bill_number" else c for c in key]
    return lookup_join(lines.withColumn("__bill", blind), own, keys, "inner", derived=True).drop("__bill")
