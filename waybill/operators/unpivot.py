"""Wide charge columns to one row per charge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import not_blank


def unpivot_charges(
    lines: DataFrame,
    pairs: list[tuple[Column, Column]],
    keep: list[str],
    *,
    name: str = "charge_name",
    amount: str = "amount",
) -> DataFrame:
    """(name, amount) pairs to rows. Zero, NULL and unnamed charges go; negative ones stay.

    ``stack`` is code-generated and evaluated row by row: nothing is shuffled and unused columns of
    the wide line are pruned at the scan.
    """
    cells = [cell for label, value in pairs for cell in (label.cast("string"), value.cast("decimal(18,2)"))]
    tall = lines.select(*keep, F.stack(F.lit(len(pairs)), *cells).alias(name, amount))
    return tall.where(not_blank(F.col(name)) & (F.col(amount) != 0))


def fixed(*names_and_columns: tuple[str, str]) -> list[tuple[Column, Column]]:
    return [(F.lit(label), F.col(column)) for label, column in names_and_columns]


def described(*name_and_amount_columns: tuple[str, str]) -> list[tuple[Column, Column]]:
    return [(F.col(label), F.col(column)) for label, column in name_and_amount_columns]
