"""Cleaning and typing of text cells. Every helper is a JVM-side column expression."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, functions as F

_unreadable: ContextVar[list[Column] | None] = ContextVar("unreadable", default=None)


@contextmanager
def unreadable_cells() -> Iterator[list[Column]]:
    """While it is open, every strict typing also notes a condition: this cell holds text that cannot be read.

    The conditions never fail, so one pass over the rows of many files tells which of them would.
    """
    found: list[Column] = []
    token = _unreadable.set(found)
    try:
        yield found
    finally:
        _unreadable.reset(token)


def note_unreadable(text: Column, leniently: Column) -> None:
    found = _unreadable.get()
    if found is not None:
        found.append(text.isNotNull() & leniently.isNull())


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def not_blank(c: Column) -> Column:
    return F.trim(c) != ""


def fold(c: Column) -> Column:
    """Key form of a text: equality ignores case and trailing blanks, as in the source's collation."""
    return F.lower(F.rtrim(c))


def decimal_of(
    c: Column,
    precision: int = 18,
    scale: int = 2,
    *,
    commas: bool = False,
    blank: str | None = None,
    lenient: bool = False,
) -> Column:
    """Text to decimal. Blank gives NULL, or ``blank`` where the carrier means zero.

    Strict by default: text that is no number fails the job (ANSI cast), so money is never lost
    silently. ``lenient`` gives NULL instead, for optional measurements.
    """
    text = F.trim(c)
    if commas:
        text = F.replace(text, F.lit(","), F.lit(""))
    text = F.nullif(text, F.lit(""))
    target = f"decimal({precision},{scale})"
    if not lenient:
        note_unreadable(text, text.try_cast(target))
    if blank is not None:
        text = F.coalesce(text, F.lit(blank))
    return text.try_cast(target) if lenient else text.cast(target)


def null_as_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("decimal(18,2)"))
