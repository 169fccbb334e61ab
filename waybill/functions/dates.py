"""Date parsing. The format is picked from the shape of the text, then parsed strictly.

Trying one format after another would raise and swallow an exception per miss and row; a cheap shape
test keeps the cost flat and lets a text of no known shape fail the file.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import blank_to_null, note_unreadable

_US_SLASHED_SHORT = r"^\d{1,2}/\d{1,2}/\d{2}$"
_FIRST_1900S_YEAR = 69  # fixed value: two-digit years from here on are 19xx, below it 20xx
_ISO_LIKE = r"^\d{4}-\d{1,2}-\d{1,2}"


def parse_date(c: Column) -> Column:
    """`20260115`, `2026-01-15` (with or without a time of day) or `1/15/2026`; blank gives NULL."""
    text = blank_to_null(c)
    slashed, dashed, short = F.contains(text, F.lit("/")), F.contains(text, F.lit("-")), F.length(text) == 8
    note_unreadable(
        text,
        F.when(slashed, F.try_to_date(text, "M/d/yyyy"))
        .when(dashed, text.try_cast("date"))
        .when(short, F.try_to_date(text, "yyyyMMdd"))
        .otherwise(text.try_cast("date")),
    )
    return (
        F.when(slashed, F.to_date(text, "M/d/yyyy"))
        .when(dashed, text.cast("date"))
        .when(short, F.to_date(text, "yyyyMMdd"))
        .otherwise(text.cast("date"))
    )


def _formatted(c: Column, pattern: str) -> Column:
    text = blank_to_null(c)
    note_unreadable(text, F.try_to_date(text, pattern))
    return F.to_date(text, pattern)


def parse_long_date(c: Column) -> Column:
    """`Jan 25, 2026`."""
    return _formatted(c, "MMM d, yyyy")


def parse_us_dashed(c: Column) -> Column:
    """`01-22-2026`."""
    return _formatted(c, "MM-dd-yyyy")


def parse_rfc3339(c: Column) -> Column:
    """`2025-01-18T10:20:30Z` as a timestamp without zone, whatever the session zone is."""
    text = blank_to_null(c)
    note_unreadable(text, text.try_cast("timestamp_ntz"))
    return text.cast("timestamp_ntz")


def try_iso_or_us(c: Column) -> Column:
    """RFC3339 or `M/D/YY`, else NULL: the caller reports a non-blank text that gave NULL."""
    text = blank_to_null(c)
    year = F.right(text, F.lit(2))
    century = F.when(year >= str(_FIRST_1900S_YEAR), "19").otherwise("20")
    four_digits = F.concat(F.regexp_replace(text, r"\d{2}$", ""), century, year)
    return F.when(text.rlike(_ISO_LIKE), text.try_cast("timestamp_ntz")).when(
        text.rlike(_US_SLASHED_SHORT), F.try_to_timestamp(four_digits, F.lit("M/d/yyyy")).cast("timestamp_ntz")
    )
