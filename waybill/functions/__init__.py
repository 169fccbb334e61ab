from .text import blank_to_null, decimal_of, fold, not_blank, null_as_zero
from .dates import parse_date, parse_long_date, parse_rfc3339, parse_us_dashed, try_iso_or_us
from .units import to_comparison_unit, to_inches, to_ounces

__all__ = [
    "blank_to_null", "decimal_of", "fold", "not_blank", "null_as_zero",
    "parse_date", "parse_long_date", "parse_rfc3339", "parse_us_dashed", "try_iso_or_us",
    "to_comparison_unit", "to_inches", "to_ounces",
]
