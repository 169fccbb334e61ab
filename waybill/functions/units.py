"""Unit conversion, one profile per carrier. The factors and fallbacks differ between carriers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class UnitProfile:
    """``factors`` maps a unit to (operator, factor); a unit not listed passes through or gives NULL."""

    factors: dict[str, tuple[str, str]]
    unknown_is_null: bool = False
    zero_is_null: bool = False


_SAME = ("*", "1")

# Conversion factors and unit names by carrier.
WEIGHT_PROFILES = {
    "fedex": UnitProfile({
        "L": ("*", "16"), "LB": ("*", "16"), "LBS": ("*", "16"), "P": ("*", "16"),
        "K": ("*", "35.27396195"), "KG": ("*", "35.27396195"), "KGS": ("*", "35.27396195"),
    }),
    "ups": UnitProfile({"L": ("*", "16"), "K": ("*", "35.274"), "O": _SAME}, zero_is_null=True),
    "dhl": UnitProfile({
        "LB": ("*", "16"), "LBS": ("*", "16"),
        "KG": ("*", "35.274"), "KGS": ("*", "35.274"),
        "OZ": _SAME,
    }),
    "flavorcloud": UnitProfile({"LB": ("*", "16"), "KG": ("*", "35.274")}),
    "uniuni": UnitProfile({"LBS": ("*", "16"), "OZS": _SAME}, unknown_is_null=True),
}
DIMENSION_PROFILES = {
    "fedex": UnitProfile({"C": ("/", "2.54"), "I": _SAME}),
    "ups": UnitProfile({"CM": ("/", "2.54"), "MM": ("/", "25.4"), "IN": _SAME, "I": _SAME}, zero_is_null=True),
    "flavorcloud": UnitProfile({"CM": ("/", "2.54"), "MM": ("/", "25.4")}),
    "uniuni": UnitProfile({"CM": ("*", "0.393701"), "IN": _SAME}, unknown_is_null=True),
}


def _convert(value: Column, unit: Column, profile: UnitProfile) -> Column:
    if profile.zero_is_null:
        value = F.nullif(value, F.lit(0))
    by_factor: dict[tuple[str, str], list[str]] = {}
    for name, factor in profile.factors.items():
        by_factor.setdefault(factor, []).append(name)
    unit = F.upper(F.trim(unit))
    result = None
    for (op, factor), names in by_factor.items():
        number = F.expr(f"{factor}BD")
        converted = value if factor == "1" else (value * number if op == "*" else value / number)
        hit = unit.isin(names)
        converted = converted.cast("decimal(18,2)")
        result = F.when(hit, converted) if result is None else result.when(hit, converted)
    if not profile.unknown_is_null:
        result = result.otherwise(value.cast("decimal(18,2)"))
    return result


def to_ounces(value: Column, unit: Column, carrier: str) -> Column:
    return _convert(value, unit, WEIGHT_PROFILES[carrier])


def to_inches(value: Column, unit: Column, carrier: str) -> Column:
    return _convert(value, unit, DIMENSION_PROFILES[carrier])


def to_comparison_unit(ounces: Column, unit: Column) -> Column:
    """Weight in the unit a threshold compares in: pounds round up, kilograms keep four decimals."""
    wide = "decimal(18,4)"
    return (
        F.when(unit == "lb", F.ceil(ounces / F.expr("16BD")).cast(wide))
        .when(unit == "kg", (ounces / F.expr("35.274BD")).cast("decimal(10,4)").cast(wide))
        .otherwise(ounces.cast(wide))
    )
