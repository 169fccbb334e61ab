from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from waybill.functions import (
    blank_to_null, decimal_of, fold, parse_date, parse_long_date, parse_rfc3339, parse_us_dashed, to_comparison_unit,
    to_inches, to_ounces, try_iso_or_us,
)
from waybill.plans.carriers import dhl_domestic_tracking, dhl_tracking, split_dimensions, ups_charge_name


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, expression, kind="string"):
    return [r.out for r in column(spark, values, kind).select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_blank_to_null(spark):
    assert apply(spark, ["a", " a ", "", "   ", None], blank_to_null) == ["a", "a", None, None, None]


def test_money(spark):
    assert apply(spark, ["1,234.50", " 7 ", "", None, "-1,000,000.005"], lambda c: decimal_of(c, commas=True)) == [
        D("1234.50"), D("7.00"), None, None, D("-1000000.01"),
    ]
    assert apply(spark, ["", None, " ", "2.5"], lambda c: decimal_of(c, blank="0")) == [D("0.00"), D("0.00"), D("0.00"), D("2.50")]
    assert apply(spark, ["n/a", "3"], lambda c: decimal_of(c, lenient=True)) == [None, D("3.00")]


def test_bad_money_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(spark, ["12x"], decimal_of)


def test_money_against_python(spark):
    rng = random.Random(7)
    texts = [f"{'-' if rng.random() < .3 else ''}{rng.randrange(10**8):,}.{rng.randrange(100):02d}" for _ in range(2000)]
    assert apply(spark, texts, lambda c: decimal_of(c, commas=True)) == [D(t.replace(",", "")) for t in texts]


def test_dates(spark):
    day = dt.date(2026, 1, 15)
    assert apply(spark, ["20260115", "2026-01-15", " 2026-01-15 10:11:12", "1/15/2026", "", None], parse_date) == [day, day, day, day, None, None]
    assert apply(spark, ["Jan 25, 2026", "Jan 5, 2026", " "], parse_long_date) == [dt.date(2026, 1, 25), dt.date(2026, 1, 5), None]
    assert apply(spark, ["01-22-2026"], parse_us_dashed) == [dt.date(2026, 1, 22)]
    assert apply(spark, ["2025-01-18T10:20:30Z"], parse_rfc3339) == [dt.datetime(2025, 1, 18, 10, 20, 30)]


@pytest.mark.parametrize("text", ["20261345", "2026-13-45", "13/45/2026", "soon"])
def test_bad_date_fails(spark, text):
    with pytest.raises(Exception):
        apply(spark, [text], lambda c: F.coalesce(parse_date(c), F.raise_error(F.lit("no date")).cast("date")))


def test_two_digit_years(spark):
    got = apply(spark, ["1/2/06", "12/31/68", "1/1/69", "1/1/99", "2025-01-18T10:20:30Z", "later", ""], try_iso_or_us)
    assert got == [
        dt.datetime(2006, 1, 2), dt.datetime(2068, 12, 31), dt.datetime(1969, 1, 1), dt.datetime(1999, 1, 1),
        dt.datetime(2025, 1, 18, 10, 20, 30), None, None,
    ]


def test_dates_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Denver")
    try:
        assert apply(spark, ["2025-01-18T00:20:30Z"], lambda c: parse_rfc3339(c).cast("date")) == [dt.date(2025, 1, 18)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


WEIGHTS = [
    ("fedex", "LB", "160.00"), ("fedex", "lbs ", "160.00"), ("fedex", "P", "160.00"), ("fedex", "kg", "352.74"), ("fedex", None, "10.00"), ("fedex", "X", "10.00"),
    ("ups", "L", "160.00"), ("ups", "k", "352.74"), ("ups", "O", "10.00"), ("ups", None, "10.00"),
    ("dhl", "LBS", "160.00"), ("dhl", "KGS", "352.74"), ("dhl", "OZ", "10.00"), ("dhl", "G", "10.00"),
    ("flavorcloud", "LB", "160.00"), ("flavorcloud", "KG", "352.74"), ("flavorcloud", None, "10.00"),
    ("uniuni", "LBS", "160.00"), ("uniuni", "OZS", "10.00"), ("uniuni", "KG", None), ("uniuni", None, None),
]
SIZES = [
    ("fedex", "C", "3.94"), ("fedex", "I", "10.00"), ("fedex", "CM", "10.00"), ("fedex", None, "10.00"),
    ("ups", "CM", "3.94"), ("ups", "MM", "0.39"), ("ups", "IN", "10.00"), ("ups", None, "10.00"),
    ("flavorcloud", "cm", "3.94"), ("flavorcloud", "MM", "0.39"), ("flavorcloud", "IN", "10.00"),
    ("uniuni", "CM", "3.94"), ("uniuni", "IN", "10.00"), ("uniuni", "MM", None), ("uniuni", None, None),
]


@pytest.mark.parametrize("convert,cases", [(to_ounces, WEIGHTS), (to_inches, SIZES)])
def test_units(spark, convert, cases):
    for carrier in {c for c, _, _ in cases}:
        own = [(i, u, w) for i, (c, u, w) in enumerate(cases) if c == carrier]
        frame = spark.createDataFrame([(i, D("10.00"), u) for i, u, _ in own], "i int, v decimal(18,2), u string")
        got = {r.i: r.out for r in frame.select("i", convert(F.col("v"), F.col("u"), carrier).alias("out")).collect()}
        assert got == {i: None if w is None else D(w) for i, _, w in own}, carrier


def test_ups_zero_measures_are_unknown(spark):
    frame = spark.createDataFrame([(D("0.00"), "L")], "v decimal(18,2), u string")
    assert frame.select(to_ounces(F.col("v"), F.col("u"), "ups"), to_inches(F.col("v"), F.col("u"), "ups")).first() == (None, None)


def test_uniuni_golden_conversion(spark):
    frame = spark.createDataFrame([(D("5.5"), D("30"), D("20"), D("15"))], "w decimal(18,4), l decimal(18,4), b decimal(18,4), h decimal(18,4)")
    got = frame.select(
        to_ounces(F.col("w"), F.lit("LBS"), "uniuni"), *[to_inches(F.col(c), F.lit("CM"), "uniuni") for c in "lbh"]
    ).first()
    assert tuple(got) == (D("88.00"), D("11.81"), D("7.87"), D("5.91"))


def test_comparison_units(spark):
    frame = spark.createDataFrame([(D("17.00"), D("15.00"))], "b decimal(18,2), a decimal(18,2)")
    lb = frame.select(*[to_comparison_unit(F.col(c), F.lit("lb")) for c in "ba"]).first()
    assert tuple(lb) == (D("2.0000"), D("1.0000"))
    assert frame.select(to_comparison_unit(F.col("b"), F.lit("kg"))).first()[0] == D("0.4819")
    assert frame.select(to_comparison_unit(F.col("b"), F.lit(None).cast("string"))).first()[0] == D("17.0000")


def test_dimension_text(spark):
    def split(c):
        return F.array(*split_dimensions(c))

    got = apply(spark, ["11.0x  8.0x  3.0", "11X8x0", "12x10", "n/a", "axbxc", None, "1x2x3x4"], split)
    none = [None, None, None]
    assert got == [
        [D("11.00"), D("8.00"), D("3.00")], [D("11.00"), D("8.00"), None], none, none, none, none, [D("1.00"), D("2.00"), None],
    ]


def test_dhl_tracking(spark):
    frame = spark.createDataFrame(
        [("0 2139-1234", " U1 ", "US", "GM1"), ("84101", "U2", "us ", "GM2"), ("84101", "U3", "CA", "GM3"), ("84101", "U4", None, "GM4"), (None, "U5", "US", "GM5")],
        "zip string, uid string, country string, intl string",
    )
    got = [r[0] for r in frame.select(dhl_tracking(F.col("country"), dhl_domestic_tracking(F.col("zip"), F.col("uid")), F.col("intl"))).collect()]
    assert got == ["42002139U1", "42084101U2", "GM3", "GM4", None]


def test_ups_charge_name(spark):
    frame = spark.createDataFrame([("Ground", "SHP"), ("Fuel", "ACC")], "d string, c string")
    assert [r[0] for r in frame.select(ups_charge_name(F.col("d"), F.col("c"))).collect()] == ["Ground", "Fuel - ACC"]


def test_fold(spark):
    assert apply(spark, ["FedEx ", "fedex", " FEDEX"], fold) == ["fedex", "fedex", " fedex"]
