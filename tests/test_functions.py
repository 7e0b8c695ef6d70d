import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.functions import (
    age_band,
    century_timestamp,
    clean_text,
    date_key,
    inflow,
    is_blank,
    map_code,
    money,
    norm_code,
    outflow,
    ratio,
    signed,
    try_int,
    try_rate,
    whole,
    year_month_label,
)


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, code", [(" a ", "A"), ("", "UNKNOWN"), ("   ", "UNKNOWN"), (None, "UNKNOWN"), ("\tb", "\tB")]
)
def test_norm_code(spark, text, code):
    assert one(spark, norm_code("x"), text) == code


def test_clean_text_and_blank(spark):
    assert one(spark, clean_text("x"), "  Praha ") == "Praha"
    assert one(spark, clean_text("x"), " ") == "Unknown"
    assert one(spark, is_blank("x"), None) and one(spark, is_blank("x"), "  ")
    assert not one(spark, is_blank("x"), "a")


def test_map_code_default_and_pass_through(spark):
    names = {"A": "first", "B": "second"}
    assert one(spark, map_code("x", names, "none"), " b") == "second"
    assert one(spark, map_code("x", names, "none"), "c") == "none"
    assert one(spark, map_code("x", names, keep_others=True), "c ") == "C"
    assert one(spark, map_code("x", {}, "none"), "c") == "none"


def test_date_key(spark):
    assert one(spark, date_key("x"), dt.date(1995, 3, 9), "date") == 19950309
    assert one(spark, date_key("x"), None, "date") == 19000101
    assert one(spark, date_key("x", missing=None), None, "date") is None


@pytest.mark.parametrize(
    "year, band",
    [(1999, "Other"), (1998, "1-4 Years"), (1995, "1-4 Years"), (1994, "5-9 Years"),
     (1990, "5-9 Years"), (1989, "Other"), (None, "Unknown")],
)
def test_age_band_counts_new_years(spark, year, band):
    day = dt.date(year, 12, 31) if year else None
    assert one(spark, age_band("x", dt.date(1999, 12, 31)), day, "date") == band


def test_year_month_label(spark):
    assert one(spark, year_month_label(F.lit(1997), F.lit(4))) == "1997-04"


@pytest.mark.parametrize(
    "text, stamp",
    [("931107 00:00:00", dt.datetime(1993, 11, 7)), ("931107 13:05:09", dt.datetime(1993, 11, 7, 13, 5, 9)),
     ("931107", None), ("931107 00:00:00 ", None), ("931307 00:00:00", None), ("junk", None), (None, None)],
)
def test_century_timestamp(spark, text, stamp):
    assert one(spark, century_timestamp("x"), text) == stamp


def test_money_rounds_half_up_and_whole_away_from_zero(spark):
    assert one(spark, money("x"), 1.005, "double") == Decimal("1.01")
    assert one(spark, whole("x"), Decimal("2.50"), "decimal(10,2)") == 3
    assert one(spark, whole("x"), Decimal("-2.50"), "decimal(10,2)") == -3


@pytest.mark.parametrize("text, number", [("12", 12), (" 12 ", 12), ("?", None), ("", None), ("12.5", None)])
def test_try_int(spark, text, number):
    assert one(spark, try_int("x"), text) == number


def test_try_rate(spark):
    assert one(spark, try_rate("x"), " 1.855 ") == Decimal("1.86")
    assert one(spark, try_rate("x"), "1234.5") is None


def test_ratio_is_null_for_zero(spark):
    value = ratio(F.lit(Decimal("10.00")), F.col("x"))
    assert one(spark, value, 3, "bigint") == Decimal("3.33")
    assert one(spark, value, 0, "bigint") is None


def test_ratio_rounds_once(spark):
    # 0.004999999: rounding to six digits first would give 0.005 and then 0.01
    assert one(spark, ratio(F.lit(Decimal("4999999.00")), F.col("x")), 10**9, "bigint") == 0


@pytest.mark.parametrize(
    "kind, measures",
    [(" prijem", (5, 0, 5)), ("VYDAJ", (0, 5, -5)), ("vyber ", (0, 5, -5)), ("x", (0, 0, 0)), (None, (0, 0, 0))],
)
def test_measures_follow_the_direction(spark, kind, measures):
    df = spark.createDataFrame([(kind, Decimal("5.00"))], "t string, a decimal(18,2)")
    row = df.select(inflow("t", "a"), outflow("t", "a"), signed("t", "a")).first()
    assert tuple(row) == measures
    assert row[0] - row[1] == row[2]
