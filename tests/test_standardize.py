"""C1-C11 and the traps T5-T10."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordlake.functions import (
    clean_text, clean_upper_text, coerce_double, coerce_long, coerce_timestamp, null_tokens, standardize_pay_unit,
    standardize_status, standardize_visa_class, standardize_yes_no, ustrip,
)


def col1(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_status_maps(spark):
    vals = [" certified ", "CERTIFIED-EXPIRED", "Certified - Withdrawn", "Denied", "PENDING", "", None, "nan"]
    assert col1(spark, vals, standardize_status) == [
        "Certified", "Certified - Expired", "Certified - Withdrawn", "Denied", "PENDING", None, None, None]
    assert col1(spark, ["Certified - Withdrawn"], lambda c: standardize_status(c, "perm")) == ["CERTIFIED - WITHDRAWN"]


def test_visa_unit_yes_no(spark):
    assert col1(spark, ["R", "A", "S", "C", "H-1B", "nan", None, " r "], standardize_visa_class) == [
        "H-1B", "E-3 Australian", "H-1B1 Singapore", "H-1B1 Chile", "H-1B", None, None, "r"]
    assert col1(spark, ["yr", "HOUR", "bi", "Year", "Yr", None], standardize_pay_unit) == [
        "Year", "Hour", "Bi-Weekly", "Year", "Yr", None]
    assert col1(spark, ["Y", "no", "NO", "1", "0.0", "N/A", None], standardize_yes_no) == [
        "Yes", "no", "No", "Yes", "No", "N/A", None]


def test_t9_single_pass(spark):
    # "1" -> "Yes" must not be mapped again by a later rule
    assert col1(spark, ["1"], standardize_yes_no) == ["Yes"]


def test_t8_unicode_strip(spark):
    assert col1(spark, [" x\t", " y　", " z "], ustrip) == ["x", "y", "z"]


def test_text_cleanup(spark):
    assert col1(spark, ["\tA ", "nan", "NAN", "NULL", "NONE", ""], clean_text) == ["A", None, None, "NULL", "NONE", None]
    assert col1(spark, [" h-1b ", "nan", ""], clean_upper_text) == ["H-1B", None, None]


def test_t10_reader_tokens(spark):
    vals = ["NA", "NULL", "null", "N/A", "#N/A", "<NA>", "NaN", "-nan", "NAN", "NONE", "na", "-", " "]
    assert col1(spark, vals, null_tokens) == [None] * 8 + ["NAN", "NONE", "na", "-", " "]


def test_t6_numbers(spark):
    vals = ["50000", " 12.5 ", "1,000", "$5", "20000 - 30000", "1e5", "12d", "1_000", "1e400", "inf", ".5", "0x10", None]
    assert col1(spark, vals, coerce_double) == [
        50000.0, 12.5, None, None, None, 100000.0, None, None, None, float("inf"), 0.5, None, None]


def test_t7_fractions(spark):
    assert col1(spark, ["1", "0", "1.0", None], coerce_long) == [1, 0, 1, None]
    assert col1(spark, ["0.5", "2", "1e30", "-9e18"], lambda c: coerce_long(c, on_fraction="null")) == [
        None, 2, None, -9000000000000000000]
    with pytest.raises(Exception, match="fractional"):
        col1(spark, ["0.5"], coerce_long)


def test_t5_dates(spark):
    vals = ["2009-10-01 00:00:00", "2009-10-01", "10/1/2009", "01-OCT-2009", "43831", "garbage", "2009", None,
            "9999-01-01"]
    d = dt.datetime(2009, 10, 1)
    assert col1(spark, vals, coerce_timestamp) == [d, d, d, d, None, None, None, None, None]


def test_more_date_shapes(spark):
    d = dt.datetime(2009, 10, 1)
    vals = ["2009-10-01 00:00:00.5", "10/1/09", "2009/10/01", "10/1/2009 3:15 PM", "10/1/2009 12:05:30 am", "Oct 1, 2009",
            "October 1, 2009", "May 1, 2009", "20091001", "10/1/68", "10/1/69", "01-OCT-99", "13/45/09", "20091345",
            "Foo 1, 2009", "10/1/2009 15:15 PM", "12/31/99", "2/29/00"]
    assert col1(spark, vals, coerce_timestamp) == [
        d.replace(microsecond=500000), d, d, d.replace(hour=15, minute=15), d.replace(minute=5, second=30), d, d,
        dt.datetime(2009, 5, 1), d, dt.datetime(2068, 10, 1), dt.datetime(1969, 10, 1), dt.datetime(1999, 10, 1), None, None,
        None, None, dt.datetime(1999, 12, 31), dt.datetime(2000, 2, 29)]
