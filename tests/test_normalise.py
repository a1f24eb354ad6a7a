"""Text -> typed values (edge table of FIXTURES.md §4)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import normalise as N


def _one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_integer_key(spark):
    got = _one_col(spark, ["007", "1e3", " 5 ", "C1", "0x10", "1,000", "", "9007199254740993", None],
                   N.int_key)
    assert got == ["7", "1000", "5", None, None, None, None, "9007199254740993", None]


def test_integer_key_fractional_and_infinite_are_unusable(spark):
    assert _one_col(spark, ["1.5", "inf", "-inf", "12.0", "NaN"], N.int_key) == [None, None, None, "12", None]


def test_numeric_guard_rejects_spark_only_forms(spark):
    assert _one_col(spark, ["1d", "2f", "NaN", "0x1p3"], N.to_double) == [None, None, None, None]


def test_numeric_lenient_parse(spark):
    got = _one_col(spark, [" 12.5 ", "1e3", "-3", ".5", "abc", "NA", "inf"], N.to_double)
    assert got == [12.5, 1000.0, -3.0, 0.5, None, None, float("inf")]


def test_numeric_column_nan_becomes_null(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "x double")
    got = [r[0] for r in df.select(N.to_double(F.col("x"), df.schema["x"].dataType)).collect()]
    assert got == [1.5, None, None]


def test_month_start(spark):
    got = _one_col(spark, ["2024-1", "2024-01", "2024-13", "nan", "2024/01", "2024-01-05", "2024-00"],
                   N.month_start)
    d = dt.date(2024, 1, 1)
    assert got == [d, d, None, None, None, None, None]


def test_strip_all_whitespace(spark):
    got = _one_col(spark, ["  a b \t", " x　", "\n"], N.strip_ws)
    assert got == ["a b", "x", ""]


def test_na_tokens_become_null(spark):
    got = _one_col(spark, ["NA", "n/a", "null", "None", "", " NA", "ok"], N.clean_text)
    assert got == [None, None, None, None, None, "NA", "ok"]


def test_compat_text_nan(spark):
    assert _one_col(spark, [None, "x"], lambda c: N.clean_text(c, compat_nan=True)) == ["nan", "x"]


def test_currency_code(spark):
    got = _one_col(spark, [" euro ", "usd", "GBR", "XXX", None, "inrr", "aedx"], N.currency_code)
    assert got == ["EUR", "USD", "GBP", None, None, "INR", "AED"]


def test_timestamp_parse(spark):
    got = _one_col(spark, ["2024-01-02 03:04:05", "2024-01-02", "2024-01-02T03:04:05", "bad"],
                   N.to_timestamp)
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2),
                   dt.datetime(2024, 1, 2, 3, 4, 5), None]


def test_finite_or_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    assert [r[0] for r in df.select(N.finite_or_null(F.col("x"))).collect()] == [1.0, None, None, None]
