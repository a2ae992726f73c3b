"""Scalar traps: date parsing, safe casts, clamps, flags."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.functions import exprs as X


def _one(spark, values, fn, dtype=T.StringType()):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", dtype)]))
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_two_format_dates(spark):
    out = _one(spark, ["2024-1-5", "20240105", "2024-01-05", "x", None], X.parse_date_two_formats)
    assert out == [dt.date(2024, 1, 5)] * 3 + [None, None]


def test_safe_double_is_strict(spark):
    out = _one(spark, ["1234", "", "--", "1d", "1.5", " 2e3 ", "1,234"], X.safe_double)
    assert out == [1234.0, None, None, None, 1.5, 2000.0, None]
    stripped = _one(spark, ["1,234"], lambda c: X.safe_double(X.strip_commas(c)))
    assert stripped == [1234.0]


def test_safe_bigint(spark):
    assert _one(spark, ["12", "1.5", "x", " -3 "], X.safe_bigint) == [12, None, None, -3]
    # floats round half away from zero
    out = _one(spark, [2.5, -2.5, 1.4], lambda c: X.safe_bigint(c, T.DoubleType()), T.DoubleType())
    assert out == [3, -3, 1]


def test_clamp_keeps_null(spark):
    out = _one(spark, [None, 2.0, -1.0, 0.3], lambda c: X.clamp_or_null(c, -0.5, 1.0), T.DoubleType())
    assert out == [None, 1.0, -0.5, 0.3]


def test_flag_null_is_zero(spark):
    out = _one(spark, [None, 1.0, -1.0], lambda c: X.flag(c > 0), T.DoubleType())
    assert out == [0, 1, 0]


def test_safe_div(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(X.safe_div("a", "b")).collect()] == [None, None, 1.5]


def test_year_quarter_parts_strict(spark):
    df = spark.createDataFrame([("2020-2",), ("2020-5",), ("2020-2\n",), ("20-1",)], "yq string")
    y, q = X.year_quarter_parts("yq")
    assert [tuple(r) for r in df.select(y, q).collect()] == [(2020, 2), (None, None), (None, None), (None, None)]


def test_month_to_quarter(spark):
    months = ["2020-01", "2020-02", "2020-03", "2020-04", "2020-05", "2020-07", "2020-08", "2020-10",
              "2020-11", "2020-12"]
    out = _one(spark, months, X.month_to_quarter)
    assert out == ["2019-3", "2019-3", "2019-4", "2019-4", "2020-1", "2020-1", "2020-2", "2020-2",
                   "2020-3", "2020-3"]


def test_three_way_signal(spark):
    out = _one(spark, [None, 0.3, 0.1, 0.0999], lambda c: X.three_way_signal(c, 0.3, 0.1), T.DoubleType())
    assert out == [None, 1, 0, -1]


def test_dirty_numbers_and_dates(spark):
    rows = [("2020-1-3",), ("20200103",), ("12345-01-01",), ("-5-1-1",), ("0000-01-01",), ("99-1-1",), ("123450101",), ("2020-13-01",), (None,)]
    got = {r.s: r.d for r in spark.createDataFrame(rows, "s string").select("s", X.parse_date_two_formats("s").alias("d")).collect()}
    assert got == {"2020-1-3": dt.date(2020, 1, 3), "20200103": dt.date(2020, 1, 3), "12345-01-01": None, "-5-1-1": None,
                   "0000-01-01": None, "99-1-1": dt.date(99, 1, 1), "123450101": None, "2020-13-01": None, None: None}
    months = spark.createDataFrame([("2020-1",), ("2020-11",), (None,)], "m string").select(X.month_start("m").alias("d")).collect()
    assert [r.d for r in months] == [dt.date(2020, 1, 1), dt.date(2020, 11, 1), None]
    for bad in ("2020", "12345-01", "2020-13", "x"):
        with pytest.raises(Exception):
            spark.createDataFrame([(bad,)], "m string").select(X.month_start("m")).collect()
    big = spark.createDataFrame([(1e300, 1e-300), (float("inf"), 2.0), (1.0, 0.0), (6.0, 3.0)], "a double, b double")
    assert [r[0] for r in big.select(X.safe_div("a", "b")).collect()] == [None, float("inf"), None, 2.0]
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (-1.0,), (None,)], "a double")
    assert [r[0] for r in nan.select(X.flag(X.greater("a", 0))).collect()] == [0, 1, 0, 0]
