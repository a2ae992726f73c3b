"""Operator edge cases: trading-day map, dirty input, step table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.operators.actions import action_steps, with_action_factors
from pitpanel.operators.calendar import TradingDayMap, align_to_calendar
from tests import fixtures as fx

D = dt.date


def test_day_map_edges(spark):
    cal = spark.createDataFrame([(D(2020, 1, 3),), (D(2020, 1, 6),), (D(2020, 1, 7),)], "date date")
    days = TradingDayMap(cal)
    box = T.StructType([T.StructField("v", T.LongType())])
    ev = spark.createDataFrame(
        [(D(2019, 12, 1), "A", (1,)), (D(2020, 1, 3), "A", (1,)), (D(2020, 1, 4), "A", (1,)),
         (D(2020, 1, 5), "A", (1,)), (D(2020, 1, 8), "A", (1,)), (D(2020, 1, 4), "B", (None,)),
         (None, "C", (1,))],
        T.StructType([T.StructField("deadline_date", T.DateType()), T.StructField("ticker", T.StringType()),
                      T.StructField("box", box)]))
    out = align_to_calendar(ev, days, "box", ["v"])
    got = sorted((r.ticker, r.date) for r in out.collect())
    assert got == [("A", D(2020, 1, 3)),      # before the first trading date -> the first one
                   ("A", D(2020, 1, 3)),      # on a trading date -> itself
                   ("A", D(2020, 1, 6)),      # Saturday -> Monday
                   ("A", D(2020, 1, 6)),      # Sunday -> Monday
                   ("A", D(2020, 1, 8)),      # after the last trading date -> raw deadline
                   ("B", D(2020, 1, 4)),      # NULL field in the box -> raw deadline (T1)
                   ("C", None)]               # no deadline -> no date
    assert days.table.count() == 5            # 01-03, 01-04..06, 01-07


def test_nan_field_keeps_the_raw_deadline(spark):
    days = TradingDayMap(spark.createDataFrame([(D(2020, 1, 6),)], "date date"))
    ev = spark.createDataFrame([(D(2020, 1, 4), "A", (1.0,)), (D(2020, 1, 4), "B", (float("nan"),))],
                               "deadline_date date, ticker string, box struct<v: double>")
    got = {r.ticker: r.date for r in align_to_calendar(ev, days, "box", ["v"]).collect()}
    assert got == {"A": D(2020, 1, 6), "B": D(2020, 1, 4)}


def test_non_positive_factor_stops_the_job(spark):
    acts = fx.actions(spark, [("A", D(2020, 1, 3), 0.0, 0.5, 2.0)])
    with pytest.raises(Exception, match="must be positive"):
        action_steps(acts, ["price_factor"]).collect()


def test_action_steps_same_day_actions_multiply(spark):
    acts = fx.actions(spark, [("A", D(2020, 1, 3), 0.5, 0.5, 2.0), ("A", D(2020, 1, 3), 0.5, 0.5, 2.0),
                              ("A", D(2020, 2, 3), 0.1, 0.1, 10.0)])
    steps = {(r._a_lo, r._a_hi): round(r._f_price_factor, 12) for r in action_steps(acts, ["price_factor"]).collect()}
    assert steps == {(None, D(2020, 1, 3)): 0.025, (D(2020, 1, 3), D(2020, 2, 3)): 0.1}
    facts = spark.createDataFrame([("A", D(2020, 1, 2)), ("A", D(2020, 1, 3)), ("A", D(2020, 2, 3)),
                                   ("A", None), ("Z", D(2020, 1, 1))], "ticker string, date date")
    out = with_action_factors(facts, acts, "date", {"f": "price_factor"})
    got = {(r.ticker, r.date): round(r.f, 12) for r in out.collect()}
    assert got == {("A", D(2020, 1, 2)): 0.025, ("A", D(2020, 1, 3)): 0.1, ("A", D(2020, 2, 3)): 1.0,
                   ("A", None): 1.0, ("Z", D(2020, 1, 1)): 1.0}
