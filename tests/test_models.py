"""Model-level micro-fixtures for the reference's quirks (FIXTURES.md §4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.config import DEFAULT
from pitpanel.operators.calendar import trading_calendar
from pitpanel.plans import intermediate as I
from pitpanel.plans import marts as M
from pitpanel.plans import staging as S
from pitpanel.plans.dag import Build
from pitpanel.sources import schemas
from tests import fixtures as fx

D = dt.date


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_duplicate_dividends_fan_out_and_own_day_factor(spark):
    p = fx.prices(spark, [("A", "2020-01-02", 100.0), ("A", "20200103", 100.0), ("A", "2020-01-06", 100.0)])
    d = fx.dividends(spark, [("A", D(2020, 1, 3), "90", "100"), ("A", D(2020, 1, 3), "90", "1,00")])
    src = fx.sources(spark, daily_prices=p, sii_dividend=d)
    adj = Build(spark, src)["int_daily_prices_adjusted"]
    got = [(r.date, round(r.adj_close, 9)) for r in adj.orderBy("date", "adj_close").collect()]
    # Quirk 1: the repeated ex-date fans out; Quirk 3: the ex-date row includes its own factor
    assert got == [(D(2020, 1, 2), 81.0), (D(2020, 1, 3), 81.0), (D(2020, 1, 3), 90.0), (D(2020, 1, 6), 100.0)]


def test_split_applies_strictly_before_effective_date(spark):
    p = fx.prices(spark, [("A", "2020-01-02", 100.0), ("A", "2020-01-03", 100.0), ("A", "2020-01-06", 100.0),
                          ("B", "2020-01-02", 100.0)])
    acts = fx.actions(spark, [("A", D(2020, 1, 3), 0.5, 0.5, 2.0), ("A", D(2020, 1, 6), 0.25, 0.25, 4.0)])
    src = fx.sources(spark, daily_prices=p, corporate_actions=acts)
    adj = Build(spark, src)["int_daily_prices_adjusted"]
    got = {(r.ticker, r.date): round(r.adj_close, 9) for r in adj.collect()}
    assert got == {("A", D(2020, 1, 2)): 12.5, ("A", D(2020, 1, 3)): 25.0, ("A", D(2020, 1, 6)): 100.0,
                   ("B", D(2020, 1, 2)): 100.0}


def test_raw_null_date_dropped_and_floors(spark):
    p = fx.prices(spark, [("A", None, 1.0), ("A", "bad", 2.0), ("A", "1999-12-31", 3.0),
                          ("A", "2008-12-31", 4.0), ("A", "2009-12-31", 5.0), ("A", "2010-01-04", 6.0)])
    b = Build(spark, fx.sources(spark, daily_prices=p))
    assert b["stg_daily_prices_raw"].count() == 5          # NULL raw date dropped, 'bad' kept as NULL
    assert b["int_daily_prices_adjusted"].count() == 3     # < 2000 and unparsable dropped
    ind = b["int_daily_indicators"]
    assert _rows(ind, "date", "ma20") == [(D(2009, 12, 31), 5.0), (D(2010, 1, 4), 5.5)]   # warm-up from 2009
    master = b["mart_vbt_master_dataset"]
    # 2010 floor after the fill, before LEAD: ma20 still sees 2009
    assert _rows(master, "date", "ma20", "ret_1d") == [(D(2010, 1, 4), 5.5, None)]


def test_missing_q2_and_single_quarter_rules(spark):
    inc = fx.income(spark, [("A", "2020-1", 100.0, 10.0, 5.0, 1.0), ("A", "2020-3", 300.0, 0.0, 0.0, 3.0),
                            ("A", "2021-1", 0.0, 1.0, 1.0, 0.5)])
    f = Build(spark, fx.sources(spark, income_statement=inc))["int_financial_features"]
    got = {r.year_quarter: r for r in f.collect()}
    assert got["2020-3"].q_revenue == 200.0        # Quirk 11: Q3 - Q1 (row-based LAG)
    assert got["2020-1"].ebit_volatility is None     # one quarter -> NULL stddev
    assert got["2021-1"].operating_margin is None    # zero revenue -> NULL margin
    assert got["2020-3"].revenue_ttm is None         # fewer than four quarters
    assert got["2020-1"].EBIT_signal == 1 and got["2020-3"].EBIT_signal == 0


def test_deadlines_q2_income_vs_balance(spark):
    df = spark.createDataFrame([("2020-2", 2020, 2), ("2020-4", 2020, 4), ("2020-9", None, None)],
                               "year_quarter string, year bigint, quarter bigint")
    out = df.select(I.income_deadline("year_quarter").alias("i"), I.balance_deadline().alias("b")).collect()
    assert [tuple(r) for r in out] == [(D(2020, 8, 15), D(2020, 8, 16)), (D(2021, 4, 1), D(2021, 4, 1)),
                                       (D(2021, 4, 1), None)]


def _revenue(spark, rows):
    """rows: (ticker, year_month, revenue, yoy_text); mom/ytd text copy the yoy text, so
    a NULL yoy leaves the box with NULL fields and a given yoy a complete box."""
    full = [(t, "co", ym, rev, None, None, yoy, yoy, rev, None, yoy) for t, ym, rev, yoy in rows]
    return spark.createDataFrame(full, schemas.MONTHLY_REVENUE)


def test_null_box_field_keeps_raw_sunday_deadline(spark):
    # deadline of 2020-09 is Sunday 2020-10-11; calendar has Fri 10-09 and Mon 10-12
    p = fx.prices(spark, [("A", "2020-10-09", 1.0), ("A", "2020-10-12", 1.0)])
    rev = _revenue(spark, [("A", "2020-09", 10, None), ("B", "2020-09", 10, "5.0")])
    b = Build(spark, fx.sources(spark, daily_prices=p, monthly_revenue=rev))
    sh = b["int_monthly_revenue_shifter"]
    got = {r.ticker: r.date for r in sh.collect()}
    assert got == {"A": D(2020, 10, 11), "B": D(2020, 10, 12)}   # T1: NULL field -> raw deadline
    # Quirk 5: the phantom (Sunday) row appears in the master with NULL prices
    m = b["mart_vbt_master_dataset"].filter("ticker = 'A'")
    assert _rows(m, "date", "d_close", "revenue_month") == [(D(2020, 10, 9), 1.0, None),
                                                              (D(2020, 10, 11), None, "2020-09"),
                                                              (D(2020, 10, 12), 1.0, "2020-09")]


def test_collisions_latest_label_and_per_field_fill(spark):
    days = [("A", f"2009-01-{d:02d}", 1.0) for d in (5, 6)] + [("A", "2009-11-11", 1.0), ("A", "2009-12-11", 1.0),
                                                                ("A", "2010-01-04", 1.0)]
    p = fx.prices(spark, days)
    rev = _revenue(spark, [("A", "2008-09", 1, "1.0"), ("A", "2008-10", 2, "2.0"), ("A", "2008-11", 3, "3.0"),
                           ("A", "2009-10", 4, "5.0"), ("A", "2009-11", 5, None)])
    b = Build(spark, fx.sources(spark, daily_prices=p, monthly_revenue=rev))
    m = b["mart_vbt_master_dataset"]
    # 2008-09..11 all align to 2009-01-05 (Quirk 4): latest label wins; 2009-11 has a NULL
    # yoy, so it keeps its raw deadline and yoy stays from the older report (Quirk 6)
    assert _rows(m, "date", "revenue_month", "revenue", "yoy_growth") == [(D(2010, 1, 4), "2009-11", 5, 5.0)]
    col = M.collapse_stack(b["int_vbt_stack"]).filter("date = '2009-01-05'").collect()[0]
    assert col.r.data_month_label == "2008-11"


def test_pe_bucket_edges(spark):
    sch = ", ".join(f"{c} {'date' if c == 'date' else 'string' if c in ('ticker', 'revenue_month', 'report_quarter') else 'bigint' if c in ('revenue', 'monthly_revenue_ttm') else 'double'}"
                    for c in M.EXPECTATION_FEATURE_COLS)
    vals = []
    for pe in (0.04, 0.05, 300.0, 300.1, 26.75):
        row = {c: None for c in M.EXPECTATION_FEATURE_COLS}
        row.update(date=D(2012, 1, 2), ticker="A", d_close=pe, eps_ttm=1.0, pe_ttm=pe)
        vals.append(tuple(row[c] for c in M.EXPECTATION_FEATURE_COLS))
    feats = spark.createDataFrame(vals, sch)
    from pitpanel.operators import dcf
    lk = dcf.dcf_lookup(spark, dcf.dcf_surface(spark))
    out = M.mart_expectation_dataset(feats, lk)
    got = {round(r.pe_ttm, 2): (r.pe_x10, r.implied_growth_pct) for r in out.collect()}
    assert set(got) == {0.04, 0.05, 300.0, 26.75}      # 300.1 filtered
    assert got[0.04] == (0, None)                     # Quirk 9: pe_x10 = 0 is off the grid
    assert got[0.05][0] == 1 and got[300.0][0] == 3000 and got[26.75][0] == 268
    assert got[0.05][1] is not None


def test_yoy_normalisation_and_clamp(spark):
    df = spark.createDataFrame(
        [("A", "m1", D(2020, 1, 1), 1, 0.8), ("A", "m2", D(2020, 2, 1), 1, 1.0), ("A", "m3", D(2020, 3, 1), 1, 1.5),
         ("A", "m4", D(2020, 4, 1), 1, None), ("B", "m1", D(2020, 1, 1), 1, 500.0)],
        "ticker string, revenue_month string, revenue_available_date date, revenue bigint, yoy_growth double")
    out = {(r.ticker, r.revenue_month): r for r in M.revenue_momentum(df).collect()}
    assert out[("A", "m1")].revenue_yoy_3m_avg == pytest.approx(0.8)        # Quirk 8: 0.8 kept
    assert out[("A", "m3")].revenue_yoy_3m_avg == pytest.approx((0.8 + 1.0 + 0.015) / 3)
    assert out[("A", "m4")].revenue_yoy_3m_avg == pytest.approx((1.0 + 0.015) / 2)
    assert out[("B", "m1")].expected_revenue_growth == 1.0                  # clamped at the cap
    assert out[("A", "m1")].monthly_revenue_ttm is None


def test_trading_calendar_is_distinct(spark):
    df = spark.createDataFrame([(D(2020, 1, 2),), (D(2020, 1, 2),), (D(2020, 1, 3),)], "date date")
    assert trading_calendar(df).count() == 2


def test_fused_master_equals_stack_master(spark):
    from pitpanel.sources.adapters import sources_from_lineitem
    from pitpanel.stable import stabilize
    b = Build(spark, sources_from_lineitem(spark, "/root/testdata/sf0.001"))
    fused = stabilize(b["mart_vbt_master_dataset"])
    plain = stabilize(M.mart_vbt_master_dataset(b["int_vbt_stack"]))
    assert fused.exceptAll(plain).count() == 0 and plain.exceptAll(fused).count() == 0


def test_copies_and_distinct_factors_on_one_ex_date(spark):
    p = fx.prices(spark, [("A", "2020-01-02", 100.0), ("A", "2020-01-03", 100.0), ("A", "2020-01-06", 100.0)])
    d = fx.dividends(spark, [("A", D(2020, 1, 3), "90", "100"), ("A", D(2020, 1, 3), "90", "100"),
                             ("A", D(2020, 1, 3), "80", "100")])
    adj = Build(spark, fx.sources(spark, daily_prices=p, sii_dividend=d))["int_daily_prices_adjusted"]
    got = sorted((r.date, round(r.adj_close, 9)) for r in adj.collect())
    # one row per dividend row (join fan-out); ordered by factor inside the reverse product
    assert got == [(D(2020, 1, 2), 64.8), (D(2020, 1, 3), 64.8), (D(2020, 1, 3), 72.0), (D(2020, 1, 3), 80.0),
                   (D(2020, 1, 6), 100.0)]


def test_integer_dates_and_text_ex_dates(spark):
    p = spark.createDataFrame([("A", 20200102, 100.0, 1), ("A", 20200103, 100.0, 1), (None, None, 1.0, 1)],
                              "ticker string, date bigint, close double, volume bigint") \
             .withColumn("open", F.col("close")).withColumn("high", F.col("close")).withColumn("low", F.col("close"))
    d = spark.createDataFrame([("A", "2020-01-03", "90", "100")],
                              "ticker string, ex_dividend_date string, reference_price_ex_dividend string, "
                              "close_price_pre_adjust string")
    b = Build(spark, fx.sources(spark, daily_prices=p, sii_dividend=d))
    got = sorted((r.date, round(r.adj_close, 9)) for r in b["int_daily_prices_adjusted"].collect())
    assert got == [(D(2020, 1, 2), 90.0), (D(2020, 1, 3), 90.0)]


def test_duplicate_statements_collapse_deterministically(spark):
    p = fx.prices(spark, [("A", "2010-05-17", 1.0), ("A", "2010-05-18", 1.0)])
    rows = []
    for te in ("2000", "1000", "3000"):           # three copies of 2010-1 with different equity
        rows.append(("A", "co", "50", "50", "100", "10", "10", "20", "20", "5", "5", te, "10", "2010-1"))
    bs = spark.createDataFrame(rows, schemas.BALANCE_SHEET)
    m = Build(spark, fx.sources(spark, daily_prices=p, balance_sheet=bs))["mart_vbt_master_dataset"]
    got = {r.date: r.total_equity for r in m.collect()}
    assert got[D(2010, 5, 17)] == 3000.0          # deadline Sun 05-16 is a phantom row before it
