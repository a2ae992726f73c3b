"""Invariants from the blueprint's test strategy, on the driver's sf0.001 data."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pitpanel.operators import dcf, quality as Q
from pitpanel.plans import marts as M
from pitpanel.plans.dag import Build
from pitpanel.session import ensure_checkpoint_dir
from pitpanel.sources import sinks
from pitpanel.sources.adapters import sources_from_lineitem

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def build(spark):
    return Build(spark, sources_from_lineitem(spark, SF))


def test_last_row_without_later_events_is_unadjusted(spark, build):
    adj = build["int_daily_prices_adjusted"]
    divs = build["stg_dividend_factor"]
    last = adj.withColumn("_rn", F.row_number().over(Window.partitionBy("ticker").orderBy(F.col("date").desc()))) \
              .filter("_rn = 1")
    later_div = last.join(divs, (last.ticker == divs.ticker) & (divs.ex_date >= last.date), "left_semi")
    clean = last.join(later_div.select("ticker"), "ticker", "left_anti").filter(~F.col("ticker").isin("1", "2"))
    assert clean.count() > 0
    assert clean.filter(F.abs(F.col("adj_close") - F.col("close")) > 1e-9).count() == 0


def test_single_quarters_sum_to_q4_ytd(spark, build):
    inc = build["stg_income_statement"].filter(F.col("year_quarter").endswith("-4")) \
        .select("ticker", F.substring("year_quarter", 1, 4).alias("y"), F.col("revenue").alias("ytd"))
    fin = build["int_financial_features"].select("ticker", F.substring("year_quarter", 1, 4).alias("y"),
                                                  "year_quarter", "q_revenue")
    full = fin.groupBy("ticker", "y").agg(F.count("*").alias("n"), F.sum("q_revenue").alias("s")).filter("n = 4")
    j = full.join(inc, ["ticker", "y"])
    assert j.count() > 0
    assert j.filter(F.abs(F.col("s") - F.col("ytd")) > 1e-6 * F.abs(F.col("ytd"))).count() == 0


def test_forward_fill_is_idempotent(spark, build):
    m = build["mart_vbt_master_dataset"]
    refill = m.select("date", "ticker", *[F.last(c, ignorenulls=True).over(
        Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)).alias(c)
        for c in M.FILL_COLUMNS])
    assert refill.exceptAll(m.select("date", "ticker", *M.FILL_COLUMNS)).count() == 0


def test_lookup_equals_direct_nearest_on_grid(spark):
    surface = dcf.dcf_surface(spark)
    lk = dcf.dcf_lookup(spark, surface).filter("discount_rate_pct = 10 AND terminal_growth_rate_pct = 2") \
        .select("pe_x10", "high_growth_years", "implied_growth_pct")
    grid = spark.range(1, 3001).select(F.col("id").alias("pe_x10"), (F.col("id") / 10.0).alias("pe"))
    direct = M.with_implied_growth(grid, "pe", surface)
    for h in (3, 5, 10):
        a = lk.filter(F.col("high_growth_years") == h).select("pe_x10", "implied_growth_pct")
        b = direct.select("pe_x10", F.col(f"implied_growth_{h}y_pct").alias("implied_growth_pct"))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_master_quality_checks_find_the_planted_violations_only(spark, build):
    m = build["mart_vbt_master_dataset"]
    assert Q.duplicate_keys(m).count() == 0
    assert Q.future_dates(m).count() == 0
    planted = build["stg_daily_prices_raw"].filter("date >= DATE'2010-01-01'")
    days = lambda cond: {(r.date, r.ticker) for r in planted.filter(cond).select("date", "ticker").distinct().collect()}
    assert {(r.date, r.ticker) for r in Q.null_keys(m).collect()} == days("ticker IS NULL") != set()
    bad = {(r.date, r.ticker) for r in Q.negative_volume(m).collect()}
    assert bad and bad <= days("volume < 0")


def test_quality_checks_catch_violations(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 2), "A", 5), (dt.date(2020, 1, 2), "A", -1),
                                (None, "B", 1), (dt.date(2999, 1, 1), None, 1)], "date date, ticker string, d_vol long")
    assert Q.duplicate_keys(df).count() == 1
    assert Q.negative_volume(df).count() == 1
    assert Q.null_keys(df).count() == 2
    assert Q.future_dates(df).count() == 1
    assert Q.future_dates(df, as_of=dt.date(2019, 1, 1)).count() == 3


def test_month_partitioned_sink_prunes(spark, build):
    out = f"{ensure_checkpoint_dir(spark)}/test-panel-{uuid.uuid4().hex[:8]}"
    m = build["mart_vbt_master_dataset"].select("date", "ticker", "d_close")
    sinks.write_month_partitioned(m, out)
    rd = sinks.read_panel(spark, out, dt.date(2012, 3, 5), dt.date(2012, 4, 30))
    plan = rd._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_month" in plan
    expect = m.filter((F.col("date") >= "2012-03-05") & (F.col("date") <= "2012-04-30"))
    assert rd.drop(sinks.MONTH_COL).exceptAll(expect).count() == 0 and rd.count() == expect.count()
