"""Driver tables -> the reference's six stock sources (see FIXTURES.md §3).

The driver ships TPC-H-like tables only, so every source is *derived by Spark*
from ``lineitem`` and grows with it: ``l_suppkey`` is the ticker, the ship
date (moved by a fixed offset into 2009-2015) is the trading date, and the
money columns are integer cents so sums are exact in every engine.

The formulas are fixed values shared with the DuckDB twin in ``twin/sql.py``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitpanel.sources import schemas
from pitpanel.sources.readers import Sources

# --- fixed values -----------------------------------------------------------
SHIFT_DAYS = 5114                 # 1995-01-02 .. 2001-11-04 -> 2009-01-02 .. 2015-11-05
PRICE_BASE, PRICE_SPAN = 500, 1000
SHARES_PER_EPS = 2_000_000.0
# other ten income measures as tenths of revenue, in schema order
INCOME_TENTHS = {"cost_of_goods_sold": 6, "gross_profit": 4, "unrealized_sales_gain_loss": 0,
                 "realized_sales_gain_loss": 0, "gross_profit_net": 4, "operating_expenses": 3,
                 "other_income_expense_net": 1, "non_operating_income_expense": 1,
                 "income_before_tax": 2, "income_tax_expense": 1}
# rows that take the rules' rarer paths: every so many-th bar volume, dividend price, revenue or quantity sum
NEGATIVE_VOLUME, OLD_BAR, NO_DATE, BAD_DATE, NO_TICKER = 31, 37, 41, 43, 47
DIVIDEND_COPY, OTHER_EXCHANGE, ZERO_REFERENCE, OLD_DIVIDEND = 5, 11, 13, 17
STATEMENT_COPY = 3
BAD_QUARTER, BAD_YEAR, NO_CAPITAL = 19, 23, 29
#: Line items for each task of the windows over a ticker's months and quarters, and the least number of such tasks.
LINES_PER_TASK, LEAST_TASKS = 200_000, 8
CORPORATE_ACTION_ROWS = [
    ("1", dt.date(2011, 6, 18), 0.25, 0.25, 4.0, "split 1:4"),
    ("1", dt.date(2013, 3, 4), 0.5, 0.5, 2.0, "split 1:2"),
    ("2", dt.date(2012, 8, 25), 0.25, 0.25, 4.0, "split 1:4"),
]


def lineitem_rows(lineitem: DataFrame) -> DataFrame:
    """The common per-line projection every adapter starts from."""
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("ticker"),
        F.col("l_suppkey").alias("suppkey"),
        F.date_add(F.to_date("l_shipdate"), SHIFT_DAYS).alias("d"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        (F.lit(PRICE_BASE) + F.floor("l_extendedprice").cast("bigint") % PRICE_SPAN).alias("px"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("disc100"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("tax100"),
        "l_orderkey", "l_linenumber", "l_returnflag")


def _kinds(*kinds: tuple) -> Column:
    """Array of the kinds of rows that a row becomes: 0 (itself) and each (kind, condition) that holds."""
    return F.concat(F.array(F.lit(0)), *[F.when(c, F.array(F.lit(k))).otherwise(F.array().cast("array<int>")) for k, c in kinds])


def daily_prices(rows: DataFrame) -> DataFrame:
    """One bar per (ticker, weekday); even tickers write ``yyyyMMdd`` text
    dates, odd tickers ``yyyy-MM-dd``.

    Some bars have a negative volume, and some come again with a date before
    the panels, without a date, with one that no format takes, or without a
    ticker."""
    # (l_orderkey, l_linenumber, px) packed into one bigint with the same order
    # (linenumber < 16, px < 2048), so first/last of day is a hash aggregate
    key = (F.col("l_orderkey") * 16 + F.col("l_linenumber")) * 2048 + F.col("px")
    bars = (rows.filter(F.weekday("d") < 5)
            .groupBy("ticker", "suppkey", "d")
            .agg(F.min("px").alias("low"), F.max("px").alias("high"),
                 (F.min(key) % 2048).alias("open"), (F.max(key) % 2048).alias("close"),
                 F.sum("qty").cast("bigint").alias("v")))
    v = F.col("v")
    bars = bars.withColumn("kind", F.explode(_kinds((1, v % OLD_BAR == 0), (2, v % NO_DATE == 0), (3, v % BAD_DATE == 0),
                                                    (4, v % NO_TICKER == 0))))
    kind, day = F.col("kind"), F.when(F.col("kind") == 1, F.date_sub("d", SHIFT_DAYS)).otherwise(F.col("d"))
    text_date = (F.when(kind == 2, F.lit(None)).when(kind == 3, F.date_format("d", "dd/MM/yyyy"))
                  .when(F.col("suppkey") % 2 == 0, F.date_format(day, "yyyyMMdd")).otherwise(F.date_format(day, "yyyy-MM-dd")))
    return bars.select(F.when(kind != 4, F.col("ticker")).alias("ticker"), text_date.alias("date"),
                       *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
                       F.when((kind == 0) & (v % NEGATIVE_VOLUME == 0), -v).otherwise(v).alias("volume"))


def _pct(new, old):
    return F.lit(100.0) * (new - old).cast("double") / old.cast("double")


def by_ticker(df: DataFrame, tasks: int | None) -> DataFrame:
    """``df`` dealt by ticker into ``tasks`` parts (None: as the session says).

    All windows over a report, up to its features, run in this partitioning, each with a sort of its own; so the parts grow
    in number with the line items, and not in size."""
    return df if tasks is None else df.repartition(tasks, "ticker")


def monthly_revenue(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Monthly revenue with last-year / previous-month / YTD companions.

    Companions are looked up by month index with exact RANGE frames (no
    self-join); a copy with revenue-1 is added when revenue % 5 == 0 so the
    staging dedup has work to do.
    """
    m = (rows.groupBy("ticker", F.year("d").alias("y"), F.month("d").alias("m"))
         .agg(F.sum("cents").alias("revenue"))
         .withColumn("mi", F.col("y") * 12 + F.col("m") - 1))
    m = by_ticker(m, tasks)
    months = Window.partitionBy("ticker").orderBy("mi")
    ytd_w = Window.partitionBy("ticker", "y").orderBy("m")
    m = m.withColumn("revenue_ytd", F.sum("revenue").over(ytd_w))
    at = lambda c, k: F.max(c).over(months.rangeBetween(-k, -k))
    m = (m.withColumn("ly", at("revenue", 12))
          .withColumn("pm", at("revenue", 1))
          .withColumn("ytd_ly", at("revenue_ytd", 12)))
    out = m.select(
        "ticker", F.concat(F.lit("co"), F.col("ticker")).alias("company_name"),
        F.format_string("%04d-%02d", "y", "m").alias("year_month"),
        F.col("revenue").cast("bigint").alias("revenue"),
        F.col("pm").cast("string").alias("revenue_prev_month"),
        F.col("ly").cast("string").alias("revenue_last_year"),
        _pct(F.col("revenue"), F.col("pm")).cast("string").alias("mom_growth_pct"),
        _pct(F.col("revenue"), F.col("ly")).cast("string").alias("yoy_growth_pct"),
        F.col("revenue_ytd").cast("string").alias("revenue_ytd"),
        F.col("ytd_ly").cast("bigint").alias("revenue_ytd_last_year"),
        _pct(F.col("revenue_ytd"), F.col("ytd_ly")).cast("string").alias("ytd_growth_pct"))
    # one pass: rows with revenue % 5 == 0 are emitted twice, the copy one lower
    copies = F.when(F.col("revenue") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = out.withColumn("_copy", F.explode(copies))
    return out.withColumn("revenue", F.col("revenue") - F.col("_copy")).drop("_copy")


def income_statement(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Cumulative-within-year income statements per (ticker, year, quarter);
    some come again with a revenue one lower, which the staging's order picks."""
    line_op = F.floor((F.col("cents") * (F.col("disc100") - 4) * 8) / F.lit(100.0))
    line_ni = F.floor((F.col("cents") * (F.col("disc100") - F.col("tax100")) * 8) / F.lit(100.0))
    q = (rows.groupBy("ticker", F.year("d").alias("y"), F.quarter("d").alias("q"))
         .agg(F.sum("cents").alias("rev"), F.sum(line_op).alias("op"), F.sum(line_ni).alias("ni")))
    ytd = Window.partitionBy("ticker", "y").orderBy("q")
    q = by_ticker(q, tasks).select("ticker", "y", "q", *[F.sum(c).over(ytd).cast("double").alias(c)
                                       for c in ("rev", "op", "ni")])
    measures = {"revenue": F.col("rev"), "operating_income": F.col("op"),
                "net_income": F.col("ni"), "eps": F.col("ni") / F.lit(SHARES_PER_EPS)}
    measures.update({k: F.col("rev") * F.lit(float(v)) / F.lit(10.0) for k, v in INCOME_TENTHS.items()})
    out = q.select("ticker", F.concat(F.lit("co"), F.col("ticker")).alias("company_name"),
                   F.concat_ws("-", F.col("y").cast("string"), F.col("q").cast("string")).alias("year_quarter"),
                   *[measures[m].alias(m) for m in schemas.INCOME_MEASURES],
                   F.explode(_kinds((1, F.col("rev").cast("bigint") % STATEMENT_COPY == 0))).alias("_copy"))
    return out.withColumn("revenue", F.col("revenue") - F.col("_copy")).drop("_copy")


def balance_sheet(rows: DataFrame) -> DataFrame:
    """Quarter-end balance sheets (thousands of NTD) from summed quantities;
    some without share capital, some once more under a label that is no quarter."""
    b = rows.groupBy("ticker", F.year("d").alias("y"), F.quarter("d").alias("q")) \
            .agg(F.sum("qty").alias("qs"))
    qs = F.col("qs")
    bvps = (F.lit(300) + qs % 500).cast("double")
    te = bvps * F.lit(2e6)
    sc = F.when(qs % NO_CAPITAL == 0, F.lit(0.0)).otherwise(F.lit(2e7) * (F.lit(7) + qs % 7).cast("double") / F.lit(10.0))
    tl = te * (F.lit(1) + qs % 5).cast("double") / F.lit(4.0)
    ta = F.when(qs % 11 == 0, (te + tl) * F.lit(1.1)).otherwise(te + tl)
    b = b.select("ticker", "y", "q", bvps.alias("bvps"), te.alias("te"), sc.alias("sc"),
                 tl.alias("tl"), ta.alias("ta"), qs)
    ca = F.col("ta") / F.lit(2.0)
    cl = F.when(qs % 13 == 0, F.lit(0.0)).otherwise(F.col("tl") * F.lit(0.6))
    cs = F.col("te") * F.lit(0.1)
    year, quarter = F.col("y").cast("string"), F.col("q").cast("string")
    b = b.withColumn("kind", F.explode(_kinds((1, qs % BAD_QUARTER == 0), (2, qs % BAD_YEAR == 0))))
    label = (F.when(F.col("kind") == 1, F.concat(year, F.lit("-9"))).when(F.col("kind") == 2, F.concat(F.lit("FY"), year, F.lit("-"), quarter))
              .otherwise(F.concat_ws("-", year, quarter)))
    return b.select(
        "ticker", F.concat(F.lit("co"), F.col("ticker")).alias("company_name"),
        ca.alias("current_assets"), (F.col("ta") - ca).alias("non_current_assets"),
        F.col("ta").alias("total_assets"), cl.alias("current_liabilities"),
        (F.col("tl") - cl).alias("non_current_liabilities"), F.col("tl").alias("total_liabilities"),
        F.col("sc").alias("share_capital"), cs.alias("capital_surplus"),
        (F.col("te") - F.col("sc") - cs).alias("retained_earnings"),
        F.col("te").alias("total_equity"), F.col("bvps").alias("book_value_per_share"), label.alias("year_quarter"))


def dividends(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sii, otc) dividend tables; pre-close text carries thousands commas.

    Some rows come twice, some on both exchanges with another price, some with
    a reference price of 0 or a date before the panels."""
    d = (rows.filter((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
                     & (F.col("l_orderkey") % 4 == 0))
         .groupBy("ticker", "suppkey", "d").agg(F.max("px").alias("mx")))
    mx, kind = F.col("mx"), F.col("kind")
    d = d.withColumn("kind", F.explode(_kinds((1, mx % DIVIDEND_COPY == 0), (2, mx % OTHER_EXCHANGE == 0),
                                              (3, mx % ZERO_REFERENCE == 0), (4, mx % OLD_DIVIDEND == 0))))
    tenths = F.when(kind == 2, 90).when(kind == 3, 0).otherwise(95)
    d = d.select("ticker", F.when(kind == 4, F.date_sub("d", SHIFT_DAYS)).otherwise(F.col("d")).alias("d"),
                 (mx * tenths / F.lit(10.0)).alias("reference_price_ex_dividend"),
                 F.format_number(mx * 10, 0).alias("close_price_pre_adjust"),
                 ((F.col("suppkey") + (kind == 2).cast("int")) % 2).alias("exchange"))
    cols = ["ticker", "ex_dividend_date", "reference_price_ex_dividend", "close_price_pre_adjust"]
    sii = d.filter("exchange = 0").withColumn("ex_dividend_date", F.col("d").cast("timestamp_ntz")).select(*cols)
    otc = d.filter("exchange = 1").withColumn("ex_dividend_date", F.col("d")).select(*cols)
    return sii, otc


def corporate_actions(spark: SparkSession) -> DataFrame:
    """The fixture seed as a JVM-side literal relation (no Python workers)."""
    names = schemas.CORPORATE_ACTIONS.names
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in CORPORATE_ACTION_ROWS]
    lit_rows = spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return lit_rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.CORPORATE_ACTIONS.fields])


def sources_from_lineitem(spark: SparkSession, sf_dir: str) -> Sources:
    """All seven inputs derived from ``<sf_dir>/lineitem.parquet``."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows, tasks = lineitem_rows(lineitem), max(LEAST_TASKS, -(-lineitem.count() // LINES_PER_TASK))
    sii, otc = dividends(rows)
    return Sources(daily_prices=daily_prices(rows), sii_dividend=sii, otc_dividend=otc,
                   monthly_revenue=monthly_revenue(rows, tasks), income_statement=income_statement(rows, tasks),
                   balance_sheet=balance_sheet(rows), corporate_actions=corporate_actions(spark))
