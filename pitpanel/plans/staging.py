"""Staging models M1-M5: parsing, safe casts, de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.config import DEFAULT, PanelConfig
from pitpanel.functions import exprs as X
from pitpanel.sources import schemas


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType


def stg_daily_prices(prices: DataFrame) -> DataFrame:
    """M1: drop rows with a NULL *raw* date, then re-parse the date from either
    ``YYYY-MM-DD`` or ``YYYYMMDD`` text (unparsable -> NULL)."""
    others = [c for c in prices.columns if c != "date"]
    return (prices.filter(F.col("date").isNotNull())
            .select(*others, X.parse_date_two_formats("date").alias("date")))


def stg_dividend_factor(sii: DataFrame, otc: DataFrame, cfg: PanelConfig = DEFAULT) -> DataFrame:
    """M2: both exchanges' ex-dividend factors ref_price / pre_close (not
    de-duplicated: a repeated ex-date fans out the price join, Quirk 1)."""
    def one(src: DataFrame) -> DataFrame:
        return src.select(
            "ticker", F.to_date("ex_dividend_date").alias("ex_date"),
            X.safe_double(X.strip_commas("reference_price_ex_dividend")).alias("ref_price"),
            X.safe_double(X.strip_commas("close_price_pre_adjust")).alias("pre_close"))
    u = one(sii).unionByName(one(otc))
    return (u.filter((F.col("pre_close") > 0) & (F.col("ref_price") > 0)
                     & (F.col("ex_date") >= F.lit(cfg.dividend_floor)))
            .select("ticker", "ex_date", X.safe_div("ref_price", "pre_close").alias("daily_factor")))


def _first_per_key(df: DataFrame, keys: list[str], order) -> DataFrame:
    """Top-1 per key (``row_number() = 1``; planned as a partial WindowGroupLimit
    that trims each key map-side before the shuffle, so copies of one key are
    not all shuffled).  No explicit repartition before it, which would stop
    that partial limit."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def stg_income_statement(income: DataFrame) -> DataFrame:
    """M3: one row per (ticker, year_quarter), measures safe-cast to double.

    The reference orders by its own partition key, i.e. keeps an arbitrary
    row (Quirk 2); here the tie is broken by all other columns ascending so
    reruns are deterministic."""
    others = [F.col(c).asc_nulls_first() for c in income.columns if c not in ("ticker", "year_quarter")]
    first = _first_per_key(income, ["ticker", "year_quarter"], others)
    return first.select("ticker", "company_name", "year_quarter",
                        *[X.safe_double(m, _dtype(income, m)).alias(m) for m in schemas.INCOME_MEASURES])


def stg_monthly_revenue(revenue: DataFrame) -> DataFrame:
    """M4: one row per (ticker, year_month), the largest raw revenue wins
    (NULLs last; remaining ties by the other columns)."""
    others = [F.col(c).asc_nulls_first() for c in revenue.columns
              if c not in ("ticker", "year_month", "revenue")]
    first = _first_per_key(revenue, ["ticker", "year_month"],
                           [F.col("revenue").desc_nulls_last(), *others])
    t = lambda c: _dtype(revenue, c)
    return first.select(
        "ticker", "company_name", "year_month",
        X.strict_bigint("revenue", t("revenue")).alias("revenue"),
        X.safe_bigint("revenue_prev_month", t("revenue_prev_month")).alias("revenue_prev_month"),
        X.strict_bigint("revenue_last_year", t("revenue_last_year")).alias("revenue_last_year"),
        X.safe_double("mom_growth_pct", t("mom_growth_pct")).alias("mom_growth_pct"),
        X.safe_double("yoy_growth_pct", t("yoy_growth_pct")).alias("yoy_growth_pct"),
        X.strict_bigint("revenue_ytd", t("revenue_ytd")).alias("revenue_ytd"),
        X.strict_bigint("revenue_ytd_last_year", t("revenue_ytd_last_year")).alias("revenue_ytd_last_year"),
        X.safe_double("ytd_growth_pct", t("ytd_growth_pct")).alias("ytd_growth_pct"))


def stg_balance_sheet(balance: DataFrame) -> DataFrame:
    """M5: 14-column projection, no de-duplication."""
    return balance.select("ticker", "company_name", *schemas.BALANCE_MEASURES, "year_quarter")
