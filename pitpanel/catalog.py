"""Registered queries: one per operator group of the blueprint, each reading
the driver's tables through the adapters and returning a DataFrame.

Every query runs over the whole derived tables (no sampling, no caps); struct
outputs are flattened and doubles rounded (``pitpanel.stable``) so the result
hashes identically to the DuckDB twin in ``twin/sql.py``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.config import DEFAULT, PanelConfig
from pitpanel.operators import quality as Q
from pitpanel.operators.actions import with_action_factors
from pitpanel.operators.dcf import LOOKUP_GROUP
from pitpanel.operators.nearest import NearestIndex
from pitpanel.operators.neighbours import nearest_by_merge
from pitpanel.plans import marts as M
from pitpanel.plans.dag import Build
from pitpanel.session import ensure_checkpoint_dir
from pitpanel.sources.adapters import sources_from_lineitem
from pitpanel.stable import flatten, stabilize


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/pitpanel-build-{uuid.uuid4().hex}"


def _build(spark: SparkSession, sf_dir: str) -> Build:
    """Models as lazy plans; staged prices, dated reports and block starts are stored when a model asks for them."""
    return Build(spark, sources_from_lineitem(spark, sf_dir), DEFAULT, scratch=_folder(spark))


def _model(name: str, cols: list[str] | None = None):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _build(spark, sf_dir)[name]
        return df.select(*cols) if cols else df
    return q


#: Rows of a ticker beyond which the queries below cut it, so that the driver's tickers are cut.
FEW_ROWS = 100


def _with_tables(spark: SparkSession, sf_dir: str, cfg: PanelConfig) -> Build:
    return Build(spark, sources_from_lineitem(spark, sf_dir), cfg, out_dir=_folder(spark))


def _in_blocks(name: str):
    """The model as a build with tables makes it, every ticker cut into blocks."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _with_tables(spark, sf_dir, replace(DEFAULT, block_rows=FEW_ROWS, block_pieces=1 << 30))[name]
    return q


def _flat(name: str, boxes: dict[str, str]):
    def q(spark, sf_dir):
        df = _build(spark, sf_dir)[name]
        for col, prefix in boxes.items():
            df = flatten(df, col, prefix)
        return df
    return q


#: Closing date of the check for later rows as of a given day.
CLOSING_DATE = dt.date(2015, 6, 30)
FIN_KEYS = ["ticker", "year_quarter"]


def _collapse(spark, sf_dir):
    df = M.collapse_stack(_build(spark, sf_dir)["int_vbt_stack"])
    for col, prefix in (("r", "rev_"), ("f", "fin_"), ("b", "bs_")):
        df = flatten(df, col, prefix)
    return df


def _monthly_unfill(spark, sf_dir):
    return M.monthly_unfill(_build(spark, sf_dir)["mart_vbt_master_dataset"])


def _revenue_momentum(spark, sf_dir):
    return M.revenue_momentum(M.monthly_unfill(_build(spark, sf_dir)["mart_vbt_master_dataset"]))


def _master_check(check):
    def q(spark, sf_dir):
        return check(_build(spark, sf_dir)["mart_vbt_master_dataset"])
    return q


def _valuation_by_merge(spark, sf_dir):
    """M18 with the sorted merge in place of the broadcast grid: whatever the number of candidates."""
    b = _build(spark, sf_dir)
    out = b.kept("valuation_base", M.valuation_base(b["mart_vbt_master_dataset"]))   # read for each horizon
    s = b["dim_dcf_surface"].filter((F.col("discount_rate_pct") == DEFAULT.valuation_discount_pct)
                                    & (F.col("terminal_growth_rate_pct") == DEFAULT.valuation_terminal_pct))
    for h in DEFAULT.valuation_years:
        out = nearest_by_merge(out, "pe_ttm", s.filter(F.col("high_growth_years") == h), "implied_pe", ["growth_rate_pct", "implied_pe"],
                               {f"implied_growth_{h}y_pct": "growth_rate_pct", f"implied_pe_{h}y": "implied_pe"}, least=1000)
    return out.select("date", "ticker", "d_close", "eps_ttm", "pe_ttm", *M.VALUATION_COLS)


def _dcf_lookup(spark, sf_dir):
    """The whole M17 grid (all parameter sets), each row with the number of
    panel rows of the expectation universe (2010 on, eps_ttm > 0, 0 < pe <= 300)
    whose PE falls into its bucket."""
    b = _build(spark, sf_dir)
    m = b["mart_vbt_master_dataset"]
    used = (m.filter((F.col("date") >= F.lit(DEFAULT.panel_floor)) & F.col("d_close").isNotNull()
                     & (F.col("eps_ttm") > 0) & (F.col("pe_ttm") > 0)
                     & (F.col("pe_ttm") <= DEFAULT.expectation_pe_max))
             .groupBy(F.round(F.col("pe_ttm") * F.lit(10.0)).cast("bigint").alias("pe_x10"))
             .agg(F.count(F.lit(1)).alias("panel_rows")))
    return b["dim_dcf_lookup"].join(used, "pe_x10", "left").fillna(0, "panel_rows")


def _dcf_surface(spark, sf_dir):
    """The whole M16 grid (all parameter sets, all columns), each row with the
    number of valuation rows (eps_ttm > 0, d_close > 0) whose PE is nearest to
    its implied PE within its parameter set; one pass over the panel."""
    b = _build(spark, sf_dir)
    s = b["dim_dcf_surface"]
    index = NearestIndex(s, "implied_pe", LOOKUP_GROUP, ["growth_rate_pct"], ["growth_rate_pct"])
    pe = M.valuation_base(b["mart_vbt_master_dataset"]).select("pe_ttm")
    keys = [*LOOKUP_GROUP, "growth_rate_pct"]
    hits = (index.probe(pe, "pe_ttm", {"growth_rate_pct": "growth_rate_pct"}, how="inner")
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("panel_rows")))
    return s.join(hits, keys, "left").select(*s.columns, F.coalesce("panel_rows", F.lit(0)).cast("bigint").alias("panel_rows"))


def _stack_duplicates(spark, sf_dir):
    return Q.duplicate_keys(_build(spark, sf_dir)["int_vbt_stack"])


def _corporate_action_factors(spark, sf_dir):
    b = _build(spark, sf_dir)
    bs = b["int_balance_sheet_features"].select("ticker", "year_quarter", "year", "quarter")
    q = F.col("quarter")
    qend = F.make_date(F.col("year").cast("int"),
                       (q * 3).cast("int"),
                       F.when(q.isin(1, 4), 31).otherwise(30))
    day30 = F.make_date(F.col("year").cast("int"), (q * 3).cast("int"), F.lit(DEFAULT.eps_split_day))
    bs = bs.withColumn("quarter_end_date", qend).withColumn("eps_split_date", day30)
    acts = b.src.corporate_actions
    bs = with_action_factors(bs, acts, "quarter_end_date",
                             {"per_share_factor": "per_share_factor", "share_factor": "share_factor"})
    bs = with_action_factors(bs, acts, "eps_split_date", {"eps_per_share_factor": "per_share_factor"})
    return bs.select("ticker", "year_quarter", "quarter_end_date", "per_share_factor", "share_factor",
                     "eps_split_date", "eps_per_share_factor")


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # staging
    "raw_dates": _model("stg_daily_prices_raw"),
    "dividend_factor": _model("stg_dividend_factor"),
    "income_dedup": _model("stg_income_statement"),
    "revenue_dedup": _model("stg_monthly_revenue"),
    "balance_projection": _model("stg_balance_sheet"),
    # prices
    "adjusted_prices": _model("int_daily_prices_adjusted"),
    "adjusted_prices_in_blocks": _in_blocks("int_daily_prices_adjusted"),
    "daily_indicators_in_blocks": _in_blocks("int_daily_indicators"),
    "daily_indicators": _model("int_daily_indicators"),
    "trading_calendar": _model("trading_calendar"),
    "corporate_action_factors": _corporate_action_factors,
    # monthly revenue
    "revenue_streak": _model("int_monthly_revenue_features"),
    "month_to_quarter": _model("int_monthly_revenue_features", ["ticker", "year_month", "map_to_quarter"]),
    # financial statements
    "single_quarter": _model("int_financial_features", FIN_KEYS + [
        "q_revenue", "q_operating_income", "q_net_income", "eps", "operating_margin", "net_margin"]),
    "ttm_financials": _model("int_financial_features", FIN_KEYS + [
        "revenue_ttm", "operating_income_ttm", "net_income_ttm", "eps_ttm", "operating_margin_ttm",
        "net_margin_ttm"]),
    "margin_volatility": _model("int_financial_features", FIN_KEYS + ["ebit_volatility", "net_margin_volatility"]),
    "financial_signals": _model("int_financial_features", FIN_KEYS + [
        "EBIT_signal", "net_income_signal", "EPS_signal", "EBIT_diff_signal", "net_margin_diff_signal",
        "EBIT_vol_signal", "net_margin_vol_signal"]),
    "eps_yoy": _model("int_financial_features", FIN_KEYS + ["eps", "eps_yoy_growth"]),
    "balance_sheet_features": _model("int_balance_sheet_features"),
    # publication dating and the stack
    "revenue_deadline_align": _flat("int_monthly_revenue_shifter", {"rev_box": "rev_"}),
    "financial_deadline_align": _flat("int_financial_shifter", {"fin_box": "fin_"}),
    "balance_deadline": _flat("int_balance_sheet_shifter", {"bs_box": "bs_"}),
    "event_stack": _flat("int_vbt_stack", {"rev_box": "rev_", "fin_box": "fin_", "bs_box": "bs_"}),
    "stack_collapse": _collapse,
    # master panel
    "master_panel": _model("mart_vbt_master_dataset"),
    "master_panel_in_blocks": _in_blocks("mart_vbt_master_dataset"),
    "forward_returns": _model("mart_vbt_master_dataset", ["date", "ticker", "d_close", "ret_1d", "ret_5d",
                                                          "ret_10d", "ret_20d"]),
    "pe_pb": _model("mart_vbt_master_dataset", ["date", "ticker", "d_close", "eps_ttm",
                                                "book_value_per_share", "pe_ttm", "pb_ratio"]),
    # valuation and factors
    "valuation_nearest": _model("mart_vbt_valuation_dataset"),
    "valuation_by_merge": _valuation_by_merge,
    "valuation_pivot": _model("mart_vbt_valuation_dataset", ["date", "ticker", *M.VALUATION_COLS]),
    "factor_dataset": _model("mart_factor_dataset"),
    # expectations
    "monthly_unfill": _monthly_unfill,
    "revenue_momentum": _revenue_momentum,
    "forward_eps": _model("mart_expectation_features"),
    "expectation_dataset": _model("mart_expectation_dataset"),
    "dcf_lookup": _dcf_lookup,
    "dcf_surface": _dcf_surface,
    # data quality
    "dq_duplicate_keys": _master_check(Q.duplicate_keys),
    "dq_future_dates": _master_check(Q.future_dates),
    "dq_future_dates_as_of": _master_check(lambda df: Q.future_dates(df, as_of=CLOSING_DATE)),
    "dq_negative_volume": _master_check(Q.negative_volume),
    "dq_not_null": _master_check(Q.null_keys),
    "dq_stack_duplicate_keys": _stack_duplicates,
}


def _stable(fn):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return stabilize(fn(spark, sf_dir))
    q.__name__ = getattr(fn, "__name__", "query")
    return q


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _stable(v) for k, v in RAW.items()}
