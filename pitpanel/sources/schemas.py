"""Explicit schemas: the reference declares no source columns, so these are
the columns its models read (never infer a schema: tickers such as ``0050``
would turn into integers)."""

from pyspark.sql import types as T

S, D, L = T.StringType(), T.DoubleType(), T.LongType()

# --- fixed values: source column names as the models read them ---


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


DAILY_PRICES = _st(("ticker", S), ("date", S), ("open", D), ("high", D), ("low", D),
                   ("close", D), ("volume", L))

DIVIDEND = _st(("ticker", S), ("ex_dividend_date", T.DateType()),
               ("reference_price_ex_dividend", S), ("close_price_pre_adjust", S))

MONTHLY_REVENUE = _st(("ticker", S), ("company_name", S), ("year_month", S),
                      ("revenue", L), ("revenue_prev_month", S), ("revenue_last_year", L),
                      ("mom_growth_pct", S), ("yoy_growth_pct", S), ("revenue_ytd", L),
                      ("revenue_ytd_last_year", L), ("ytd_growth_pct", S))

INCOME_MEASURES = ("revenue", "cost_of_goods_sold", "gross_profit", "unrealized_sales_gain_loss",
                   "realized_sales_gain_loss", "gross_profit_net", "operating_expenses",
                   "other_income_expense_net", "operating_income", "non_operating_income_expense",
                   "income_before_tax", "income_tax_expense", "net_income", "eps")
INCOME_STATEMENT = _st(("ticker", S), ("company_name", S), ("year_quarter", S),
                       *[(m, S) for m in INCOME_MEASURES])

BALANCE_MEASURES = ("current_assets", "non_current_assets", "total_assets",
                    "current_liabilities", "non_current_liabilities", "total_liabilities",
                    "share_capital", "capital_surplus", "retained_earnings", "total_equity",
                    "book_value_per_share")
BALANCE_SHEET = _st(("ticker", S), ("company_name", S), *[(m, S) for m in BALANCE_MEASURES],
                    ("year_quarter", S))

CORPORATE_ACTIONS = _st(("ticker", S), ("effective_date", T.DateType()), ("price_factor", D),
                        ("per_share_factor", D), ("share_factor", D), ("note", S))

# --- fixed values: report boxes (field order and types are part of the contract) ---
REV_BOX_FIELDS = (("revenue", L), ("yoy_growth_pct", D), ("mom_growth_pct", D),
                  ("ytd_growth_pct", D), ("yoy_triple_increase_signal", L),
                  ("yoy_positive_streak_count", L), ("data_month_label", S))

FIN_BOX_FIELDS = tuple((n, D) for n in (
    "q_revenue", "revenue_ttm", "q_operating_income", "operating_income_ttm", "q_net_income",
    "net_income_ttm", "operating_margin", "operating_margin_ttm", "net_margin", "net_margin_ttm",
    "ebit_volatility", "net_margin_volatility", "eps", "eps_ttm", "eps_yoy_growth")) + tuple(
    (n, L) for n in ("EBIT_signal", "net_income_signal", "EPS_signal", "EBIT_diff_signal",
                     "net_margin_diff_signal", "EBIT_vol_signal", "net_margin_vol_signal")) + (
    ("year_quarter", S),)

BS_BOX_FIELDS = tuple((n, D) for n in (
    "current_assets", "non_current_assets", "total_assets", "current_liabilities",
    "non_current_liabilities", "total_liabilities", "share_capital", "share_capital_ntd",
    "shares_outstanding", "capital_surplus", "retained_earnings", "total_equity",
    "book_value_per_share", "debt_ratio", "equity_ratio", "current_ratio")) + (("year_quarter", S),)

REV_BOX = _st(*REV_BOX_FIELDS)
FIN_BOX = _st(*FIN_BOX_FIELDS)
BS_BOX = _st(*BS_BOX_FIELDS)

# --- fixed values: master-panel column name of each box field after the forward fill ---
REV_FILL_NAMES = {"revenue": "revenue", "yoy_growth_pct": "yoy_growth",
                  "mom_growth_pct": "mom_growth_pct", "ytd_growth_pct": "ytd_growth_pct",
                  "yoy_positive_streak_count": "yoy_positive_streak_count",
                  "yoy_triple_increase_signal": "rev_triple_sig",
                  "data_month_label": "revenue_month"}
FIN_FILL_NAMES = {"q_revenue": "financial_q_revenue", "revenue_ttm": "financial_revenue_ttm",
                  "q_operating_income": "financial_q_operating_income",
                  "operating_income_ttm": "financial_operating_income_ttm",
                  "q_net_income": "financial_q_net_income",
                  "net_income_ttm": "financial_net_income_ttm",
                  "operating_margin": "op_margin", "operating_margin_ttm": "operating_margin_ttm",
                  "net_margin": "net_margin", "net_margin_ttm": "net_margin_ttm",
                  "ebit_volatility": "ebit_volatility",
                  "net_margin_volatility": "net_margin_volatility", "eps": "eps",
                  "eps_ttm": "eps_ttm", "eps_yoy_growth": "eps_yoy_growth",
                  "EBIT_signal": "EBIT_signal", "net_income_signal": "net_income_signal",
                  "EPS_signal": "EPS_signal", "EBIT_diff_signal": "EBIT_diff_signal",
                  "net_margin_diff_signal": "net_margin_diff_signal",
                  "EBIT_vol_signal": "EBIT_vol_signal",
                  "net_margin_vol_signal": "net_margin_vol_signal",
                  "year_quarter": "report_quarter"}
BS_FILL_NAMES = {n: n for n, _ in BS_BOX_FIELDS}
BS_FILL_NAMES["year_quarter"] = "balance_sheet_quarter"
