"""Every constant the pipeline uses, with the reference's value as default.

The values here are *fixed values* that must equal the reference's for the
results to match (date floors, window lengths, publication deadlines, DCF grid,
thresholds).  Change them only to run a what-if, never to make a check pass.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class PanelConfig:
    # --- fixed values: date floors -------------------------------------------
    dividend_floor: dt.date = dt.date(2000, 1, 1)     # dividends kept from
    price_floor: dt.date = dt.date(2000, 1, 1)        # adjusted prices kept from
    indicator_floor: dt.date = dt.date(2009, 1, 1)    # rolling indicators start
    panel_floor: dt.date = dt.date(2010, 1, 1)        # master / factor panels start

    # --- fixed values: daily indicators ---------------------------------------
    ma_short: int = 20
    ma_long: int = 60

    # --- fixed values: publication deadlines (month, day) ----------------------
    # monthly revenue: 11th of the following month (= +1 month, +10 days)
    revenue_deadline_months: int = 1
    revenue_deadline_days: int = 10
    # income statement: Q1 05-16, Q2 08-15, Q3 11-15, otherwise next year 04-01
    income_deadlines: tuple = ((1, 5, 16), (2, 8, 15), (3, 11, 15))
    income_q4_deadline: tuple = (4, 1)
    # balance sheet: Q1 05-16, Q2 08-16, Q3 11-15, Q4 next year 04-01
    balance_deadlines: tuple = ((1, 5, 16), (2, 8, 16), (3, 11, 15))
    balance_q4_deadline: tuple = (4, 1)

    # --- fixed values: financial features --------------------------------------
    ttm_quarters: int = 4
    volatility_quarters: int = 4
    min_margin_quarters: int = 8
    eps_yoy_lag: int = 4
    volatility_threshold: float = 0.05
    eps_split_day: int = 30          # quarter-end day used for EPS split factors

    # --- fixed values: balance sheet ----------------------------------------------
    unit_ntd: int = 1000              # statements are in thousands of NTD
    par_value: float = 10.0
    share_ratio_low: float = 0.8
    share_ratio_high: float = 1.2
    balance_tolerance: float = 0.05

    # --- fixed values: forward returns ----------------------------------------------
    lead_days: tuple = (1, 5, 10, 20)

    # --- fixed values: DCF surface --------------------------------------------------
    growth_pct_lo: int = -20
    growth_pct_hi: int = 300
    discount_pcts: tuple = (8, 10, 12)
    terminal_pcts: tuple = (2,)
    high_growth_years: tuple = (3, 5, 10)
    estimate_years: tuple = (10,)
    pe_x10_lo: int = 1
    pe_x10_hi: int = 3000

    # --- fixed values: valuation / expectation ---------------------------------------
    valuation_discount_pct: int = 10
    valuation_terminal_pct: int = 2
    valuation_years: tuple = (3, 5, 10)
    expectation_years: int = 5
    expectation_pe_max: float = 300.0
    upper_bound_growth_pct: int = 500     # Quirk 7: grid stops at 300, so never hit
    lower_bound_growth_pct: int = -20
    yoy_short_months: int = 3
    yoy_long_months: int = 6
    revenue_ttm_months: int = 12
    expected_growth_floor: float = -0.5
    expected_growth_cap: float = 1.0
    acceleration_weight: float = 0.5
    forward_growth_high: float = 0.3
    forward_growth_mid: float = 0.1
    gap_high: float = 0.2
    gap_mid: float = 0.0

    # --- fixed values: data-quality ----------------------------------------------------
    market_time_zone: str = "Asia/Taipei"

    # --- execution knobs (not semantics) ------------------------------------------------
    # a ticker with more rows (and more than 1 in block_pieces of all rows) is cut into blocks
    block_rows: int = 1 << 16
    block_pieces: int = 1 << 14
    # price rows of a task of the windows over tickers, and the least number of such tasks
    task_rows: int = 100_000
    least_tasks: int = 8
    extra: dict = field(default_factory=dict, compare=False, hash=False)


DEFAULT = PanelConfig()
