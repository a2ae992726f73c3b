"""Generated by tools/compare.py --write-doubles: DOUBLE columns per query."""

DOUBLE_COLUMNS = {
    'raw_dates': ['open', 'high', 'low', 'close'],
    'dividend_factor': ['daily_factor'],
    'income_dedup': ['revenue', 'cost_of_goods_sold', 'gross_profit', 'unrealized_sales_gain_loss', 'realized_sales_gain_loss', 'gross_profit_net', 'operating_expenses', 'other_income_expense_net', 'operating_income', 'non_operating_income_expense', 'income_before_tax', 'income_tax_expense', 'net_income', 'eps'],
    'revenue_dedup': ['mom_growth_pct', 'yoy_growth_pct', 'ytd_growth_pct'],
    'balance_projection': ['current_assets', 'non_current_assets', 'total_assets', 'current_liabilities', 'non_current_liabilities', 'total_liabilities', 'share_capital', 'capital_surplus', 'retained_earnings', 'total_equity', 'book_value_per_share'],
    'adjusted_prices': ['open', 'high', 'low', 'close', 'adj_close'],
    'adjusted_prices_in_blocks': ['open', 'high', 'low', 'close', 'adj_close'],
    'daily_indicators': ['open', 'high', 'low', 'adj_close', 'ma20', 'ma60', 'bias20', 'day_amplitude'],
    'daily_indicators_in_blocks': ['open', 'high', 'low', 'adj_close', 'ma20', 'ma60', 'bias20', 'day_amplitude'],
    'trading_calendar': [],
    'corporate_action_factors': ['per_share_factor', 'share_factor', 'eps_per_share_factor'],
    'revenue_streak': ['mom_growth_pct', 'yoy_growth_pct', 'ytd_growth_pct', 'yoy_lag1', 'yoy_lag2'],
    'month_to_quarter': [],
    'single_quarter': ['q_revenue', 'q_operating_income', 'q_net_income', 'eps', 'operating_margin', 'net_margin'],
    'ttm_financials': ['revenue_ttm', 'operating_income_ttm', 'net_income_ttm', 'eps_ttm', 'operating_margin_ttm', 'net_margin_ttm'],
    'margin_volatility': ['ebit_volatility', 'net_margin_volatility'],
    'financial_signals': [],
    'eps_yoy': ['eps', 'eps_yoy_growth'],
    'balance_sheet_features': ['current_assets', 'non_current_assets', 'total_assets', 'current_liabilities', 'non_current_liabilities', 'total_liabilities', 'share_capital', 'capital_surplus', 'retained_earnings', 'total_equity', 'book_value_per_share', 'share_capital_ntd', 'total_assets_ntd', 'total_liabilities_ntd', 'total_equity_ntd', 'current_assets_ntd', 'current_liabilities_ntd', 'retained_earnings_ntd', 'capital_surplus_ntd', 'shares_outstanding', 'shares_outstanding_from_capital', 'shares_from_bvps', 'share_count_check_ratio', 'current_assets_ratio', 'non_current_assets_ratio', 'current_liabilities_ratio', 'non_current_liabilities_ratio', 'debt_ratio', 'equity_ratio', 'financial_leverage', 'current_ratio', 'working_capital', 'working_capital_ntd', 'working_capital_to_assets', 'working_capital_to_equity', 'retained_earnings_to_equity', 'capital_surplus_to_equity', 'share_capital_to_equity', 'liabilities_to_equity', 'assets_per_share', 'liabilities_per_share', 'equity_per_share_calc', 'retained_earnings_per_share'],
    'revenue_deadline_align': ['rev_yoy_growth_pct', 'rev_mom_growth_pct', 'rev_ytd_growth_pct'],
    'financial_deadline_align': ['fin_q_revenue', 'fin_revenue_ttm', 'fin_q_operating_income', 'fin_operating_income_ttm', 'fin_q_net_income', 'fin_net_income_ttm', 'fin_operating_margin', 'fin_operating_margin_ttm', 'fin_net_margin', 'fin_net_margin_ttm', 'fin_ebit_volatility', 'fin_net_margin_volatility', 'fin_eps', 'fin_eps_ttm', 'fin_eps_yoy_growth'],
    'balance_deadline': ['bs_current_assets', 'bs_non_current_assets', 'bs_total_assets', 'bs_current_liabilities', 'bs_non_current_liabilities', 'bs_total_liabilities', 'bs_share_capital', 'bs_share_capital_ntd', 'bs_shares_outstanding', 'bs_capital_surplus', 'bs_retained_earnings', 'bs_total_equity', 'bs_book_value_per_share', 'bs_debt_ratio', 'bs_equity_ratio', 'bs_current_ratio'],
    'event_stack': ['open', 'high', 'low', 'adj_close', 'ma20', 'ma60', 'bias20', 'day_amplitude', 'rev_yoy_growth_pct', 'rev_mom_growth_pct', 'rev_ytd_growth_pct', 'fin_q_revenue', 'fin_revenue_ttm', 'fin_q_operating_income', 'fin_operating_income_ttm', 'fin_q_net_income', 'fin_net_income_ttm', 'fin_operating_margin', 'fin_operating_margin_ttm', 'fin_net_margin', 'fin_net_margin_ttm', 'fin_ebit_volatility', 'fin_net_margin_volatility', 'fin_eps', 'fin_eps_ttm', 'fin_eps_yoy_growth', 'bs_current_assets', 'bs_non_current_assets', 'bs_total_assets', 'bs_current_liabilities', 'bs_non_current_liabilities', 'bs_total_liabilities', 'bs_share_capital', 'bs_share_capital_ntd', 'bs_shares_outstanding', 'bs_capital_surplus', 'bs_retained_earnings', 'bs_total_equity', 'bs_book_value_per_share', 'bs_debt_ratio', 'bs_equity_ratio', 'bs_current_ratio'],
    'stack_collapse': ['d_open', 'd_high', 'd_low', 'd_close', 'ma20', 'ma60', 'bias20', 'rev_yoy_growth_pct', 'rev_mom_growth_pct', 'rev_ytd_growth_pct', 'fin_q_revenue', 'fin_revenue_ttm', 'fin_q_operating_income', 'fin_operating_income_ttm', 'fin_q_net_income', 'fin_net_income_ttm', 'fin_operating_margin', 'fin_operating_margin_ttm', 'fin_net_margin', 'fin_net_margin_ttm', 'fin_ebit_volatility', 'fin_net_margin_volatility', 'fin_eps', 'fin_eps_ttm', 'fin_eps_yoy_growth', 'bs_current_assets', 'bs_non_current_assets', 'bs_total_assets', 'bs_current_liabilities', 'bs_non_current_liabilities', 'bs_total_liabilities', 'bs_share_capital', 'bs_share_capital_ntd', 'bs_shares_outstanding', 'bs_capital_surplus', 'bs_retained_earnings', 'bs_total_equity', 'bs_book_value_per_share', 'bs_debt_ratio', 'bs_equity_ratio', 'bs_current_ratio'],
    'master_panel': ['d_open', 'd_high', 'd_low', 'd_close', 'ma20', 'ma60', 'bias20', 'yoy_growth', 'mom_growth_pct', 'ytd_growth_pct', 'financial_q_revenue', 'financial_revenue_ttm', 'financial_q_operating_income', 'financial_operating_income_ttm', 'financial_q_net_income', 'financial_net_income_ttm', 'op_margin', 'operating_margin_ttm', 'net_margin', 'net_margin_ttm', 'ebit_volatility', 'net_margin_volatility', 'eps', 'eps_ttm', 'eps_yoy_growth', 'current_assets', 'non_current_assets', 'total_assets', 'current_liabilities', 'non_current_liabilities', 'total_liabilities', 'share_capital', 'share_capital_ntd', 'shares_outstanding', 'capital_surplus', 'retained_earnings', 'total_equity', 'book_value_per_share', 'debt_ratio', 'equity_ratio', 'current_ratio', 'pe_ttm', 'pb_ratio', 'ret_1d', 'ret_5d', 'ret_10d', 'ret_20d'],
    'master_panel_in_blocks': ['d_open', 'd_high', 'd_low', 'd_close', 'ma20', 'ma60', 'bias20', 'yoy_growth', 'mom_growth_pct', 'ytd_growth_pct', 'financial_q_revenue', 'financial_revenue_ttm', 'financial_q_operating_income', 'financial_operating_income_ttm', 'financial_q_net_income', 'financial_net_income_ttm', 'op_margin', 'operating_margin_ttm', 'net_margin', 'net_margin_ttm', 'ebit_volatility', 'net_margin_volatility', 'eps', 'eps_ttm', 'eps_yoy_growth', 'current_assets', 'non_current_assets', 'total_assets', 'current_liabilities', 'non_current_liabilities', 'total_liabilities', 'share_capital', 'share_capital_ntd', 'shares_outstanding', 'capital_surplus', 'retained_earnings', 'total_equity', 'book_value_per_share', 'debt_ratio', 'equity_ratio', 'current_ratio', 'pe_ttm', 'pb_ratio', 'ret_1d', 'ret_5d', 'ret_10d', 'ret_20d'],
    'forward_returns': ['d_close', 'ret_1d', 'ret_5d', 'ret_10d', 'ret_20d'],
    'pe_pb': ['d_close', 'eps_ttm', 'book_value_per_share', 'pe_ttm', 'pb_ratio'],
    'valuation_nearest': ['d_close', 'eps_ttm', 'pe_ttm', 'implied_pe_3y', 'implied_pe_5y', 'implied_pe_10y'],
    'valuation_by_merge': ['d_close', 'eps_ttm', 'pe_ttm', 'implied_pe_3y', 'implied_pe_5y', 'implied_pe_10y'],
    'valuation_pivot': ['implied_pe_3y', 'implied_pe_5y', 'implied_pe_10y'],
    'factor_dataset': ['d_open', 'd_high', 'd_low', 'd_close', 'ma20', 'ma60', 'bias20', 'price_ma20_gap', 'price_ma60_gap', 'yoy_growth', 'mom_growth_pct', 'ytd_growth_pct', 'eps', 'eps_ttm', 'eps_yoy_growth', 'op_margin', 'pe_ttm', 'implied_pe_3y', 'implied_pe_5y', 'implied_pe_10y', 'ret_1d', 'ret_5d', 'ret_10d', 'ret_20d'],
    'monthly_unfill': ['yoy_growth'],
    'revenue_momentum': ['yoy_growth', 'revenue_yoy_3m_avg', 'revenue_yoy_6m_avg', 'revenue_acceleration', 'expected_revenue_growth'],
    'forward_eps': ['d_close', 'eps', 'eps_ttm', 'pe_ttm', 'pb_ratio', 'revenue_yoy_3m_avg', 'revenue_yoy_6m_avg', 'revenue_acceleration', 'expected_revenue_growth', 'financial_q_revenue', 'financial_revenue_ttm', 'financial_q_operating_income', 'financial_operating_income_ttm', 'financial_q_net_income', 'financial_net_income_ttm', 'op_margin', 'operating_margin_ttm', 'net_margin', 'net_margin_ttm', 'ebit_volatility', 'net_margin_volatility', 'shares_outstanding', 'book_value_per_share', 'debt_ratio', 'equity_ratio', 'current_ratio', 'forward_revenue_ttm', 'forward_net_income', 'forward_eps', 'forward_constant_growth'],
    'expectation_dataset': ['d_close', 'eps', 'eps_ttm', 'pe_ttm', 'pe_rounded', 'pb_ratio', 'revenue_yoy_3m_avg', 'revenue_yoy_6m_avg', 'revenue_acceleration', 'expected_revenue_growth', 'financial_q_revenue', 'financial_revenue_ttm', 'financial_q_operating_income', 'financial_operating_income_ttm', 'financial_q_net_income', 'financial_net_income_ttm', 'op_margin', 'operating_margin_ttm', 'net_margin', 'net_margin_ttm', 'ebit_volatility', 'net_margin_volatility', 'shares_outstanding', 'book_value_per_share', 'debt_ratio', 'equity_ratio', 'current_ratio', 'forward_revenue_ttm', 'forward_net_income', 'forward_eps', 'forward_constant_growth', 'implied_growth', 'implied_pe', 'pe_diff', 'expectation_gap'],
    'dcf_lookup': ['pe_rounded', 'implied_growth', 'implied_pe', 'pe_diff'],
    'dcf_surface': ['growth_rate', 'discount_rate', 'terminal_growth_rate', 'explicit_pe_multiplier', 'terminal_pe_multiplier', 'implied_pe'],
    'dq_duplicate_keys': [],
    'dq_future_dates': ['d_open', 'd_high', 'd_low', 'd_close', 'ma20', 'ma60', 'bias20', 'yoy_growth', 'mom_growth_pct', 'ytd_growth_pct', 'financial_q_revenue', 'financial_revenue_ttm', 'financial_q_operating_income', 'financial_operating_income_ttm', 'financial_q_net_income', 'financial_net_income_ttm', 'op_margin', 'operating_margin_ttm', 'net_margin', 'net_margin_ttm', 'ebit_volatility', 'net_margin_volatility', 'eps', 'eps_ttm', 'eps_yoy_growth', 'current_assets', 'non_current_assets', 'total_assets', 'current_liabilities', 'non_current_liabilities', 'total_liabilities', 'share_capital', 'share_capital_ntd', 'shares_outstanding', 'capital_surplus', 'retained_earnings', 'total_equity', 'book_value_per_share', 'debt_ratio', 'equity_ratio', 'current_ratio', 'pe_ttm', 'pb_ratio', 'ret_1d', 'ret_5d', 'ret_10d', 'ret_20d'],
    'dq_future_dates_as_of': ['d_open', 'd_high', 'd_low', 'd_close', 'ma20', 'ma60', 'bias20', 'yoy_growth', 'mom_growth_pct', 'ytd_growth_pct', 'financial_q_revenue', 'financial_revenue_ttm', 'financial_q_operating_income', 'financial_operating_income_ttm', 'financial_q_net_income', 'financial_net_income_ttm', 'op_margin', 'operating_margin_ttm', 'net_margin', 'net_margin_ttm', 'ebit_volatility', 'net_margin_volatility', 'eps', 'eps_ttm', 'eps_yoy_growth', 'current_assets', 'non_current_assets', 'total_assets', 'current_liabilities', 'non_current_liabilities', 'total_liabilities', 'share_capital', 'share_capital_ntd', 'shares_outstanding', 'capital_surplus', 'retained_earnings', 'total_equity', 'book_value_per_share', 'debt_ratio', 'equity_ratio', 'current_ratio', 'pe_ttm', 'pb_ratio', 'ret_1d', 'ret_5d', 'ret_10d', 'ret_20d'],
    'dq_negative_volume': ['d_open', 'd_high', 'd_low', 'd_close', 'ma20', 'ma60', 'bias20', 'yoy_growth', 'mom_growth_pct', 'ytd_growth_pct', 'financial_q_revenue', 'financial_revenue_ttm', 'financial_q_operating_income', 'financial_operating_income_ttm', 'financial_q_net_income', 'financial_net_income_ttm', 'op_margin', 'operating_margin_ttm', 'net_margin', 'net_margin_ttm', 'ebit_volatility', 'net_margin_volatility', 'eps', 'eps_ttm', 'eps_yoy_growth', 'current_assets', 'non_current_assets', 'total_assets', 'current_liabilities', 'non_current_liabilities', 'total_liabilities', 'share_capital', 'share_capital_ntd', 'shares_outstanding', 'capital_surplus', 'retained_earnings', 'total_equity', 'book_value_per_share', 'debt_ratio', 'equity_ratio', 'current_ratio', 'pe_ttm', 'pb_ratio', 'ret_1d', 'ret_5d', 'ret_10d', 'ret_20d'],
    'dq_not_null': ['d_open', 'd_high', 'd_low', 'd_close', 'ma20', 'ma60', 'bias20', 'yoy_growth', 'mom_growth_pct', 'ytd_growth_pct', 'financial_q_revenue', 'financial_revenue_ttm', 'financial_q_operating_income', 'financial_operating_income_ttm', 'financial_q_net_income', 'financial_net_income_ttm', 'op_margin', 'operating_margin_ttm', 'net_margin', 'net_margin_ttm', 'ebit_volatility', 'net_margin_volatility', 'eps', 'eps_ttm', 'eps_yoy_growth', 'current_assets', 'non_current_assets', 'total_assets', 'current_liabilities', 'non_current_liabilities', 'total_liabilities', 'share_capital', 'share_capital_ntd', 'shares_outstanding', 'capital_surplus', 'retained_earnings', 'total_equity', 'book_value_per_share', 'debt_ratio', 'equity_ratio', 'current_ratio', 'pe_ttm', 'pb_ratio', 'ret_1d', 'ret_5d', 'ret_10d', 'ret_20d'],
    'dq_stack_duplicate_keys': [],
}
