"""Intermediate models M6-M14: adjusted prices, indicators, report features,
publication-deadline dating and the point-in-time event stack."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.config import DEFAULT, PanelConfig
from pitpanel.functions import exprs as X
from pitpanel.operators import windows as W
from pitpanel.operators.actions import with_action_factors
from pitpanel.operators.calendar import TradingDayMap, align_to_calendar
from pitpanel.operators.segments import BLOCK, Blocks
from pitpanel.sources import schemas


# --------------------------------------------------------------------------- M6
def price_blocks(prices: DataFrame, cfg: PanelConfig = DEFAULT) -> Blocks:
    """Blocks of the tickers with very many price rows (none in usual data)."""
    return Blocks(prices.filter(F.col("date") >= F.lit(cfg.price_floor)), cfg.ma_long, cfg.block_rows, cfg.block_pieces)


def _tag(df: DataFrame, blocks: Blocks | None) -> DataFrame:
    return df.withColumn(BLOCK, F.lit(0)) if blocks is None else blocks.tag(df)


KEYS = ["ticker", BLOCK]


def spread(df: DataFrame, tasks: int | None) -> DataFrame:
    """``df`` hash-partitioned for windows over (ticker, block): into ``tasks`` parts, or as the session says."""
    return df.repartition(*KEYS) if tasks is None else df.repartition(tasks, *KEYS)


def int_daily_prices_adjusted(prices: DataFrame, dividends: DataFrame, actions: DataFrame,
                              cfg: PanelConfig = DEFAULT, blocks: Blocks | None = None, tasks: int | None = None) -> DataFrame:
    """M6: adj_close = close x (product of dividend factors on this and later
    ex-dates) x (product of split price factors effective strictly later).

    The left join prices x dividends on (ticker, date) is done inside the
    single hash exchange on (ticker, block) that the reverse product needs
    anyway: dividend rows (identical copies pre-aggregated with a count) are
    unioned with the price rows, each day's distinct factors are collected over
    a (ticker, date) window (satisfied by the partitioning) and
    ``explode_outer`` + the copy count reproduce the join's fan-out for a
    repeated ex-date (Quirk 1; no factor -> 1.0).  So prices shuffle once
    whatever the size of the dividend table (a sort-merge join would shuffle
    them twice once dividends outgrow a broadcast).  Split factors come from a
    step table joined on the ticker.

    The product runs within blocks; the log sum of the blocks after it (one
    row a block, combined before their shuffle) stands before a block's rows
    and completes it for tickers that ``blocks`` cuts."""
    p = prices.filter(F.col("date") >= F.lit(cfg.price_floor)).withColumn("_is_price", F.lit(True))
    # identical dividend copies are pre-aggregated (partial aggregation before
    # the shuffle), so the per-day list below holds distinct factors only and
    # stays small however many copies a (ticker, ex_date) has
    d = (dividends.filter(F.col("ticker").isNotNull() & F.col("ex_date").isNotNull())
         .groupBy("ticker", "ex_date", "daily_factor").agg(F.count(F.lit(1)).alias("_n"))
         .select("ticker", F.col("ex_date").alias("date"),
                 F.struct(F.col("daily_factor").alias("f"), F.col("_n").alias("n")).alias("_div"),
                 F.lit(False).alias("_is_price")))
    u = _tag(p.unionByName(d, allowMissingColumns=True), blocks).withColumn("_later", F.lit(None).cast("double"))
    if blocks is not None:   # rows without a date
        u = u.unionByName(_later_log_sums(p, d, blocks), allowMissingColumns=True)
    u = spread(u, tasks)
    u = u.withColumn("_divs", F.collect_list("_div").over(Window.partitionBy(*KEYS, "date")))
    j = u.filter(F.col("_is_price") | F.col("_later").isNotNull()).withColumn("_d", F.explode_outer("_divs"))
    # one row per dividend copy, as the join fans out (copies of one factor are
    # interchangeable, so they are regenerated from the count)
    j = j.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"),
                                                   F.coalesce(F.col("_d.n"), F.lit(1).cast("bigint")))))
    j = j.withColumn("daily_factor", F.coalesce(F.col("_d.f"), F.lit(1.0)))
    # ties on date only arise from duplicated dividends; break them by factor
    # (NULL where no row so far has a logarithm, as in one sum over all of them)
    order = [F.col("date").desc_nulls_first(), F.col("daily_factor").asc()]
    j = j.withColumn("_ln", W.reverse_log_sum("daily_factor", order, KEYS, "_later")).filter("_is_price")
    j = with_action_factors(j, actions, "date", {"_split": "price_factor"})
    return j.select(*prices.columns, (F.col("close") * F.exp("_ln") * F.col("_split")).alias("adj_close"))


def _later_log_sums(prices: DataFrame, dividends: DataFrame, blocks: Blocks) -> DataFrame:
    """``ticker, _block, _later, _is_price``: log sums of all joined rows after a block (no row where there is none).

    A day's joined rows are its price rows times its dividend rows, so counts
    and sums by day suffice; both combine before the shuffle."""
    logs = dividends.select("ticker", "date", F.lit(0).cast("bigint").alias("_c"), F.col("_div.n").alias("_m"),
                            (F.col("_div.n") * F.ln(F.col("_div.f"))).alias("_l"))
    bars = prices.select("ticker", "date", F.lit(1).cast("bigint").alias("_c"), F.lit(0).cast("bigint").alias("_m"),
                         F.lit(None).cast("double").alias("_l"))
    days = (blocks.cut(bars, logs).groupBy(*KEYS, "date")
            .agg(F.sum("_c").alias("_c"), F.sum("_m").alias("_m"), F.sum("_l").alias("_l")))
    day = F.when(F.col("_m") == 0, F.lit(0.0)).otherwise(F.col("_c") * F.col("_l"))   # no dividend: factor 1.0
    sums = days.filter("_c > 0").groupBy(*KEYS).agg(F.sum(day).alias("_sum"))
    return blocks.later_sum(sums, "_sum", "_later").filter("_later IS NOT NULL").withColumn("_is_price", F.lit(False))


# --------------------------------------------------------------------------- M7
def int_daily_indicators(adjusted: DataFrame, cfg: PanelConfig = DEFAULT, blocks: Blocks | None = None,
                         tasks: int | None = None) -> DataFrame:
    """M7: ma20, ma60, bias20 and day amplitude from the indicator floor on
    (the floor is applied before the windows, so warm-up starts there).

    A block that ``blocks`` cuts off takes the last 59 rows before it along."""
    a = adjusted.filter(F.col("date") >= F.lit(cfg.indicator_floor))
    own = _tag(a, blocks).withColumn("_own", F.lit(True))
    if blocks is not None:
        own = own.unionByName(halo_rows(a.select("date", "ticker", "adj_close"), blocks, cfg), allowMissingColumns=True)
    a = spread(own, tasks)
    order = [F.col("date"), F.col("adj_close")]
    ma20 = W.rolling_mean("adj_close", order, cfg.ma_short, KEYS)
    out = a.select(
        "date", "ticker", "open", "high", "low", "adj_close", "volume",
        ma20.alias("ma20"),
        W.rolling_mean("adj_close", order, cfg.ma_long, KEYS).alias("ma60"),
        X.safe_div(F.col("adj_close") - ma20, ma20).alias("bias20"),
        X.safe_div(F.col("high") - F.col("low"), "low").alias("day_amplitude"), "_own")
    return out.filter("_own").drop("_own")


def halo_rows(daily: DataFrame, blocks: Blocks, cfg: PanelConfig = DEFAULT) -> DataFrame:
    """The daily rows that the longest rolling mean looks back to from the next block."""
    rows = blocks.last_rows(blocks.cut(daily), cfg.ma_long - 1, [F.col("date").desc(), F.col("adj_close").desc()])
    return rows.withColumn("_own", F.lit(False))


# --------------------------------------------------------------------------- M8
def int_monthly_revenue_features(rev: DataFrame) -> DataFrame:
    """M8: YoY-positive streak length (gaps and islands), triple-increase
    signal, two YoY lags and the month -> last published quarter label."""
    w = W.by_key("year_month")
    yoy = F.col("yoy_growth_pct")
    b = rev.withColumn("_pos", X.flag(X.greater(yoy, 0)))
    b = (b.withColumn("_chg", X.flag(F.col("_pos") != F.lag("_pos").over(w)))
          .withColumn("yoy_lag1", F.lag(yoy, 1).over(w))
          .withColumn("yoy_lag2", F.lag(yoy, 2).over(w)))
    b = b.withColumn("_streak", F.coalesce(F.sum("_chg").over(w), F.lit(0)))
    in_streak = Window.partitionBy("ticker", "_streak").orderBy("year_month")
    b = b.withColumn("yoy_positive_streak_count",
                     F.when(F.col("_pos") == 1, F.row_number().over(in_streak)).otherwise(0).cast("bigint"))
    b = b.withColumn("yoy_triple_increase_signal",
                     X.flag(X.greater(yoy, F.col("yoy_lag1")) & X.greater("yoy_lag1", F.col("yoy_lag2"))))
    return b.drop("_pos", "_chg", "_streak").withColumn("map_to_quarter", X.month_to_quarter("year_month"))


# --------------------------------------------------------------------------- M9
REV_BOX_COLS = [n for n, _ in schemas.REV_BOX_FIELDS]
FIN_BOX_COLS = [n for n, _ in schemas.FIN_BOX_FIELDS]
BS_BOX_COLS = [n for n, _ in schemas.BS_BOX_FIELDS]


def revenue_deadline(ym, cfg: PanelConfig = DEFAULT) -> F.Column:
    """11th of the following month (strict parse of year and month)."""
    return F.date_add(F.add_months(X.month_start(ym), cfg.revenue_deadline_months),
                      cfg.revenue_deadline_days)


def int_monthly_revenue_shifter(features: DataFrame, days: TradingDayMap,
                                cfg: PanelConfig = DEFAULT) -> DataFrame:
    """M9: each month's rev_box dated at the first trading day on or after its
    deadline (a box with a NULL field keeps the raw deadline, trap T1)."""
    box = F.struct(*[F.col(c) for c in REV_BOX_COLS[:-1]], F.col("year_month").alias("data_month_label"))
    ev = features.select(revenue_deadline("year_month", cfg).alias("deadline_date"), "ticker", box.alias("rev_box"))
    return align_to_calendar(ev, days, "rev_box", REV_BOX_COLS)


# --------------------------------------------------------------------------- M10
def int_financial_features(income: DataFrame, actions: DataFrame, cfg: PanelConfig = DEFAULT) -> DataFrame:
    """YTD -> single quarter, margins, TTM sums (only over 4 present
    quarters), margin volatility and minimum, seven 0/1 signals, EPS YoY.

    EPS is split-adjusted with the per-share factors of actions effective
    after day 30 of the quarter-end month (Quirk 10)."""
    yq = F.col("year_quarter")
    qmonth = F.col("year_quarter").substr(-1, 1).try_cast("bigint") * 3
    qdate = X.make_date_or_null(F.substring(yq, 1, 4).try_cast("bigint"),
                                F.when(qmonth.isin(3, 6, 9, 12), qmonth), F.lit(cfg.eps_split_day))
    b = income.select("ticker", "year_quarter", F.substring(yq, 1, 4).alias("_year"),
                      F.substring(yq, -1, 1).alias("_q"), "revenue", "operating_income",
                      "net_income", "eps", qdate.alias("_qdate"))
    b = with_action_factors(b, actions, "_qdate", {"_psf": "per_share_factor"})
    b = b.withColumn("eps", F.col("eps") * F.col("_psf"))
    # LAG within (ticker, year) == ticker-wide LAG when the previous row is of
    # the same year, else NULL; written that way so every window of this model
    # shares the ticker partitioning (one exchange instead of two)
    by_ticker = W.by_key(["year_quarter"])
    same_year = F.lag("_year").over(by_ticker) == F.col("_year")
    single = {}
    for src, dst in (("revenue", "q_revenue"), ("operating_income", "q_operating_income"),
                     ("net_income", "q_net_income"), ("eps", "q_eps")):
        prev = F.when(same_year, F.lag(src).over(by_ticker))
        single[dst] = F.when(F.col("_q") == "1", F.col(src)).otherwise(F.col(src) - prev)
    b = b.select("ticker", "year_quarter", *[v.alias(k) for k, v in single.items()])
    b = (b.withColumn("operating_margin", X.safe_div("q_operating_income", X.nullif("q_revenue", 0)))
          .withColumn("net_margin", X.safe_div("q_net_income", X.nullif("q_revenue", 0))))
    order = "year_quarter"
    w = W.by_key(order)
    vol = W.trailing_rows(order, cfg.volatility_quarters)
    mn = W.trailing_rows(order, cfg.min_margin_quarters)
    b = b.select(
        "*",
        F.stddev_samp("operating_margin").over(vol).alias("ebit_volatility"),
        F.stddev_samp("net_margin").over(vol).alias("net_margin_volatility"),
        F.min("operating_margin").over(mn).alias("_min_op"),
        F.min("net_margin").over(mn).alias("_min_net"),
        F.lag("operating_margin").over(w).alias("_prev_op"),
        F.lag("net_margin").over(w).alias("_prev_net"),
        F.lag("q_eps", cfg.eps_yoy_lag).over(w).alias("_eps_ly"),
        *[W.gated_sum(c, order, cfg.ttm_quarters).alias(t) for c, t in (
            ("q_revenue", "revenue_ttm"), ("q_operating_income", "operating_income_ttm"),
            ("q_net_income", "net_income_ttm"), ("q_eps", "eps_ttm"))])
    th = cfg.volatility_threshold
    return b.select(
        "ticker", "year_quarter", "q_revenue", "revenue_ttm", "q_operating_income",
        "operating_income_ttm", "q_net_income", "net_income_ttm", "operating_margin",
        X.safe_div("operating_income_ttm", X.nullif("revenue_ttm", 0)).alias("operating_margin_ttm"),
        "net_margin",
        X.safe_div("net_income_ttm", X.nullif("revenue_ttm", 0)).alias("net_margin_ttm"),
        "ebit_volatility", "net_margin_volatility",
        F.col("q_eps").alias("eps"), "eps_ttm",
        (X.safe_div("q_eps", X.nullif("_eps_ly", 0)) - F.lit(1.0)).alias("eps_yoy_growth"),
        X.flag(X.greater("_min_op", 0)).alias("EBIT_signal"),
        X.flag(X.greater("_min_net", 0)).alias("net_income_signal"),
        X.flag(X.greater("q_eps", 0)).alias("EPS_signal"),
        X.flag(X.greater("operating_margin", F.col("_prev_op"))).alias("EBIT_diff_signal"),
        X.flag(X.greater("net_margin", F.col("_prev_net"))).alias("net_margin_diff_signal"),
        X.flag(F.col("ebit_volatility") < th).alias("EBIT_vol_signal"),
        X.flag(F.col("net_margin_volatility") < th).alias("net_margin_vol_signal"))


# --------------------------------------------------------------------------- M11
def income_deadline(yq, cfg: PanelConfig = DEFAULT) -> F.Column:
    """Q1 05-16, Q2 08-15, Q3 11-15, anything else next year's 04-01
    (strict: a malformed year fails the job like PARSE_DATE)."""
    year = F.substring(yq, 1, 4).cast("int")
    s = F.col(yq) if isinstance(yq, str) else yq
    out = None
    for q, m, d in cfg.income_deadlines:
        cond = s.endswith(f"-{q}")
        val = F.make_date(year, F.lit(m), F.lit(d))
        out = F.when(cond, val) if out is None else out.when(cond, val)
    m4, d4 = cfg.income_q4_deadline
    return out.otherwise(F.make_date(year + 1, F.lit(m4), F.lit(d4)))


def int_financial_shifter(features: DataFrame, days: TradingDayMap, cfg: PanelConfig = DEFAULT) -> DataFrame:
    """fin_box dated at the first trading day on or after the deadline."""
    box = F.struct(*[F.col(c) for c in FIN_BOX_COLS])
    ev = features.select("ticker", income_deadline("year_quarter", cfg).alias("deadline_date"),
                         box.alias("fin_box"))
    return align_to_calendar(ev, days, "fin_box", FIN_BOX_COLS)


# --------------------------------------------------------------------------- M12
def int_balance_sheet_features(bs: DataFrame, actions: DataFrame, cfg: PanelConfig = DEFAULT) -> DataFrame:
    """NTD amounts, split-adjusted BVPS, share counts by two methods,
    ratios, per-share values and three validity flags (51 columns)."""
    b = bs.select("ticker", "company_name",
                  *[X.safe_double(m, bs.schema[m].dataType).alias(m) for m in schemas.BALANCE_MEASURES],
                  "year_quarter")
    year, quarter = X.year_quarter_parts("year_quarter")
    b = b.withColumn("year", year).withColumn("quarter", quarter)
    q = F.col("quarter")
    qend = X.make_date_or_null(
        F.col("year"),
        F.when(q == 1, 3).when(q == 2, 6).when(q == 3, 9).when(q == 4, 12),
        F.when(q == 1, 31).when(q == 2, 30).when(q == 3, 30).when(q == 4, 31))
    b = with_action_factors(b, actions, qend, {"_psf": "per_share_factor", "_sf": "share_factor"})
    unit = F.lit(float(cfg.unit_ntd))
    c = F.col
    adj_bvps = c("book_value_per_share") * c("_psf")
    b = (b.withColumn("_adj_bvps", adj_bvps)
          .withColumn("_sh_cap", X.safe_div(c("share_capital") * unit, F.lit(cfg.par_value)) * c("_sf"))
          .withColumn("_sh_bvps", X.safe_div(c("total_equity") * unit, c("_adj_bvps"))))
    ratio = X.safe_div("_sh_cap", "_sh_bvps")
    wc = c("current_assets") - c("current_liabilities")
    return b.select(
        "ticker", "company_name", "year", "quarter", "year_quarter",
        "current_assets", "non_current_assets", "total_assets",
        "current_liabilities", "non_current_liabilities", "total_liabilities",
        "share_capital", "capital_surplus", "retained_earnings", "total_equity",
        c("_adj_bvps").alias("book_value_per_share"),
        *[(c(m) * unit).alias(f"{m}_ntd") for m in (
            "share_capital", "total_assets", "total_liabilities", "total_equity", "current_assets",
            "current_liabilities", "retained_earnings", "capital_surplus")],
        c("_sh_bvps").alias("shares_outstanding"),
        c("_sh_cap").alias("shares_outstanding_from_capital"),
        c("_sh_bvps").alias("shares_from_bvps"),
        ratio.alias("share_count_check_ratio"),
        X.safe_div("current_assets", "total_assets").alias("current_assets_ratio"),
        X.safe_div("non_current_assets", "total_assets").alias("non_current_assets_ratio"),
        X.safe_div("current_liabilities", "total_liabilities").alias("current_liabilities_ratio"),
        X.safe_div("non_current_liabilities", "total_liabilities").alias("non_current_liabilities_ratio"),
        X.safe_div("total_liabilities", "total_assets").alias("debt_ratio"),
        X.safe_div("total_equity", "total_assets").alias("equity_ratio"),
        X.safe_div("total_assets", "total_equity").alias("financial_leverage"),
        X.safe_div("current_assets", "current_liabilities").alias("current_ratio"),
        wc.alias("working_capital"), (wc * unit).alias("working_capital_ntd"),
        X.safe_div(wc, "total_assets").alias("working_capital_to_assets"),
        X.safe_div(wc, "total_equity").alias("working_capital_to_equity"),
        X.safe_div("retained_earnings", "total_equity").alias("retained_earnings_to_equity"),
        X.safe_div("capital_surplus", "total_equity").alias("capital_surplus_to_equity"),
        X.safe_div("share_capital", "total_equity").alias("share_capital_to_equity"),
        X.safe_div("total_liabilities", "total_equity").alias("liabilities_to_equity"),
        X.safe_div(c("total_assets") * unit, "_sh_bvps").alias("assets_per_share"),
        X.safe_div(c("total_liabilities") * unit, "_sh_bvps").alias("liabilities_per_share"),
        X.safe_div(c("total_equity") * unit, "_sh_bvps").alias("equity_per_share_calc"),
        X.safe_div(c("retained_earnings") * unit, "_sh_bvps").alias("retained_earnings_per_share"),
        X.bool_flag(X.greater("total_assets", 0) & ((c("total_liabilities") == 0) | X.greater("total_liabilities", 0))
                    & X.greater("total_equity", 0) & X.greater("share_capital", 0)).alias("is_valid_balance_sheet"),
        X.bool_flag(F.abs(c("total_assets") - c("total_liabilities") - c("total_equity"))
                    <= c("total_assets") * F.lit(cfg.balance_tolerance)).alias("is_balance_equation_roughly_valid"),
        X.bool_flag(X.greater("_adj_bvps", 0) & X.greater("_sh_bvps", 0)
                    & ratio.between(F.lit(cfg.share_ratio_low), F.lit(cfg.share_ratio_high))
                    ).alias("is_share_count_reasonable"))


# --------------------------------------------------------------------------- M13
def balance_deadline(cfg: PanelConfig = DEFAULT) -> F.Column:
    """Q1 05-16, Q2 08-16, Q3 11-15, Q4 next year 04-01, otherwise NULL."""
    q, y = F.col("quarter"), F.col("year")
    out = None
    for qq, m, d in cfg.balance_deadlines:
        val = X.make_date_or_null(y, F.lit(m), F.lit(d))
        out = F.when(q == qq, val) if out is None else out.when(q == qq, val)
    m4, d4 = cfg.balance_q4_deadline
    return out.when(q == 4, X.make_date_or_null(y + 1, F.lit(m4), F.lit(d4)))


def int_balance_sheet_shifter(features: DataFrame, cfg: PanelConfig = DEFAULT) -> DataFrame:
    """bs_box dated at the filing deadline itself (no calendar align)."""
    box = F.struct(*[F.col(c) for c in BS_BOX_COLS])
    return (features.select(balance_deadline(cfg).alias("date"), "ticker", box.alias("bs_box"))
            .filter(F.col("date").isNotNull()))


# --------------------------------------------------------------------------- M14
DAILY_COLS = ["open", "high", "low", "adj_close", "volume", "ma20", "ma60", "bias20", "day_amplitude"]


def int_vbt_stack(indicators: DataFrame, rev: DataFrame, fin: DataFrame, bal: DataFrame) -> DataFrame:
    """One long stack of the four event kinds; absent columns are typed
    NULLs (a by-name union pads missing struct columns with NULL)."""
    daily = indicators.select("date", "ticker", *DAILY_COLS)
    out = daily
    for part in (rev, fin, bal):
        out = out.unionByName(part, allowMissingColumns=True)
    return out.select("date", "ticker", *DAILY_COLS, "rev_box", "fin_box", "bs_box")
