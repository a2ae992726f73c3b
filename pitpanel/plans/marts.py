"""Mart models M15-M21: master panel, valuation, factor and expectation sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.config import DEFAULT, PanelConfig
from pitpanel.functions import exprs as X
from pitpanel.operators import windows as W
from pitpanel.operators.nearest import NearestIndex
from pitpanel.operators.segments import BLOCK, Blocks
from pitpanel.plans import intermediate as I
from pitpanel.sources import schemas

PRICE_MAX = {"open": "d_open", "high": "d_high", "low": "d_low", "adj_close": "d_close",
             "volume": "d_vol", "ma20": "ma20", "ma60": "ma60", "bias20": "bias20"}
# (stack column, label field deciding collisions, collapsed alias, fill names)
BOXES = (("rev_box", "data_month_label", "r", schemas.REV_FILL_NAMES),
         ("fin_box", "year_quarter", "f", schemas.FIN_FILL_NAMES),
         ("bs_box", "year_quarter", "b", schemas.BS_FILL_NAMES))
FILL_COLUMNS = [dst for *_, names in BOXES for dst in names.values()]


def _with_kind(stack: DataFrame) -> DataFrame:
    kind = (F.when(F.col("rev_box").isNotNull(), 1).when(F.col("fin_box").isNotNull(), 2)
             .when(F.col("bs_box").isNotNull(), 3).otherwise(0))
    return stack.withColumn("_kind", kind)


def _best_box(box: str, label: str) -> F.Column:
    """The box with the latest label; identical labels (duplicated statements)
    fall back to the largest box, so reruns pick the same one whatever the row order."""
    return F.max(F.when(F.col(box).isNotNull(), F.struct(F.col(box).getField(label).alias("l"), F.col(box).alias("b"))))


def _collapse(s: DataFrame, keys: list[str], kept: list[str] | None = None) -> DataFrame:
    """A1/A2 within data partitioned by ``keys``; ``kept``: columns that are the same in all rows of a day."""
    day = Window.partitionBy(*keys, "date").orderBy("_kind").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    day_rn = Window.partitionBy(*keys, "date").orderBy("_kind")
    cols = [F.max(src).over(day).alias(dst) for src, dst in PRICE_MAX.items()]
    cols += [_best_box(box, label).over(day).getField("b").alias(alias) for box, label, alias, _ in BOXES]
    out = s.select("date", *keys, *(kept or []), *cols, F.row_number().over(day_rn).alias("_rn"))
    return out.filter(F.col("_rn") == 1).drop("_rn")


def collapse_stack(stack: DataFrame) -> DataFrame:
    """A1/A2: one row per (date, ticker): MAX of the price columns and, per box
    kind, one non-NULL box (on a collision the latest label wins, Quirk 4;
    equal labels: the largest box, for deterministic reruns).

    An aggregate that combines before the shuffle: however many copies a
    (date, ticker) has, a task sends one row for it.  (The master panel below
    collapses inside its windows' partitioning instead, as its rolling means
    count every copy.)"""
    boxes = [_best_box(box, label).alias(alias) for box, label, alias, _ in BOXES]
    out = stack.groupBy("date", "ticker").agg(*[F.max(src).alias(dst) for src, dst in PRICE_MAX.items()], *boxes)
    return out.select("date", "ticker", *PRICE_MAX.values(), *[F.col(a).getField("b").alias(a) for *_, a, _ in BOXES])


def _fill_and_returns(c: DataFrame, cfg: PanelConfig, keys: list[str], kept: list[str] | None = None) -> DataFrame:
    kept = kept or []
    fill = []
    for _, _, alias, names in BOXES:
        for field, dst in names.items():
            fill.append(W.forward_fill(F.col(alias).getField(field), "date", keys).alias(dst))
    filled = c.select("date", *keys, *kept, *PRICE_MAX.values(), *fill)
    filled = filled.filter(F.col("date") >= F.lit(cfg.panel_floor))
    return filled.select(
        "date", "ticker", *kept, *PRICE_MAX.values(), *FILL_COLUMNS,
        X.safe_div("d_close", X.nullif("eps_ttm", 0)).alias("pe_ttm"),
        X.safe_div("d_close", X.nullif("book_value_per_share", 0)).alias("pb_ratio"),
        *[W.lead_return("d_close", "date", n, keys).alias(f"ret_{n}d") for n in cfg.lead_days])


def mart_vbt_master_dataset(stack: DataFrame, cfg: PanelConfig = DEFAULT) -> DataFrame:
    """Collapse, per-field forward fill of 47 report fields (Quirk 6),
    panel floor, PE/PB and row-based forward returns (Quirk 5)."""
    return _fill_and_returns(collapse_stack(stack), cfg, ["ticker"])


def mart_vbt_master_from_parts(adjusted: DataFrame, rev: DataFrame, fin: DataFrame, bal: DataFrame,
                               cfg: PanelConfig = DEFAULT, blocks: Blocks | None = None, tasks: int | None = None) -> DataFrame:
    """M15 fused with M7/M14 so the daily rows are shuffled once.

    Adjusted prices (from the indicator floor) and the three dated report
    kinds are unioned and hash-partitioned by (ticker, block) a single time.
    The rolling indicators are windows partitioned by (ticker, block, kind):
    the same exchange satisfies them, and report rows form their own window
    partitions so ma20/ma60 see exactly the daily rows, as in the indicator
    view.  The collapse, forward fill and forward returns then reuse the
    partitioning.

    Where ``blocks`` cuts a ticker, a block also gets the 59 daily rows before
    it (dropped after the rolling means), the first days after it and one row
    with the report fields that enter it (dropped at the end)."""
    daily = adjusted.filter(F.col("date") >= F.lit(cfg.indicator_floor)) \
                    .select("date", "ticker", "open", "high", "low", "adj_close", "volume")
    s = daily
    for part in (rev, fin, bal):
        s = s.unionByName(part, allowMissingColumns=True)
    s = I._tag(s, blocks).withColumn("_own", F.lit(True))
    if blocks is not None:
        s = s.withColumn("_back", F.lit(False))
        for rows in (I.halo_rows(daily.select("date", "ticker", "adj_close"), blocks, cfg).withColumn("_back", F.lit(True)),
                     days_after(daily, (rev, fin, bal), blocks, cfg), entering_reports((rev, fin, bal), blocks)):
            s = s.unionByName(rows, allowMissingColumns=True)
    keys = I.KEYS
    s = I.spread(_with_kind(s), tasks)
    is_daily = F.col("_kind") == 0
    order = [F.col("date"), F.col("adj_close")]
    ma20 = W.rolling_mean("adj_close", order, cfg.ma_short, key=[*keys, "_kind"])
    ma60 = W.rolling_mean("adj_close", order, cfg.ma_long, key=[*keys, "_kind"])
    s = (s.withColumn("ma20", F.when(is_daily, ma20))
          .withColumn("ma60", F.when(is_daily, ma60))
          .withColumn("bias20", X.safe_div(F.col("adj_close") - F.col("ma20"), F.col("ma20"))))
    if blocks is not None:   # only the rolling means look back at the rows before a block
        s = s.filter(F.coalesce(~F.col("_back"), F.lit(True)))
    out = _fill_and_returns(_collapse(s, keys, ["_own"]), cfg, keys, ["_own"])
    return out.filter("_own").drop("_own")


def days_after(daily: DataFrame, reports: tuple, blocks: Blocks, cfg: PanelConfig = DEFAULT) -> DataFrame:
    """The first days after each block with their close: as many as the longest forward return looks ahead.

    Days are collapsed rows, so a day with reports only counts (Quirk 5)."""
    rows = blocks.cut(*[part.filter(F.col("date") >= F.lit(cfg.panel_floor)) for part in (
        daily.select("ticker", "date", "adj_close"), *[part.select("ticker", "date") for part in reports])])
    days = rows.groupBy(*I.KEYS, "date").agg(F.max("adj_close").alias("adj_close"))
    return blocks.next_rows(days, max(cfg.lead_days)).withColumn("_own", F.lit(False))


def entering_reports(reports: tuple, blocks: Blocks) -> DataFrame:
    """One row per block, dated the day before it: each report field's last non-NULL value before the block."""
    s = _with_kind(blocks.cut(*reports).withColumns({c: F.lit(None).cast("double") for c in PRICE_MAX}))
    c = _collapse(s, I.KEYS)
    filled = c.select(*I.KEYS, F.row_number().over(Window.partitionBy(*I.KEYS).orderBy(F.col("date").desc())).alias("_r"),
                      *[W.forward_fill(F.col(alias).getField(field), "date", I.KEYS).alias(dst)
                        for _, _, alias, names in BOXES for field, dst in names.items()])
    state = blocks.entering(filled.filter("_r = 1"), FILL_COLUMNS)
    kinds = {box: part.schema[box].dataType for (box, *_), part in zip(BOXES, reports, strict=True)}
    boxes = [F.struct(*[F.col(names[f]).alias(f) for f in kinds[box].names]).alias(box) for box, _, _, names in BOXES]
    return state.select("ticker", BLOCK, F.date_sub("_start", 1).alias("date"), *boxes, F.lit(False).alias("_own"))


# --------------------------------------------------------------------------- M18/M19
VALUATION_COLS = [f"implied_growth_{h}y_pct" for h in DEFAULT.valuation_years] + \
                 [f"implied_pe_{h}y" for h in DEFAULT.valuation_years]


def valuation_index(surface: DataFrame, cfg: PanelConfig = DEFAULT) -> NearestIndex:
    cands = surface.filter((F.col("discount_rate_pct") == cfg.valuation_discount_pct)
                           & (F.col("terminal_growth_rate_pct") == cfg.valuation_terminal_pct)
                           & F.col("high_growth_years").isin(*cfg.valuation_years))
    return NearestIndex(cands, "implied_pe", ["high_growth_years"], ["growth_rate_pct"],
                        ["growth_rate_pct", "implied_pe"])


def with_implied_growth(df: DataFrame, x, surface: DataFrame, cfg: PanelConfig = DEFAULT,
                        index: NearestIndex | None = None) -> DataFrame:
    """J14 + A8: per row, the growth whose implied PE is nearest to ``x`` for
    each high-growth horizon, already pivoted wide: one broadcast hash join
    per horizon, so rows map 1:1 (no shuffle, no pivot aggregation).  A NULL
    ``x`` gives NULL columns (left-join semantics)."""
    idx = index if index is not None else valuation_index(surface, cfg)
    out = df
    for h in cfg.valuation_years:
        out = idx.probe(out, x, {f"implied_growth_{h}y_pct": "growth_rate_pct", f"implied_pe_{h}y": "implied_pe"},
                        how="left", where=F.col("high_growth_years") == h, keep_groups=False)
    return out


def valuation_base(master: DataFrame) -> DataFrame:
    """The valuation universe (eps_ttm > 0, d_close > 0) with its PE."""
    return (master.filter(F.col("eps_ttm").isNotNull() & (F.col("eps_ttm") > 0) & (F.col("d_close") > 0))
            .select("date", "ticker", "d_close", "eps_ttm",
                    X.safe_div("d_close", X.nullif("eps_ttm", 0)).alias("pe_ttm")))


def mart_vbt_valuation_dataset(master: DataFrame, surface: DataFrame, cfg: PanelConfig = DEFAULT,
                               index: NearestIndex | None = None) -> DataFrame:
    """Valuation universe (eps_ttm > 0, d_close > 0) with implied growth
    and implied PE for 3/5/10 high-growth years."""
    return with_implied_growth(valuation_base(master), "pe_ttm", surface, cfg, index)


FACTOR_BASE = ["date", "ticker", "d_open", "d_high", "d_low", "d_close", "d_vol", "ma20", "ma60",
               "bias20", "revenue", "yoy_growth", "mom_growth_pct", "ytd_growth_pct",
               "yoy_positive_streak_count", "rev_triple_sig", "eps", "eps_ttm", "eps_yoy_growth",
               "pe_ttm", "op_margin", "EBIT_signal", "EPS_signal", "EBIT_vol_signal",
               "revenue_month", "report_quarter", "ret_1d", "ret_5d", "ret_10d", "ret_20d"]


def mart_factor_dataset(master: DataFrame, surface: DataFrame, cfg: PanelConfig = DEFAULT,
                        index: NearestIndex | None = None) -> DataFrame:
    """Factor table = master subset + valuation + price gaps + flags.

    The left join with the valuation table on (date, ticker) is realised as a
    map-side lookup: valuation rows are exactly the master rows passing the
    valuation filter, so rows outside it get a NULL probe value."""
    base = master.filter((F.col("date") >= F.lit(cfg.panel_floor)) & (F.col("d_close") > 0)).select(*FACTOR_BASE)
    in_val = F.col("eps_ttm").isNotNull() & (F.col("eps_ttm") > 0) & (F.col("d_close") > 0)
    x = F.when(in_val, X.safe_div("d_close", X.nullif("eps_ttm", 0)))
    j = with_implied_growth(base, x, surface, cfg, index)
    g5 = F.col("implied_growth_5y_pct")
    return j.select(
        "date", "ticker", "d_open", "d_high", "d_low", "d_close", "d_vol", "ma20", "ma60", "bias20",
        (X.safe_div("d_close", "ma20") - F.lit(1.0)).alias("price_ma20_gap"),
        (X.safe_div("d_close", "ma60") - F.lit(1.0)).alias("price_ma60_gap"),
        "revenue", "yoy_growth", "mom_growth_pct", "ytd_growth_pct", "yoy_positive_streak_count",
        "rev_triple_sig", "eps", "eps_ttm", "eps_yoy_growth", "op_margin", "EBIT_signal", "EPS_signal",
        "EBIT_vol_signal", "pe_ttm", *VALUATION_COLS,
        X.flag(F.col("eps_ttm").isNull() | (F.col("eps_ttm") <= 0)).alias("eps_ttm_invalid_flag"),
        X.flag(g5 == cfg.upper_bound_growth_pct).alias("implied_growth_5y_upper_bound_flag"),
        X.flag(g5 == cfg.lower_bound_growth_pct).alias("implied_growth_5y_lower_bound_flag"),
        "revenue_month", "report_quarter", "ret_1d", "ret_5d", "ret_10d", "ret_20d")


# --------------------------------------------------------------------------- M20
def monthly_unfill(master: DataFrame) -> DataFrame:
    """Undo the forward fill: one row per (ticker, revenue_month) with the
    first date it is visible.  Within one month label the filled revenue and
    YoY are constant, so MAX is a deterministic ANY_VALUE."""
    return (master.filter(F.col("revenue_month").isNotNull() & F.col("revenue").isNotNull())
            .groupBy("ticker", "revenue_month")
            .agg(F.min("date").alias("revenue_available_date"),
                 F.max("revenue").alias("revenue"), F.max("yoy_growth").alias("yoy_growth")))


def revenue_momentum(monthly: DataFrame, cfg: PanelConfig = DEFAULT) -> DataFrame:
    """12-month revenue TTM, 3m/6m mean of normalised YoY
    (|yoy| > 1 -> /100, Quirk 8), acceleration and clamped expected growth."""
    order = "revenue_available_date"
    norm = F.when(F.abs("yoy_growth") > 1, F.col("yoy_growth") / F.lit(100.0)).otherwise(F.col("yoy_growth"))
    m = monthly.select(
        "*", W.gated_sum("revenue", order, cfg.revenue_ttm_months).cast("bigint").alias("monthly_revenue_ttm"),
        W.rolling_mean(norm, order, cfg.yoy_short_months).alias("revenue_yoy_3m_avg"),
        W.rolling_mean(norm, order, cfg.yoy_long_months).alias("revenue_yoy_6m_avg"))
    acc = F.col("revenue_yoy_3m_avg") - F.col("revenue_yoy_6m_avg")
    return m.select("*", acc.alias("revenue_acceleration"),
                    X.clamp_or_null(F.col("revenue_yoy_6m_avg") + F.lit(cfg.acceleration_weight) * acc,
                                    cfg.expected_growth_floor, cfg.expected_growth_cap
                                    ).alias("expected_revenue_growth"))


EXPECTATION_FEATURE_COLS = [
    "date", "ticker", "d_close", "eps", "eps_ttm", "pe_ttm", "pb_ratio", "revenue", "revenue_month",
    "monthly_revenue_ttm", "revenue_yoy_3m_avg", "revenue_yoy_6m_avg", "revenue_acceleration",
    "expected_revenue_growth", "report_quarter", "financial_q_revenue", "financial_revenue_ttm",
    "financial_q_operating_income", "financial_operating_income_ttm", "financial_q_net_income",
    "financial_net_income_ttm", "op_margin", "operating_margin_ttm", "net_margin", "net_margin_ttm",
    "ebit_volatility", "net_margin_volatility", "shares_outstanding", "book_value_per_share",
    "debt_ratio", "equity_ratio", "current_ratio", "forward_revenue_ttm", "forward_net_income",
    "forward_eps", "forward_constant_growth"]
#: Columns of the panel that the features read.
EXPECTATION_INPUT = {*EXPECTATION_FEATURE_COLS, "yoy_growth"}
MONTHLY_FEATURES = ["monthly_revenue_ttm", "revenue_yoy_3m_avg", "revenue_yoy_6m_avg",
                    "revenue_acceleration", "expected_revenue_growth"]


def mart_expectation_features(master: DataFrame, cfg: PanelConfig = DEFAULT) -> DataFrame:
    """Daily panel + monthly revenue momentum -> forward revenue, net
    income, EPS and the constant growth they imply versus TTM EPS.

    The month-level table is about 1/20 of the daily rows; the join back on
    (ticker, revenue_month) is left to the planner / AQE: a broadcast hash
    join while that table is small, otherwise one sort-merge exchange of the
    panel (the same single shuffle a window-only formulation would need)."""
    monthly = revenue_momentum(monthly_unfill(master), cfg).select("ticker", "revenue_month", *MONTHLY_FEATURES)
    d = master.join(monthly, ["ticker", "revenue_month"], "left")
    d = d.withColumn("forward_revenue_ttm",
                     F.col("financial_revenue_ttm") * (F.lit(1.0) + F.col("expected_revenue_growth")))
    d = d.withColumn("forward_net_income", F.col("forward_revenue_ttm") * F.col("net_margin_ttm"))
    d = d.withColumn("forward_eps", X.safe_div(F.col("forward_net_income") * F.lit(1000.0), "shares_outstanding"))
    d = d.withColumn("forward_constant_growth",
                     X.safe_div("forward_eps", X.nullif("eps_ttm", 0)) - F.lit(1.0))
    return d.select(*EXPECTATION_FEATURE_COLS)


# --------------------------------------------------------------------------- M21
def mart_expectation_dataset(features: DataFrame, lookup: DataFrame, cfg: PanelConfig = DEFAULT) -> DataFrame:
    """PE bucket -> market-implied growth (broadcast equi join on the
    0.1 PE grid), expectation gap and three 3-way signals."""
    b = features.filter((F.col("date") >= F.lit(cfg.panel_floor)) & F.col("d_close").isNotNull()
                        & F.col("eps_ttm").isNotNull() & (F.col("eps_ttm") > 0)
                        & F.col("pe_ttm").isNotNull() & (F.col("pe_ttm") > 0)
                        & (F.col("pe_ttm") <= cfg.expectation_pe_max))
    b = b.withColumn("pe_x10", F.round(F.col("pe_ttm") * F.lit(10.0)).cast("bigint")) \
         .withColumn("pe_rounded", F.round("pe_ttm", 1))
    lk = lookup.filter((F.col("discount_rate_pct") == cfg.valuation_discount_pct)
                       & (F.col("terminal_growth_rate_pct") == cfg.valuation_terminal_pct)
                       & (F.col("high_growth_years") == cfg.expectation_years)) \
               .select(F.col("pe_x10").alias("_lk_pe_x10"), "implied_growth_pct", "implied_growth",
                       "implied_pe", "pe_diff", "discount_rate_pct", "terminal_growth_rate_pct",
                       "high_growth_years", "estimate_years")
    lk = F.broadcast(lk)   # one row per PE bucket of the configured grid
    j = b.join(lk, b["pe_x10"] == lk["_lk_pe_x10"], "left").drop("_lk_pe_x10")
    gap = F.col("forward_constant_growth") - F.col("implied_growth")
    return j.select(
        "date", "ticker", "d_close", "eps", "eps_ttm", "pe_ttm", "pe_rounded", "pe_x10", "pb_ratio",
        "revenue", "revenue_month", "monthly_revenue_ttm", "revenue_yoy_3m_avg", "revenue_yoy_6m_avg",
        "revenue_acceleration", "expected_revenue_growth", "report_quarter", "financial_q_revenue",
        "financial_revenue_ttm", "financial_q_operating_income", "financial_operating_income_ttm",
        "financial_q_net_income", "financial_net_income_ttm", "op_margin", "operating_margin_ttm",
        "net_margin", "net_margin_ttm", "ebit_volatility", "net_margin_volatility",
        "shares_outstanding", "book_value_per_share", "debt_ratio", "equity_ratio", "current_ratio",
        "forward_revenue_ttm", "forward_net_income", "forward_eps", "forward_constant_growth",
        "implied_growth_pct", "implied_growth", "implied_pe", "pe_diff", "discount_rate_pct",
        "terminal_growth_rate_pct", "high_growth_years", "estimate_years",
        gap.alias("expectation_gap"),
        X.three_way_signal("forward_constant_growth", cfg.forward_growth_high, cfg.forward_growth_mid
                           ).alias("forward_constant_growth_signal"),
        X.three_way_signal("expected_revenue_growth", cfg.forward_growth_high, cfg.forward_growth_mid
                           ).alias("expected_revenue_growth_signal"),
        X.three_way_signal(gap, cfg.gap_high, cfg.gap_mid).alias("expectation_gap_signal"))
