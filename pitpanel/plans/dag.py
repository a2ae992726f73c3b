"""Whole build: sources -> every model, with materialisation points.

``build`` wires the models lazily.  With ``out_dir`` it writes the tables the
reference materialises (month-partitioned panels and the DCF tables) and
continues from the written files, which also cuts the lineage so a lost
executor recomputes from the last table rather than from the raw sources.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.config import DEFAULT, PanelConfig
from pitpanel.operators import dcf
from pitpanel.operators import quality as Q
from pitpanel.operators.actions import all_steps
from pitpanel.operators.calendar import TradingDayMap, trading_calendar
from pitpanel.operators.segments import Blocks
from pitpanel.plans import intermediate as I
from pitpanel.plans import marts as M
from pitpanel.plans import staging as S
from pitpanel.sources import sinks
from pitpanel.sources.readers import Sources

PARTITIONED = ("int_daily_prices_adjusted", "mart_vbt_master_dataset", "mart_factor_dataset",
               "mart_expectation_dataset")
#: Stored panels whose rows are checked while they are written.
CHECKED = ("mart_vbt_master_dataset",)
TABLES = ("dim_dcf_surface", "dim_dcf_lookup", "mart_vbt_valuation_dataset")
#: What several branches of the plans read: staged prices (calendar, block starts, adjusted prices) and dated reports.
SHARED = ("stg_daily_prices_raw", "int_monthly_revenue_shifter", "int_financial_shifter", "int_balance_sheet_shifter")


class Build:
    """Lazily built models; ``t[name]`` returns (and memoises) a model."""

    def __init__(self, spark: SparkSession, src: Sources, cfg: PanelConfig = DEFAULT,
                 out_dir: str | None = None, as_of: dt.date | None = None, scratch: str | None = None):
        """``scratch``: a folder for what several branches read (staged prices, dated reports, block starts), without
        the tables of a build; a build with ``out_dir`` has them beside its tables."""
        self.spark, self.src, self.cfg, self.out_dir, self.as_of = spark, src, cfg, out_dir, as_of
        self.scratch = scratch if out_dir is None else out_dir
        self._tasks: int | None = None
        self.watched: dict[str, Q.Watch] = {}
        self._m: dict[str, DataFrame] = {}
        self._steps: DataFrame | None = None
        self._days: TradingDayMap | None = None
        self._val_index = None
        self._blocks: Blocks | None = None
        self._searched = False
        self._daily: DataFrame | None = None
        self._months: DataFrame | None = None

    @property
    def valuation_index(self):
        """Nearest-match index over the valuation slice of the surface, built once."""
        if self._val_index is None:
            self._val_index = M.valuation_index(self["dim_dcf_surface"], self.cfg)
        return self._val_index

    @property
    def trading_days(self) -> TradingDayMap:
        """day -> first trading date on or after it, computed once per build."""
        if self._days is None:
            self._days = TradingDayMap(self["trading_calendar"])
        return self._days

    @property
    def blocks(self) -> Blocks | None:
        """Where tickers with very many price rows are cut: found once per build and stored with its tables.

        A build without any folder keeps whole tickers (its plans would repeat the search for starts in every branch);
        one with a scratch folder only has no auxiliary branches where no ticker is that long."""
        if not self._searched and self.scratch is not None:
            self._searched = True
            found = I.price_blocks(self["stg_daily_prices_raw"], self.cfg)
            starts = self.kept("ticker_blocks", found.table)
            if self.out_dir is not None or not starts.isEmpty():
                self._blocks = Blocks.of(starts, bounded=found.bounded)
        return self._blocks

    @property
    def tasks(self) -> int | None:
        """Tasks of the windows over tickers, in proportion to the price rows, so that a task's rows (and its sorts in memory)
        do not grow with the data.  A build without any folder leaves the number to the session."""
        if self._tasks is None and self.scratch is not None:
            self._tasks = max(self.cfg.least_tasks, -(-self["stg_daily_prices_raw"].count() // self.cfg.task_rows))
        return self._tasks

    def kept(self, name: str, df: DataFrame) -> DataFrame:
        """``df``, stored where the build has a folder."""
        if self.scratch is None:
            return df
        path = f"{self.scratch}/{name}"
        sinks.write_table(df, path)
        return self.spark.read.parquet(path)

    @property
    def actions(self) -> DataFrame:
        """Corporate-action step table, computed once per build."""
        if self._steps is None:
            self._steps = all_steps(self.src.corporate_actions)
        return self._steps

    @property
    def month_rows(self) -> DataFrame:
        """Price rows of each month, by which the panels' months are split; counted once per build."""
        if self._months is None:
            self._months = self.kept("month_rows", sinks.month_rows(self["stg_daily_prices_raw"]))
        return self._months

    def since(self, name: str, floor: dt.date) -> DataFrame:
        """A panel from a date on; a stored one opens the months from there only."""
        df = self[name]
        if self.out_dir is None or name not in PARTITIONED:
            return df.filter(F.col("date") >= F.lit(floor))
        return sinks.read_panel(self.spark, f"{self.out_dir}/{name}", date_from=floor).drop(sinks.MONTH_COL)

    @property
    def daily(self) -> DataFrame:
        """Adjusted prices from the indicator floor on.  Where tickers are cut, the rows beyond the blocks' edges read them again,
        so a build without tables stores them then."""
        if self._daily is None:
            self._daily = self.since("int_daily_prices_adjusted", self.cfg.indicator_floor)
            if self.out_dir is None and self.blocks is not None:
                self._daily = self.kept("daily_adjusted", self._daily)
        return self._daily

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        if self.out_dir is None:
            return df
        path = f"{self.out_dir}/{name}"
        if name in PARTITIONED:
            if name in CHECKED:
                self.watched[name] = Q.Watch(Q.row_conditions(self.cfg.market_time_zone, self.as_of))
            sinks.write_month_partitioned(df, path, months=self.month_rows, watch=self.watched.get(name))
            return sinks.read_panel(self.spark, path).drop(sinks.MONTH_COL)
        sinks.write_table(df, path)
        return self.spark.read.parquet(path)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._m:
            df = getattr(self, f"_{name}")()
            if name in PARTITIONED or name in TABLES:
                df = self._store(name, df)
            elif name in SHARED:
                df = self.kept(name, df)
            self._m[name] = df
        return self._m[name]

    # staging
    def _stg_daily_prices_raw(self): return S.stg_daily_prices(self.src.daily_prices)
    def _stg_dividend_factor(self): return S.stg_dividend_factor(self.src.sii_dividend, self.src.otc_dividend, self.cfg)
    def _stg_income_statement(self): return S.stg_income_statement(self.src.income_statement)
    def _stg_monthly_revenue(self): return S.stg_monthly_revenue(self.src.monthly_revenue)
    def _stg_balance_sheet(self): return S.stg_balance_sheet(self.src.balance_sheet)

    # intermediate
    def _int_daily_prices_adjusted(self):
        return I.int_daily_prices_adjusted(self["stg_daily_prices_raw"], self["stg_dividend_factor"],
                                           self.actions, self.cfg, self.blocks, self.tasks)

    def _int_daily_indicators(self):
        return I.int_daily_indicators(self.daily, self.cfg, self.blocks, self.tasks)

    def _trading_calendar(self):
        # the dates of the daily indicators: neither the dividend join nor the windows drop a price row
        floor = max(self.cfg.price_floor, self.cfg.indicator_floor)
        return trading_calendar(self["stg_daily_prices_raw"].filter(F.col("date") >= F.lit(floor)))
    def _int_monthly_revenue_features(self): return I.int_monthly_revenue_features(self["stg_monthly_revenue"])

    def _int_monthly_revenue_shifter(self):
        return I.int_monthly_revenue_shifter(self["int_monthly_revenue_features"], self.trading_days, self.cfg)

    def _int_financial_features(self):
        return I.int_financial_features(self["stg_income_statement"], self.actions, self.cfg)

    def _int_financial_shifter(self):
        return I.int_financial_shifter(self["int_financial_features"], self.trading_days, self.cfg)

    def _int_balance_sheet_features(self):
        return I.int_balance_sheet_features(self["stg_balance_sheet"], self.actions, self.cfg)

    def _int_balance_sheet_shifter(self): return I.int_balance_sheet_shifter(self["int_balance_sheet_features"], self.cfg)

    def _int_vbt_stack(self):
        return I.int_vbt_stack(self["int_daily_indicators"], self["int_monthly_revenue_shifter"],
                               self["int_financial_shifter"], self["int_balance_sheet_shifter"])

    # marts
    def _mart_vbt_master_dataset(self):
        # fused form (one shuffle of the daily rows); equal to M15 over the M14 stack
        return M.mart_vbt_master_from_parts(self.daily, self["int_monthly_revenue_shifter"],
                                            self["int_financial_shifter"], self["int_balance_sheet_shifter"], self.cfg,
                                            self.blocks, self.tasks)

    def _dim_dcf_surface(self): return dcf.dcf_surface(self.spark, self.cfg)
    def _dim_dcf_lookup(self): return dcf.dcf_lookup(self.spark, self["dim_dcf_surface"], self.cfg)

    def _mart_vbt_valuation_dataset(self):
        return M.mart_vbt_valuation_dataset(self["mart_vbt_master_dataset"], self["dim_dcf_surface"], self.cfg,
                                            self.valuation_index)

    def _mart_factor_dataset(self):
        return M.mart_factor_dataset(self.since("mart_vbt_master_dataset", self.cfg.panel_floor), self["dim_dcf_surface"], self.cfg,
                                     self.valuation_index)

    def _mart_expectation_features(self):
        panel = self.since("mart_vbt_master_dataset", self.cfg.panel_floor)
        if self.out_dir is None:   # the panel is read twice: by month and joined back
            panel = self.kept("expectation_panel", panel.select(*[c for c in panel.columns if c in M.EXPECTATION_INPUT]))
        return M.mart_expectation_features(panel, self.cfg)

    def _mart_expectation_dataset(self):
        return M.mart_expectation_dataset(self["mart_expectation_features"], self["dim_dcf_lookup"], self.cfg)


MODELS = ("stg_daily_prices_raw", "stg_dividend_factor", "stg_income_statement", "stg_monthly_revenue",
          "stg_balance_sheet", "int_daily_prices_adjusted", "int_daily_indicators",
          "int_monthly_revenue_features", "int_monthly_revenue_shifter", "int_financial_features",
          "int_financial_shifter", "int_balance_sheet_features", "int_balance_sheet_shifter",
          "int_vbt_stack", "mart_vbt_master_dataset", "dim_dcf_surface", "dim_dcf_lookup",
          "mart_vbt_valuation_dataset", "mart_factor_dataset", "mart_expectation_features",
          "mart_expectation_dataset")


def build(spark: SparkSession, src: Sources, cfg: PanelConfig = DEFAULT, out_dir: str | None = None) -> dict:
    """Run the whole DAG in order; returns {model name: DataFrame}."""
    b = Build(spark, src, cfg, out_dir)
    return {name: b[name] for name in MODELS}
