"""Rows of a task do not grow with the data: hot tickers, tasks by rows, panels computed once."""

from pitpanel.config import PanelConfig
from pitpanel.operators.segments import BLOCK
from pitpanel.plans.dag import Build
from tests.test_segments import folder, long_and_short, same

CUT = PanelConfig(block_rows=64, task_rows=200, least_tasks=2)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_build_with_a_scratch_folder_cuts_a_hot_ticker(spark):
    """As the plain registered queries build: no tables, but no ticker in one task."""
    src = long_and_short(spark, 300, 2)
    one, cut = Build(spark, src), Build(spark, src, CUT, scratch=folder(spark))
    assert {r._cut for r in cut.blocks.table.collect()} == {"L"}
    assert cut.blocks.tag(cut["stg_daily_prices_raw"]).filter("ticker = 'L'").select(BLOCK).distinct().count() >= 5
    for model in ("int_vbt_stack", "mart_vbt_master_dataset"):
        same(cut[model], one[model])


def test_without_long_tickers_there_are_no_auxiliary_branches(spark):
    build = Build(spark, long_and_short(spark, 300), scratch=folder(spark))
    assert build.blocks is None and "LeftSemi" not in _plan(build["mart_vbt_master_dataset"])


def test_tasks_of_the_windows_follow_the_rows(spark):
    few, many = (Build(spark, long_and_short(spark, days), CUT, scratch=folder(spark)) for days in (300, 800))
    assert 2 <= few.tasks < many.tasks == -(-many["stg_daily_prices_raw"].count() // 200)
    assert "hashpartitioning(ticker#" in _plan(many["int_daily_prices_adjusted"])
    assert f", {many.tasks}), REPARTITION_BY_NUM" in _plan(many["int_daily_prices_adjusted"])
    assert Build(spark, many.src).tasks is None


def test_expectation_features_compute_the_panel_once(spark):
    src = long_and_short(spark, 700)
    build = Build(spark, src, scratch=folder(spark))
    plan = _plan(build["mart_expectation_features"])
    assert "expectation_panel" in plan and "stg_daily_prices_raw" not in plan
    same(build["mart_expectation_features"], Build(spark, src)["mart_expectation_features"])
