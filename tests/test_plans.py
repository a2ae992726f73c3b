"""Physical-plan regression checks for the headline models (production path:
upstream tables materialised, as the build does)."""

import re
import uuid

import pytest

from pitpanel.plans.dag import Build
from pitpanel.session import ensure_checkpoint_dir
from pitpanel.sources.adapters import sources_from_lineitem

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "SortAggregate")


@pytest.fixture(scope="module")
def built(spark):
    b = Build(spark, sources_from_lineitem(spark, SF),
              out_dir=f"{ensure_checkpoint_dir(spark)}/test-plans-{uuid.uuid4().hex[:8]}")
    for m in ("int_daily_prices_adjusted", "mart_vbt_master_dataset", "dim_dcf_surface", "dim_dcf_lookup"):
        b[m]
    return b


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("model", ["mart_vbt_master_dataset", "mart_vbt_valuation_dataset",
                                   "mart_factor_dataset", "mart_expectation_features", "mart_expectation_dataset"])
def test_no_slow_operators(built, model):
    plan = _plan(getattr(built, f"_{model}")())
    for op in FORBIDDEN:
        assert op not in plan, f"{model} uses {op}"


@pytest.mark.parametrize("model", ["mart_vbt_valuation_dataset", "mart_factor_dataset"])
def test_valuation_is_map_only(built, model):
    plan = _plan(getattr(built, f"_{model}")())
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 3


def _ancestors(plan: str, line_no: int) -> list[str]:
    """Lines on the path from a plan node up to the root (tree-string indentation)."""
    lines = plan.splitlines()

    def depth(x):
        return len(x) - len(x.lstrip(" :+-"))

    out, d = [], depth(lines[line_no])
    for ln in reversed(lines[:line_no]):
        if depth(ln) < d:
            out.append(ln.strip(" :+-"))
            d = depth(ln)
    return out


def _main_and_cut(plan: str, table: str) -> tuple[list, list]:
    """Paths to the root of the scans of a table: those of all rows, and those that meet the tickers cut into blocks
    (a semi join with the bounded, broadcast table of block starts; empty in usual data)."""
    scans = [i for i, ln in enumerate(plan.splitlines()) if "FileScan parquet" in ln and table in ln]
    paths = [_ancestors(plan, i) for i in scans]
    cut = [p for p in paths if any("LeftSemi" in a for a in p)]
    return [p for p in paths if p not in cut], cut


def _exchanges(path):
    return [a for a in path if a.startswith("Exchange")]


def test_master_shuffles_daily_rows_once(built):
    plan = _plan(built._mart_vbt_master_dataset())
    assert "SortMergeJoin" not in plan
    main, cut = _main_and_cut(plan, "int_daily_prices_adjusted")
    assert len(main) == 1                                    # the daily table is read once
    exchanges = _exchanges(main[0])
    assert len(exchanges) == 1 and exchanges[0].startswith("Exchange hashpartitioning(ticker")
    for path in cut:                                         # halo rows and days ahead: of cut tickers only
        semi = next(k for k, a in enumerate(path) if "LeftSemi" in a)
        assert not any(a.startswith("Exchange") for a in path[:semi])


def test_adjusted_prices_shuffle_prices_once(built):
    plan = _plan(built._int_daily_prices_adjusted())
    main, _ = _main_and_cut(plan, "lineitem")
    # every lineitem-derived input (prices, dividends) crosses exactly one ticker exchange after its
    # adapter/staging aggregation; no (ticker, date) co-partitioning exchange for a join
    assert main
    for path in main:
        assert sum(e.startswith("Exchange hashpartitioning(ticker") and "d#" not in e and "ex_date" not in e
                   for e in _exchanges(path)) == 1
    # (below the semi joins stands the adapters' aggregation of lineitem, which a stored source table does not have)
    assert "SortMergeJoin" not in plan
