"""Checks on a panel with planted violations, counted while it is written."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from pitpanel.operators import quality as Q
from pitpanel.plans.dag import Build
from pitpanel.session import ensure_checkpoint_dir
from tests import fixtures as fx

D = dt.date
BARS = [("A", "2012-01-02", 1.0, 5), ("A", "2012-01-03", 1.0, -5), ("B", "2012-01-03", 1.0, 0), ("B", "2012-01-04", 1.0, -1),
        (None, "2012-01-04", 1.0, 3), (None, "2012-01-05", 1.0, -3), ("C", "2031-05-05", 1.0, 1), ("C", "2012-01-02", 1.0, None)]
WANT = {"no_future_date": 1, "no_negative_volume": 3, "not_null_keys": 2}


def test_checks_count_while_the_panel_is_written(spark):
    root = f"{ensure_checkpoint_dir(spark)}/test-quality-{uuid.uuid4().hex[:8]}"
    build = Build(spark, fx.sources(spark, daily_prices=fx.prices(spark, BARS)), out_dir=root, as_of=D(2020, 1, 1))
    master = build["mart_vbt_master_dataset"]
    watch = build.watched["mart_vbt_master_dataset"]
    assert watch.counts() == {"rows": 8, **WANT}
    found = watch.violations(master)
    assert {k: v.count() for k, v in found.items()} == WANT
    assert sorted(r.d_vol for r in found["no_negative_volume"].collect()) == [-5, -3, -1]
    clean = Build(spark, fx.sources(spark, daily_prices=fx.prices(spark, BARS[:1])), out_dir=f"{root}/clean", as_of=D(2020, 1, 1))
    clean["mart_vbt_master_dataset"]
    assert clean.watched["mart_vbt_master_dataset"].violations(master) == {}       # nothing is fetched


def test_checks_as_queries_find_the_same_rows(spark):
    master = Build(spark, fx.sources(spark, daily_prices=fx.prices(spark, BARS)))["mart_vbt_master_dataset"]
    got = {"no_future_date": Q.future_dates(master, as_of=D(2020, 1, 1)), "no_negative_volume": Q.negative_volume(master), "not_null_keys": Q.null_keys(master)}
    assert {k: v.count() for k, v in got.items()} == WANT
    assert Q.duplicate_keys(master.unionByName(master.filter(F.col("ticker") == "A"))).count() == 2


def test_registered_checks_meet_violations(spark):
    from pitpanel.catalog import QUERIES
    counts = {n: QUERIES[n](spark, "/root/testdata/sf0.001").count() for n in ("dq_negative_volume", "dq_not_null", "dq_future_dates_as_of", "dq_stack_duplicate_keys")}
    assert min(counts.values()) > 0, counts
