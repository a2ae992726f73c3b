"""Stored tables: one-step replacement, month pieces, pruned reads."""

import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pitpanel.operators import quality as Q
from pitpanel.plans.dag import Build
from pitpanel.session import ensure_checkpoint_dir
from pitpanel.sources import sinks
from pitpanel.sources.adapters import sources_from_lineitem

D = dt.date


@pytest.fixture
def root(spark):
    return f"{ensure_checkpoint_dir(spark)}/test-sinks-{uuid.uuid4().hex[:8]}"


def rows(spark, path):
    return sorted(r.v for r in spark.read.parquet(path).collect())


def test_a_failed_or_killed_write_leaves_the_old_table(spark, root, monkeypatch):
    path = f"{root}/t"
    sinks.write_table(spark.createDataFrame([(1,), (2,)], "v int"), path)
    bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("planted"))).otherwise(F.col("id")).cast("int").alias("v"))
    with pytest.raises(Exception, match="planted"):
        sinks.write_table(bad, path)
    assert rows(spark, path) == [1, 2]
    with monkeypatch.context() as m:     # killed after the write, before the switch
        m.setattr(sinks, "recover", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            sinks.write_table(spark.createDataFrame([(3,)], "v int"), path)
    assert rows(spark, path) == [1, 2]
    assert sinks.register_tables(spark, root) == ["t"]
    sinks.write_table(spark.createDataFrame([(4,)], "v int"), path)
    assert rows(spark, path) == [4]
    sinks.write_table(spark.read.parquet(path).withColumn("v", F.col("v") + 1), path)   # of the table itself
    assert rows(spark, path) == [5]


def test_a_job_killed_within_the_switch_is_recovered(spark, root):
    path = f"{root}/t"
    sinks.write_table(spark.createDataFrame([(1,)], "v int"), path)
    fs, target = sinks._file_system(spark, path)
    fs.rename(target, sinks._file_system(spark, sinks._beside(path, sinks.OLD))[1])
    assert not fs.exists(target)
    sinks.recover(spark, path)
    assert rows(spark, path) == [1]
    sinks.recover(spark, path)                       # nothing to do
    sinks.recover(spark, f"{root}/missing")
    assert rows(spark, path) == [1]


def files(path):
    return {p.name: len(list(p.glob("*.parquet"))) for p in Path(path.removeprefix("file://")).glob("date_month=*")}


def test_large_months_fall_into_pieces_with_their_own_tickers(spark, root):
    df = spark.range(12_000).select((F.col("id") % 200).cast("string").alias("ticker"), F.date_add(F.lit(D(2020, 1, 1)), (F.col("id") % 59).cast("int")).alias("date"), "id")
    months = sinks.month_rows(df)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_month_partitioned(df, f"{root}/p", months=months, rows_per_piece=2_000)
        sinks.write_month_partitioned(df, f"{root}/one")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(spark.read.parquet(f"{root}/p").select("id").toPandas()["id"]) == list(range(12_000))
    held = spark.read.parquet(f"{root}/p").groupBy("date_month", F.input_file_name().alias("f")).agg(F.collect_set("ticker").alias("t")).collect()
    for month in {r.date_month for r in held}:
        own = [set(r.t) for r in held if r.date_month == month]
        assert len(own) > 1 and sum(map(len, own)) == len(set().union(*own))      # no ticker in two pieces
    assert spark.read.parquet(f"{root}/one").count() == 12_000
    sinks.write_month_partitioned(df, f"{root}/few", months=months)
    assert set(files(f"{root}/few").values()) == {1}


def test_counting_rows_leaves_one_sort(spark, root):
    """The counts stand below the sort, so that Spark sees its order when it writes the months and does not sort again."""
    df = spark.range(100).select(F.col("id").cast("string").alias("ticker"), F.date_add(F.lit(D(2020, 1, 1)), F.col("id").cast("int")).alias("date"))
    watch = Q.Watch({"late": F.col("date") >= F.lit(D(2020, 4, 1))})
    out = sinks.month_sorted(df, "date", "ticker", None, 1000, watch)
    assert out._jdf.queryExecution().analyzed().nodeName() == "Sort"
    watch = Q.Watch({"late": F.col("date") >= F.lit(D(2020, 4, 1))})
    sinks.write_month_partitioned(df, f"{root}/watched", watch=watch)
    assert watch.counts() == {"rows": 100, "late": 9}


def _partition_filters(df, table):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [ln for ln in plan.splitlines() if "FileScan parquet" in ln and table in ln]


def test_date_floors_of_the_models_open_their_months_only(spark, root):
    b = Build(spark, sources_from_lineitem(spark, "/root/testdata/sf0.001"), out_dir=root)
    b["mart_vbt_master_dataset"]
    for model, table, floor in (("int_daily_indicators", "int_daily_prices_adjusted", "2009-01-01"), ("mart_factor_dataset", "mart_vbt_master_dataset", "2010-01-01"),
                                ("mart_expectation_features", "mart_vbt_master_dataset", "2010-01-01")):
        scans = _partition_filters(getattr(b, f"_{model}")(), table)
        assert scans and all(f"date_month#" in ln and f">= {floor}" in ln.split("PartitionFilters")[1].split("PushedFilters")[0] for ln in scans), model
    got = sinks.read_panel(spark, f"{root}/mart_vbt_master_dataset", D(2012, 3, 5), D(2012, 4, 2))
    want = b["mart_vbt_master_dataset"].filter("date BETWEEN DATE'2012-03-05' AND DATE'2012-04-02'")
    assert got.count() == want.count() > 0
