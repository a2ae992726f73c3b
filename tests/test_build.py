"""Production path: real-source readers -> whole DAG with materialised tables."""

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from pitpanel.plans.dag import MODELS, Build, build
from pitpanel.session import ensure_checkpoint_dir
from pitpanel.sources.adapters import sources_from_lineitem
from pitpanel.sources.readers import read_corporate_actions, read_sources
from pitpanel.stable import stabilize

SF = "/root/testdata/sf0.001"


def test_seed_csv_keeps_text_tickers(spark, tmp_path):
    p = tmp_path / "actions.csv"
    p.write_text("ticker,effective_date,price_factor,per_share_factor,share_factor,note\n"
                 "0071,2014-02-09,0.2,0.2,5,one into five\n", encoding="utf-8")
    df = read_corporate_actions(spark, str(p))
    r = df.collect()[0]
    assert r.ticker == "0071" and str(r.effective_date) == "2014-02-09" and r.share_factor == 5.0
    assert dict(df.dtypes)["price_factor"] == "double"


def test_build_from_written_sources_matches_in_memory(spark, tmp_path):
    root = f"{ensure_checkpoint_dir(spark)}/test-build-{uuid.uuid4().hex[:8]}"
    src = sources_from_lineitem(spark, SF)
    # without the planted violations, so that the command's checks pass
    src = replace(src, daily_prices=src.daily_prices.filter("volume >= 0 AND ticker IS NOT NULL"))
    for name, df in (("daily_prices_partitioned", src.daily_prices), ("sii_dividend", src.sii_dividend),
                     ("otc_dividend", src.otc_dividend), ("monthly_revenue", src.monthly_revenue),
                     ("income_statement", src.income_statement), ("balance_sheet", src.balance_sheet)):
        df.write.mode("overwrite").parquet(f"{root}/src/{name}")
    seed = tmp_path / "seed.csv"
    rows = src.corporate_actions.collect()
    seed.write_text("ticker,effective_date,price_factor,per_share_factor,share_factor,note\n"
                    + "".join(f"{r.ticker},{r.effective_date},{r.price_factor},{r.per_share_factor},"
                              f"{r.share_factor},{r.note}\n" for r in rows), encoding="utf-8")
    read = read_sources(spark, f"{root}/src", str(seed))
    models = build(spark, read, out_dir=f"{root}/out")
    assert set(models) == set(MODELS)
    written = stabilize(spark.read.parquet(f"{root}/out/mart_vbt_master_dataset").drop("date_month"))
    memory = stabilize(Build(spark, src)["mart_vbt_master_dataset"])
    assert written.count() == memory.count() > 0
    assert written.exceptAll(memory.select(*written.columns)).count() == 0
    factor = spark.read.parquet(f"{root}/out/mart_factor_dataset")
    assert "date_month" in factor.columns and factor.filter(F.col("date") < "2010-01-01").count() == 0

    from pitpanel.__main__ import main
    assert main(["build", "--sources", f"{root}/src", "--seed", str(seed), "--out", f"{root}/cli",
                 "--as-of", "2030-01-01"]) == 0
    cli = stabilize(spark.read.parquet(f"{root}/cli/mart_vbt_master_dataset").drop("date_month"))
    assert cli.exceptAll(written).count() == 0 and cli.count() == written.count()


def test_cli_demo_builds_and_checks(spark):
    from pitpanel.__main__ import main
    out = f"{ensure_checkpoint_dir(spark)}/test-cli-{uuid.uuid4().hex[:8]}"
    assert main(["demo", "--sf", SF, "--out", out]) == 1      # the derived sources hold planted violations
    assert spark.read.parquet(f"{out}/mart_expectation_dataset").count() > 0


def test_register_tables_for_sql(spark):
    from pitpanel.plans.dag import Build
    from pitpanel.sources.sinks import register_tables
    out = f"{ensure_checkpoint_dir(spark)}/test-views-{uuid.uuid4().hex[:8]}"
    b = Build(spark, sources_from_lineitem(spark, SF), out_dir=out)
    b["mart_factor_dataset"]
    names = register_tables(spark, out)
    assert {"int_daily_prices_adjusted", "mart_vbt_master_dataset", "mart_factor_dataset"} <= set(names)
    q = spark.sql("SELECT ticker, count(*) AS n FROM mart_factor_dataset "
                  "WHERE date_month >= DATE'2012-01-01' AND date >= DATE'2012-01-15' GROUP BY ticker")
    assert q.count() > 0
    assert "PartitionFilters: [isnotnull(date_month" in q._jdf.queryExecution().executedPlan().toString()
