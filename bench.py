"""Benchmark: the headline models at $BENCH_SF_DIR on local[$BENCH_CPUS].

The models are built the way the reference builds them: in DAG order, with
the reference's materialisation points written as tables (month-partitioned
panels for the adjusted prices, master, factor and expectation sets; plain
tables for the DCF grid and valuation) and downstream models reading those
tables.  Each headline time is the wall time of materialising that table from
its inputs (upstream views are computed inside it).  The six stock sources are
first derived from the driver's ``lineitem`` and written as Parquet source
tables (timed separately as ``source_prep_sec``; the reference also starts
from stored source tables), then read back with ``read_sources``.  Output goes
to a fresh folder under the cluster's ``spark.checkpoint.dir`` (or
$BENCH_OUT_DIR).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
# headline name -> models materialised for it (in DAG order)
HEADLINE = {
    "adjusted_prices": ["int_daily_prices_adjusted"],
    "master_panel": ["mart_vbt_master_dataset"],
    "dcf_lookup": ["dim_dcf_surface", "dim_dcf_lookup"],
    "valuation_nearest": ["mart_vbt_valuation_dataset"],
    "factor_dataset": ["mart_factor_dataset"],
    "expectation_dataset": ["mart_expectation_dataset"],
}


def main() -> None:
    from pitpanel.plans.dag import Build
    from pitpanel.session import ensure_checkpoint_dir, local_session
    from pitpanel.sources.adapters import sources_from_lineitem
    from pitpanel.sources.readers import Sources, read_table

    spark = local_session(CPUS, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="pitpanel-bench")
    root = os.environ.get("BENCH_OUT_DIR") or ensure_checkpoint_dir(spark)
    out_dir = f"{root.rstrip('/')}/pitpanel-bench-{uuid.uuid4().hex[:12]}"
    # generic JVM / code-generation warm-up (synthetic rows, not the pipeline's data)
    warm = spark.range(2_000_000).selectExpr("id % 1000 AS k", "id AS v")
    warm.groupBy("k").agg({"v": "sum"}).join(warm.selectExpr("k", "v * 2 AS w"), "k") \
        .selectExpr("sum(w)").collect()
    t = time.time()
    src = sources_from_lineitem(spark, SF_DIR)
    tables = {"daily_prices": src.daily_prices, "sii_dividend": src.sii_dividend,
              "otc_dividend": src.otc_dividend, "monthly_revenue": src.monthly_revenue,
              "income_statement": src.income_statement, "balance_sheet": src.balance_sheet}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{out_dir}/src/{name}")
    read = Sources(**{k: read_table(spark, f"{out_dir}/src/{k}") for k in tables},
                   corporate_actions=src.corporate_actions)
    prep = round(time.time() - t, 3)
    build = Build(spark, read, out_dir=out_dir)
    times = {}
    t_all = time.time()
    for name, models in HEADLINE.items():
        t = time.time()
        for m in models:
            build[m]
        times[name] = round(time.time() - t, 3)
    total = round(time.time() - t_all, 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_build_total", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": CPUS, "source_prep_sec": prep, "out_dir": out_dir}))


if __name__ == "__main__":
    main()
