"""Two-stage DCF surface and its PE -> implied-growth lookup grid.

Both are generated from configuration only (a few thousand rows), computed
with ordinary DataFrame operators and small enough to broadcast; their size
is fixed by the grid parameters, never by the fact data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitpanel.config import DEFAULT, PanelConfig
from pitpanel.operators.nearest import nearest_match

SURFACE_KEYS = ["growth_pct", "discount_pct", "terminal_pct", "high_growth_years", "estimate_years"]


def _axis(values):
    return F.explode(F.array(*[F.lit(v).cast("bigint") for v in values]))


def dcf_surface(spark: SparkSession, cfg: PanelConfig = DEFAULT) -> DataFrame:
    """Implied PE for each (growth, discount, terminal, high-growth years,
    estimate years): sum of discounted explicit-period EPS multipliers plus a
    Gordon terminal value."""
    one = spark.range(1, numPartitions=1)
    params = (one.select(F.explode(F.sequence(F.lit(cfg.growth_pct_lo).cast("bigint"),
                                              F.lit(cfg.growth_pct_hi).cast("bigint"))).alias("growth_pct"))
              .withColumn("discount_pct", _axis(cfg.discount_pcts))
              .withColumn("terminal_pct", _axis(cfg.terminal_pcts))
              .withColumn("high_growth_years", _axis(cfg.high_growth_years))
              .withColumn("estimate_years", _axis(cfg.estimate_years))
              .withColumn("growth_rate", F.col("growth_pct") / F.lit(100.0))
              .withColumn("discount_rate", F.col("discount_pct") / F.lit(100.0))
              .withColumn("terminal_growth_rate", F.col("terminal_pct") / F.lit(100.0)))
    max_years = max(cfg.estimate_years)
    flows = (params.withColumn("year", F.explode(F.sequence(F.lit(1).cast("bigint"),
                                                            F.lit(max_years).cast("bigint"))))
             .filter(F.col("year") <= F.col("estimate_years"))
             .withColumn("year_growth_rate",
                         F.when(F.col("year") <= F.col("high_growth_years"), F.col("growth_rate"))
                          .otherwise(F.col("terminal_growth_rate"))))
    w = Window.partitionBy(*SURFACE_KEYS).orderBy("year")
    flows = flows.withColumn("compound", F.exp(F.sum(F.ln(F.lit(1.0) + F.col("year_growth_rate"))).over(w)))
    flows = flows.withColumn("pv", F.col("compound") / F.pow(F.lit(1.0) + F.col("discount_rate"), F.col("year")))
    summary = flows.groupBy(*SURFACE_KEYS, "growth_rate", "discount_rate", "terminal_growth_rate").agg(
        F.sum("pv").alias("explicit_pe_multiplier"),
        F.max(F.when(F.col("year") == F.col("estimate_years"), F.col("compound"))).alias("final_mult"))
    summary = summary.filter(F.col("discount_rate") > F.col("terminal_growth_rate"))
    terminal = (F.col("final_mult") * (F.lit(1.0) + F.col("terminal_growth_rate"))
                / F.nullif(F.col("discount_rate") - F.col("terminal_growth_rate"), F.lit(0.0))
                / F.pow(F.lit(1.0) + F.col("discount_rate"), F.col("estimate_years")))
    return summary.select(
        "growth_rate", F.col("growth_pct").alias("growth_rate_pct"),
        "discount_rate", F.col("discount_pct").alias("discount_rate_pct"),
        "terminal_growth_rate", F.col("terminal_pct").alias("terminal_growth_rate_pct"),
        "high_growth_years", "estimate_years", "explicit_pe_multiplier",
        terminal.alias("terminal_pe_multiplier"),
        (F.col("explicit_pe_multiplier") + terminal).alias("implied_pe"))


LOOKUP_GROUP = ["discount_rate_pct", "terminal_growth_rate_pct", "high_growth_years", "estimate_years"]


def dcf_lookup(spark: SparkSession, surface: DataFrame, cfg: PanelConfig = DEFAULT) -> DataFrame:
    """For each PE on the 0.1 grid and each parameter set: the growth whose
    implied PE is nearest (ties: lower growth)."""
    grid = (spark.range(cfg.pe_x10_lo, cfg.pe_x10_hi + 1, numPartitions=1)
            .select(F.col("id").cast("bigint").alias("pe_x10"))
            .withColumn("pe_rounded", F.col("pe_x10") / F.lit(10.0)))
    cands = surface.filter(F.col("implied_pe").isNotNull() & (F.col("implied_pe") > 0))
    m = nearest_match(grid, "pe_rounded", cands, "implied_pe", LOOKUP_GROUP, ["growth_rate_pct"],
                      {"implied_growth_pct": "growth_rate_pct", "implied_pe": "implied_pe"}, how="inner")
    return m.select("pe_x10", "pe_rounded", *LOOKUP_GROUP, "implied_growth_pct",
                    (F.col("implied_growth_pct") / F.lit(100.0)).alias("implied_growth"),
                    "implied_pe", F.abs(F.col("pe_rounded") - F.col("implied_pe")).alias("pe_diff"))
