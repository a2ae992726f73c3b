"""Readers for the six raw sources and the corporate-action seed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pitpanel.sources import schemas


@dataclass
class Sources:
    """The six raw tables plus the corporate-action seed, as DataFrames."""
    daily_prices: DataFrame
    sii_dividend: DataFrame
    otc_dividend: DataFrame
    monthly_revenue: DataFrame
    income_statement: DataFrame
    balance_sheet: DataFrame
    corporate_actions: DataFrame


SOURCE_TABLES = ("daily_prices_partitioned", "sii_dividend", "otc_dividend",
                 "monthly_revenue", "income_statement", "balance_sheet")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; the schema comes from the files, so columns beyond the
    ones the models read pass through ``SELECT *``-style projections."""
    return spark.read.parquet(path)


def read_corporate_actions(spark: SparkSession, path: str) -> DataFrame:
    """Seed CSV with fixed column types (ticker stays text: ``0050``)."""
    return (spark.read.schema(schemas.CORPORATE_ACTIONS)
            .option("header", True).option("encoding", "UTF-8").option("mode", "FAILFAST")
            .csv(path))


def read_sources(spark: SparkSession, root: str, seed_path: str) -> Sources:
    """Read ``<root>/<table>`` for each source (Parquet directories/files)."""
    t = {name: read_table(spark, f"{root}/{name}") for name in SOURCE_TABLES}
    return Sources(daily_prices=t["daily_prices_partitioned"], sii_dividend=t["sii_dividend"],
                   otc_dividend=t["otc_dividend"], monthly_revenue=t["monthly_revenue"],
                   income_statement=t["income_statement"], balance_sheet=t["balance_sheet"],
                   corporate_actions=read_corporate_actions(spark, seed_path))
