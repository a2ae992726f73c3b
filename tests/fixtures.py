"""Hand-made micro-fixtures in the raw source schemas."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from pitpanel.sources import schemas
from pitpanel.sources.readers import Sources

D = dt.date


def prices(spark: SparkSession, rows):
    """rows: (ticker, date_text, close[, volume])"""
    full = [(t, d, c, c, c, c, (r[0] if r else 1)) for t, d, c, *r in rows]
    return spark.createDataFrame(full, schemas.DAILY_PRICES)


def dividends(spark: SparkSession, rows):
    """rows: (ticker, ex_date, ref_text, pre_text)"""
    return spark.createDataFrame(rows, schemas.DIVIDEND)


def empty(spark: SparkSession, schema: T.StructType):
    return spark.createDataFrame([], schema)


def actions(spark: SparkSession, rows):
    return spark.createDataFrame([(*r, "") for r in rows], schemas.CORPORATE_ACTIONS)


def income(spark: SparkSession, rows):
    """rows: (ticker, year_quarter, revenue, operating_income, net_income, eps) as numbers."""
    sch = T.StructType([T.StructField(n, T.StringType() if n in ("ticker", "company_name", "year_quarter")
                                      else T.DoubleType()) for n in schemas.INCOME_STATEMENT.names])
    out = []
    for t, yq, rev, op, ni, eps in rows:
        vals = {m: 0.0 for m in schemas.INCOME_MEASURES}
        vals.update(revenue=rev, operating_income=op, net_income=ni, eps=eps)
        out.append((t, "co", yq, *[vals[m] for m in schemas.INCOME_MEASURES]))
    return spark.createDataFrame(out, sch)


def sources(spark: SparkSession, **kw) -> Sources:
    base = dict(daily_prices=empty(spark, schemas.DAILY_PRICES), sii_dividend=empty(spark, schemas.DIVIDEND),
                otc_dividend=empty(spark, schemas.DIVIDEND),
                monthly_revenue=empty(spark, schemas.MONTHLY_REVENUE),
                income_statement=empty(spark, schemas.INCOME_STATEMENT),
                balance_sheet=empty(spark, schemas.BALANCE_SHEET),
                corporate_actions=empty(spark, schemas.CORPORATE_ACTIONS))
    base.update(kw)
    return Sources(**base)
