"""Data-quality checks Q1-Q5: each returns the violating rows (empty = pass).

The checks of single rows (Q2, Q3, Q5) can also be counted while a table is
written (``watch``): the counts cost no further scan, and the violating rows
need fetching only where a count is above zero.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys=("date", "ticker")) -> DataFrame:
    """Q1/Q4: keys occurring more than once (partial aggregation map-side)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
            .filter(F.col("cnt") > 1))


def today_in(zone: str) -> Column:
    """CURRENT_DATE(zone), independent of the session time zone."""
    return F.to_date(F.convert_timezone(None, F.lit(zone), F.localtimestamp()))


def _any_null(keys) -> Column:
    cond = F.col(keys[0]).isNull()
    for k in keys[1:]:
        cond = cond | F.col(k).isNull()
    return cond


def row_conditions(zone: str = "Asia/Taipei", as_of: dt.date | None = None, volume: str = "d_vol",
                   keys=("date", "ticker")) -> dict[str, Column]:
    """What violates the checks of single rows, by check."""
    limit = F.lit(as_of) if as_of is not None else today_in(zone)
    return {"no_future_date": F.col("date") > limit, "no_negative_volume": F.col(volume) < 0,
            "not_null_keys": _any_null(keys)}


def future_dates(df: DataFrame, zone: str = "Asia/Taipei", as_of: dt.date | None = None) -> DataFrame:
    """Q2: rows dated after today in the market's time zone (or ``as_of``)."""
    return df.filter(row_conditions(zone, as_of)["no_future_date"])


def negative_volume(df: DataFrame, col: str = "d_vol") -> DataFrame:
    """Q3: rows with a negative volume."""
    return df.filter(row_conditions(volume=col)["no_negative_volume"])


def null_keys(df: DataFrame, keys=("date", "ticker")) -> DataFrame:
    """Q5: rows with a NULL key column."""
    return df.filter(_any_null(keys))


class Watch:
    """Counts of the rows that pass through ``on`` and of those that violate each condition, known once they were written.

    ``on`` belongs into the stage that writes: Spark counts the tasks of a
    result stage once each, however often executors are lost."""

    def __init__(self, conditions: dict[str, Column]):
        self.conditions, self.seen = conditions, Observation()

    def on(self, df: DataFrame) -> DataFrame:
        counts = [F.count_if(c).alias(name) for name, c in self.conditions.items()]
        return df.observe(self.seen, F.count(F.lit(1)).alias("rows"), *counts)

    def counts(self) -> dict[str, int]:
        return dict(self.seen.get)

    def violations(self, stored: DataFrame) -> dict[str, DataFrame]:
        """The violating rows of the written table, for the conditions that any row violates."""
        counts = self.counts()
        return {name: stored.filter(c) for name, c in self.conditions.items() if counts[name]}
