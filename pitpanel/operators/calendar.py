"""Trading calendar and forward as-of alignment of report deadlines.

A report becomes visible on the first trading date on or after its
publication deadline.  That depends on the deadline only, so instead of the
literal inequality join + MIN per report, the calendar is expanded into a
dense day -> next-trading-day map and reports find their date through an
equi join on the deadline against the broadcast map.  The map has one row per
day: dates lie in the years 1 to 9999, so it never exceeds 3.7 million rows of
two dates, however many facts there are; this bound is what allows the
broadcast (reports crowd on a few deadline days, so a shuffle on the day would
put nearly all of them into a few tasks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def trading_calendar(daily: DataFrame, date_col: str = "date") -> DataFrame:
    """SELECT DISTINCT date (partial aggregation map-side)."""
    return daily.select(F.col(date_col).alias("date")).distinct()


class TradingDayMap:
    """Every calendar day between the first and last trading date mapped to
    the first trading date on or after it.

    Consecutive trading dates ``(prev, date]`` expand into the days they cover.
    The ordering window has no partition key: its input is the distinct-date
    calendar (<= 366 rows per year of history), never the facts.  Nothing is
    computed before the query that uses the map runs.
    """

    def __init__(self, calendar: DataFrame):
        steps = calendar.select("date", F.lag("date").over(Window.orderBy("date")).alias("_prev"))
        start = F.coalesce(F.date_add("_prev", 1), F.col("date"))
        self.table = steps.select(F.explode(F.sequence(start, F.col("date"))).alias("_day"),
                                  F.col("date").alias("aligned_date"))
        self.first = calendar.agg(F.min("date").alias("_first_day"))

    def lookup(self) -> DataFrame:
        return F.broadcast(self.table)

    def first_day(self) -> Column:
        """The first trading date, as a scalar subquery (NULL without one)."""
        return self.first.scalar()


def align_to_calendar(events: DataFrame, days: TradingDayMap, box_col: str,
                      box_fields: list[str]) -> DataFrame:
    """Date each (ticker, deadline_date, box) row.

    The first trading date on or after the deadline, found by an equi join on
    the day (deadlines before the first trading date map to it, Quirk 4; past
    the last one there is none).  Rows whose box has a NULL or NaN field (or a
    NULL ticker) never match in the reference's struct-equality self join, so they
    keep the raw deadline (trap T1), as do unmatched deadlines.
    """
    complete: Column = F.col("ticker").isNotNull()
    kinds = {f.name: f.dataType.simpleString() for f in events.schema[box_col].dataType}
    for f in box_fields:
        value = F.col(box_col).getField(f)
        complete = complete & value.isNotNull()
        if kinds[f] in ("double", "float"):
            complete = complete & ~F.isnan(value)
    lk = days.lookup()
    # (greatest() skips NULLs: a NULL deadline must stay unmatched)
    key = F.when(F.col("deadline_date").isNotNull(), F.greatest(F.col("deadline_date"), days.first_day()))
    joined = events.withColumn("_key", key).join(lk, F.col("_key") == F.col("_day"), "left")
    date = F.when(complete, F.coalesce(F.col("aligned_date"), F.col("deadline_date"))) \
            .otherwise(F.col("deadline_date"))
    return joined.select(date.alias("date"), "ticker", box_col)
