"""Per-ticker time-series windows.

Every window here is partitioned by ``ticker`` and ordered by time, so a chain
of them costs one hash exchange on ticker and shares sorts.  ``key`` names the
partitioning columns: (ticker, block) where ``operators.segments`` cuts long
tickers into blocks, with halo rows and summaries for what crosses their edges.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def by_key(order, key="ticker") -> WindowSpec:
    keys = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, (str, Column)) else list(order)
    return Window.partitionBy(*keys).orderBy(*order)


def trailing_rows(order, n: int, key="ticker") -> WindowSpec:
    """ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW."""
    return by_key(order, key).rowsBetween(-(n - 1), Window.currentRow)


def running(order, key="ticker") -> WindowSpec:
    """ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW."""
    return by_key(order, key).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def rolling_mean(col, order, n: int, key="ticker") -> Column:
    """AVG over the last n rows; shorter prefixes still give a value."""
    return F.avg(col).over(trailing_rows(order, n, key))


def gated_sum(col, order, n: int, key="ticker") -> Column:
    """SUM over the last n rows, only when all n rows hold a non-NULL value."""
    w = trailing_rows(order, n, key)
    return F.when(F.count(col).over(w) == n, F.sum(col).over(w))


def forward_fill(col, order, key="ticker") -> Column:
    """LAST_VALUE(col IGNORE NULLS) over the running frame."""
    return F.last(col, ignorenulls=True).over(running(order, key))


def lead_return(price, order, n: int, key="ticker") -> Column:
    """SAFE_DIVIDE(LEAD(price, n), price) - 1 (row based)."""
    ahead = F.lead(price, n).over(by_key(order, key))
    return F.try_divide(ahead, F.col(price) if isinstance(price, str) else price) - F.lit(1.0)


def reverse_log_sum(factor, order_desc, key="ticker", carried=None) -> Column:
    """SUM(LN(f)) over rows from the latest down to the current one; its EXP is
    the reverse cumulative product.  ``carried``: a column with the logarithm
    itself, of rows that hold a sum so far (NULL in others)."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order_desc).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return F.sum(F.ln(factor) if carried is None else F.coalesce(carried, F.ln(factor))).over(w)
