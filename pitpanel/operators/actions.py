"""Corporate-action factors (correlated range subquery -> interval join).

The reference multiplies, for each fact row, the factors of every action of
its ticker whose ``effective_date`` is strictly after the row's date.  That is a
step function of the date per ticker: between two consecutive effective dates
the product is constant.  The seed is turned into those steps
(``[prev_effective, effective)`` -> suffix product) and joined to the facts on
``ticker`` with a range condition.  The planner and AQE choose the join from the
table's size: a hand-maintained seed is broadcast, a larger one meets the facts
on the ticker partitioning that their windows need anyway.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def action_steps(actions: DataFrame, factor_cols: list[str]) -> DataFrame:
    """One row per (ticker, effective date) holding, for each factor, the
    summed logs of all actions effective on or after that date, and the
    half-open date range ``[lo, hi)`` where that product applies.

    A factor of 0 or below has no logarithm and stops the job."""
    ln = lambda c: F.ln(F.when(F.col(c) <= 0, F.raise_error(F.lit(f"{c} of a corporate action must be positive")).cast("double"))
                        .otherwise(F.col(c)))
    per_day = actions.groupBy("ticker", "effective_date").agg(
        *[F.sum(ln(c)).alias(f"_ln_{c}") for c in factor_cols])
    suffix = Window.partitionBy("ticker").orderBy(F.col("effective_date").desc()) \
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev = Window.partitionBy("ticker").orderBy("effective_date")
    return per_day.select(
        F.col("ticker").alias("_a_ticker"),
        F.lag("effective_date").over(prev).alias("_a_lo"),
        F.col("effective_date").alias("_a_hi"),
        *[F.exp(F.sum(f"_ln_{c}").over(suffix)).alias(f"_f_{c}") for c in factor_cols])


def all_steps(actions: DataFrame) -> DataFrame:
    """Step table for all three factors."""
    return action_steps(actions, ["price_factor", "per_share_factor", "share_factor"])


def with_action_factors(df: DataFrame, actions: DataFrame, date_col, out: dict[str, str],
                        steps: DataFrame | None = None) -> DataFrame:
    """Add ``out_name = COALESCE(prod(factor of actions with date < effective), 1.0)``.

    ``out`` maps output column -> seed factor column.  ``date_col`` may be a
    column name or an expression; a NULL date matches nothing (factor 1.0).
    ``actions`` is the seed, or a step table from ``all_steps``.
    """
    if steps is None and "_a_ticker" in actions.columns:
        steps = actions
    factors = sorted(set(out.values()))
    if steps is None:
        steps = action_steps(actions, factors)
    steps = steps.select("_a_ticker", "_a_lo", "_a_hi", *[f"_f_{c}" for c in factors])
    probe = df.withColumn("_a_date", F.col(date_col) if isinstance(date_col, str) else date_col)
    cond = ((probe["ticker"] == steps["_a_ticker"])
            & (steps["_a_lo"].isNull() | (probe["_a_date"] >= steps["_a_lo"]))
            & (probe["_a_date"] < steps["_a_hi"]))
    joined = probe.join(steps, cond, "left")
    for name, factor in out.items():
        joined = joined.withColumn(name, F.coalesce(F.col(f"_f_{factor}"), F.lit(1.0)))
    return joined.drop("_a_ticker", "_a_lo", "_a_hi", "_a_date", *[f"_f_{c}" for c in factors])
