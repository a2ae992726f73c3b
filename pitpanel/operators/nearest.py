"""Nearest-match join without row explosion.

For every probe row and every candidate group, pick the candidate whose value
is closest to the probe value (ties: smaller tiebreak wins).  The literal form
is a theta join of every probe row with every candidate followed by a top-1
window; its cost is |probe| x |candidates|.

Here the candidates of each group are sorted by value and turned into
disjoint intervals ``(lo, hi]`` around each candidate (midpoints between
neighbours).  Intervals are exploded over coarse buckets of an order-preserving
transform of the value, so a probe row finds its interval with a broadcast
*hash* join on the bucket plus a range check: each probe row meets only the
one or two intervals overlapping its bucket.  The winner is then confirmed
exactly among the interval's candidate and its two neighbours with the real
``|x - v|`` arithmetic, so rounding at a midpoint cannot change the answer.

The candidates must be a parameter grid whose size configuration fixes, as the
interval table is broadcast; its rows are at most ``groups * (BUCKETS + 4 *
candidates of a group)``.  No job runs before the query itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Buckets per unit of the transformed value, and the largest one (asinh of about 4.4 million); what lies beyond
#: shares the outermost buckets.
SCALE = 64
LAST = 16 * SCALE


def _g(x):
    # order-preserving, defined on all reals, log-like for large values
    return F.asinh(x)


def interval_table(candidates: DataFrame, value_col: str, group_cols: list[str],
                   tiebreak_cols: list[str], payload_cols: list[str]):
    """One row per (group, bucket, candidate interval)."""
    keep = list(dict.fromkeys([value_col, *tiebreak_cols, *payload_cols]))
    # a configured grid: in one partition its windows need no exchange
    c = candidates.filter(F.col(value_col).isNotNull()).select(*group_cols, *keep).coalesce(1)
    # equal values: only the smallest tiebreak can ever win
    first = Window.partitionBy(*group_cols, value_col).orderBy(*tiebreak_cols)
    c = c.withColumn("_r", F.row_number().over(first)).filter("_r = 1").drop("_r")
    item = F.struct(*[F.col(k) for k in keep])
    w = Window.partitionBy(*group_cols).orderBy(value_col)
    c = (c.withColumn("_cur", item)
          .withColumn("_prev", F.lag("_cur").over(w))
          .withColumn("_next", F.lead("_cur").over(w)))
    v = F.col(value_col)
    lo = (F.col("_prev").getField(value_col) + v) / F.lit(2.0)
    hi = (v + F.col("_next").getField(value_col)) / F.lit(2.0)
    edge = lambda x, slack: F.least(F.lit(LAST), F.greatest(F.lit(-LAST), F.floor(_g(x) * SCALE) + slack))
    b_lo = F.when(lo.isNull(), F.lit(-LAST)).otherwise(edge(lo, -1))
    b_hi = F.when(hi.isNull(), F.lit(LAST)).otherwise(edge(hi, 1))
    return c.select(*group_cols, "_prev", "_cur", "_next", lo.alias("_lo"), hi.alias("_hi"),
                    F.explode(F.sequence(b_lo.cast("bigint"), b_hi.cast("bigint"))).alias("_bucket"))


class NearestIndex:
    """Interval table of a parameter grid, broadcast to every probe."""

    def __init__(self, candidates: DataFrame, value_col: str, group_cols: list[str],
                 tiebreak_cols: list[str], payload_cols: list[str]):
        self.value_col, self.group_cols = value_col, list(group_cols)
        self.tiebreak_cols, self.payload_cols = list(tiebreak_cols), list(payload_cols)
        self.table = interval_table(candidates, value_col, group_cols, tiebreak_cols, payload_cols)

    def probe(self, probe: DataFrame, x, payload: dict[str, str], how: str = "left",
              where=None, keep_groups: bool = True) -> DataFrame:
        """Attach the payload of the nearest candidate of each (selected) group.

        ``where`` restricts the candidate groups (e.g. one pivot value); with a
        single group the result maps probe rows 1:1 (no shuffle, no agg)."""
        iv = F.broadcast(self.table if where is None else self.table.filter(where))
        xcol = F.col(x) if isinstance(x, str) else x
        p = probe.withColumn("_x", xcol.cast("double"))
        bucket = F.floor(_g(F.col("_x")) * F.lit(SCALE))
        p = p.withColumn("_pb", F.least(F.lit(LAST), F.greatest(F.lit(-LAST), bucket)).cast("bigint"))
        cond = ((p["_pb"] == iv["_bucket"])
                & (iv["_lo"].isNull() | (p["_x"] > iv["_lo"]))
                & (iv["_hi"].isNull() | (p["_x"] <= iv["_hi"])))
        j = p.join(iv, cond, how)
        vc = self.value_col

        def scored(c):
            s = F.col(c)
            return F.when(s.isNotNull(), F.struct(
                F.abs(F.col("_x") - s.getField(vc)).alias("_d"),
                *[s.getField(t).alias(t) for t in self.tiebreak_cols],
                *[s.getField(pc).alias(f"_p_{pc}") for pc in self.payload_cols]))

        best = F.least(scored("_prev"), scored("_cur"), scored("_next"))
        j = j.withColumn("_best", best)
        groups = self.group_cols if keep_groups else []
        return j.select(*[F.col(c) for c in probe.columns], *groups,
                        *[F.col("_best").getField(f"_p_{src}").alias(dst) for dst, src in payload.items()])


def nearest_match(probe: DataFrame, x, candidates: DataFrame, value_col: str,
                  group_cols: list[str], tiebreak_cols: list[str], payload: dict[str, str],
                  how: str = "left") -> DataFrame:
    """Per probe row and candidate group, the payload of the nearest candidate
    (``payload`` maps output column -> candidate column)."""
    idx = NearestIndex(candidates, value_col, group_cols, tiebreak_cols,
                       list(dict.fromkeys(payload.values())))
    return idx.probe(probe, x, payload, how)
