"""Nearest and as-of matches against candidates of any number, by sorted merge.

``operators.nearest`` broadcasts an interval table, which only a parameter grid
of configured size allows.  Here neither side is broadcast or held: distinct
probe values and candidates are sorted together, and every value takes the last
candidate at or before it and the first one at or after it.

Groups are cut into blocks at approximate quantiles of all their values, so a
group of any size spreads over tasks: neighbours are found within a block by
running windows (one for either direction), and a block's first and last
candidates, one row a block, are carried over empty stretches by a window over
blocks.  Equal probe values are one row until the result is joined back, and
equal candidate values one candidate, whatever their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The key of the one group where there are no groups.
ALL = "_all"
#: Blocks of a group at most.
PIECES = 256
#: A group of fewer values stays one block.
LEAST = 1 << 16


def _usable(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def _edges(values: DataFrame, groups: list[str], pieces: int, least: int) -> DataFrame:
    """``groups, _edges``: the first values of blocks 1, 2, ... of each group that is large enough."""
    shares = F.array(*[F.lit(k / pieces) for k in range(1, pieces)])
    cut = values.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", shares, 20 * pieces).alias("_edges"))
    return cut.filter(F.col("_n") >= least).select(*groups, F.array_distinct("_edges").alias("_edges"))


def _with_block(rows: DataFrame, pieces: int) -> DataFrame:
    """``rows`` with ``_block``: how many of their ``_edges`` (sorted, fewer than ``pieces``; NULL: none) are at or below ``_v``.

    Found by halving, a step a column, so a row looks at log2 of the edges and not at all of them."""
    out = rows.withColumn("_block", F.lit(0))
    for k in reversed(range((pieces - 1).bit_length())):
        passed = F.get("_edges", F.col("_block") + F.lit((1 << k) - 1)) <= F.col("_v")
        out = out.withColumn("_block", F.col("_block") + F.when(passed, F.lit(1 << k)).otherwise(F.lit(0)))
    return out


def neighbours(values: DataFrame, candidates: DataFrame, groups: list[str], pieces: int = PIECES, least: int = LEAST) -> DataFrame:
    """``groups, _v, _prev, _next`` for each row of ``values`` (``groups, _v``, distinct).

    ``candidates``: ``groups, _v, _item`` with distinct values in a group.
    ``_prev``: the item of the largest candidate value at or below ``_v``,
    ``_next``: of the smallest at or above it; NULL where there is none."""
    item = candidates.schema["_item"].dataType
    rows = candidates.select(*groups, "_v", "_item", F.lit(0).alias("_kind")).unionByName(
        values.select(*groups, "_v", F.lit(None).cast(item).alias("_item"), F.lit(1).alias("_kind")))
    edges = _edges(rows, groups, pieces, least)
    if groups == [ALL]:   # one row of at most `pieces` numbers
        edges = F.broadcast(edges)
    rows = _with_block(rows.join(edges, groups, "left"), pieces).drop("_edges")
    keys = [*groups, "_block"]
    # candidates stand before probes of their value upwards, and again downwards
    up = Window.partitionBy(*keys).orderBy("_v", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*keys).orderBy(F.col("_v").desc(), "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = rows.withColumn("_prev", F.last("_item", ignorenulls=True).over(up)) \
               .withColumn("_next", F.last("_item", ignorenulls=True).over(down)).filter("_kind = 1")
    # the last candidate of the blocks before, the first of those after: sums by block combine before the shuffle
    ends = rows.groupBy(*keys).agg(F.max_by("_item", F.when(F.col("_kind") == 0, F.col("_v"))).alias("_last"),
                                   F.min_by("_item", F.when(F.col("_kind") == 0, F.col("_v"))).alias("_first"))
    before = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*groups).orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, F.last("_last", ignorenulls=True).over(before).alias("_c_prev"),
                          F.last("_first", ignorenulls=True).over(after).alias("_c_next"))
    out = near.join(carried, keys, "left")
    return out.select(*groups, "_v", F.coalesce("_prev", "_c_prev").alias("_prev"), F.coalesce("_next", "_c_next").alias("_next"))


def _sides(probe: DataFrame, x, candidates: DataFrame, value_col: str, keep: list[str], order: list[str], groups: list[str]):
    value = F.col(value_col).cast("double") + F.lit(0.0)              # -0.0 is 0.0
    c = candidates.withColumn("_v", value).filter(_usable(F.col("_v")))
    if not groups:
        c = c.withColumn(ALL, F.lit(0))
    keys = groups or [ALL]
    # of equal values only the smallest tiebreak can ever win
    c = c.groupBy(*keys, "_v").agg(F.min(F.struct(*[F.col(k) for k in [*order, *[k for k in keep if k not in order]]])).alias("_item"))
    column = (F.col(x) if isinstance(x, str) else x).cast("double") + F.lit(0.0)
    p = probe.withColumn("_x", column)
    if not groups:
        p = p.withColumn(ALL, F.lit(0))
    values = p.filter(_usable(F.col("_x"))).select(*keys, F.col("_x").alias("_v")).distinct()
    return p, values, c.select(*keys, "_v", F.struct(F.col("_v").alias("v"), F.col("_item").alias("i")).alias("_item")), keys


def _joined(probe: DataFrame, p: DataFrame, found: DataFrame, keys: list[str], payload: dict[str, str], how: str) -> DataFrame:
    marks = [f"_k{i}" for i in range(len(keys))]
    found = found.select(*[F.col(k).alias(m) for k, m in zip(keys, marks, strict=True)], F.col("_v").alias("_vx"), "_best")
    cond = F.col("_x") == F.col("_vx")
    for k, m in zip(keys, marks, strict=True):
        cond = cond & (F.col(k) == F.col(m))
    j = p.join(found, cond, how)
    return j.select(*[F.col(c) for c in probe.columns], *[F.col("_best").getField(src).alias(dst) for dst, src in payload.items()])


def nearest_by_merge(probe: DataFrame, x, candidates: DataFrame, value_col: str, tiebreak_cols: list[str],
                     payload: dict[str, str], groups: list[str] | None = None, how: str = "left", **sizes) -> DataFrame:
    """Per probe row the payload of the candidate of its group (``groups``: columns of both sides; none: one group)
    whose value is nearest to ``x``; ties: the smaller tiebreak."""
    keep = list(dict.fromkeys([*payload.values()]))
    p, values, c, keys = _sides(probe, x, candidates, value_col, keep, list(tiebreak_cols), list(groups or []))
    found = neighbours(values, c, keys, **sizes)

    def scored(side: str) -> Column:
        s = F.col(side)
        return F.when(s.isNotNull(), F.struct(F.abs(F.col("_v") - s.getField("v")).alias("d"), s.getField("i").alias("i")))

    best = F.least(scored("_prev"), scored("_next")).getField("i")
    return _joined(probe, p, found.withColumn("_best", best), keys, payload, how)


def first_at_or_after(probe: DataFrame, x, candidates: DataFrame, value_col: str, tiebreak_cols: list[str],
                      payload: dict[str, str], groups: list[str] | None = None, how: str = "left", **sizes) -> DataFrame:
    """Per probe row the payload of its group's first candidate at or after ``x`` (as-of, forward)."""
    keep = list(dict.fromkeys([*payload.values()]))
    p, values, c, keys = _sides(probe, x, candidates, value_col, keep, list(tiebreak_cols), list(groups or []))
    found = neighbours(values, c, keys, **sizes)
    return _joined(probe, p, found.withColumn("_best", F.col("_next").getField("i")), keys, payload, how)
