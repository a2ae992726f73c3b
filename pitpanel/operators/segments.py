"""Blocks of long tickers: ordered computations that no ticker keeps in one task.

Windows over a ticker's history run in the task that holds the ticker.  A ticker
with more than a fixed share of all rows is therefore cut into *blocks*:
consecutive date ranges of about equal row counts.  Windows partition by
(ticker, block) and what crosses a block's edge is added:

* sums and last values: one summary per block, combined over the blocks before
  (or after) it by a window over summaries (a segmented scan);
* bounded frames: the last or first n rows of the neighbouring blocks (halo
  rows), which take part in the windows and are dropped afterwards.

A ticker is cut when it holds more than ``max(least, all rows / PIECES)`` rows,
so at most ``PIECES`` tickers are cut, into at most ``2 * PIECES`` blocks,
however large the data: that bound is what allows the broadcast of the block
starts.  With more ``pieces`` tickers and blocks grow with the data; nothing of
them is broadcast then (the driver would hold it), rows meet their ticker's
starts in a join by hash.  Summaries are rows of the windows in both cases.
Where no ticker is that long, the table is empty and every auxiliary branch
starts with a semi join against it.

Rows of one (ticker, date) always stay in one block.  Rows without a date, or
before the first start, are in block 0; a NULL ticker is a ticker like others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "_block"
PIECES = 1 << 14
LEAST = 1 << 16


class Blocks:
    """Block starts of the tickers that are cut: ``_cut`` (ticker), ``_starts`` (first dates of blocks 1, 2, ...).

    ``halo``: rows that a block needs at least, so that frames reach into the
    next block only (smaller blocks join the one before them).
    ``bounded``: whether ``pieces`` bounds the cut tickers, whatever the data.
    """

    def __init__(self, rows: DataFrame, halo: int, least: int = LEAST, pieces: int = PIECES,
                 key: str = "ticker", time: str = "date"):
        self.key, self.time, self.bounded = key, time, pieces <= PIECES
        k, day = F.col(key).alias("_cut"), F.col(time).alias("_day")
        limit = F.greatest(F.lit(least), F.ceil(rows.agg(F.count(F.lit(1)).alias("n")).scalar() / F.lit(pieces)))
        if self.bounded:
            long = rows.groupBy(k).agg(F.count(F.lit(1)).alias("_n")).withColumn("_limit", limit).filter("_n > _limit")
            long = F.broadcast(long.select("_cut", "_limit"))           # at most `pieces` tickers
            days = (rows.join(long, F.col(key).eqNullSafe(F.col("_cut")))
                    .groupBy("_cut", "_limit", day).agg(F.count(F.lit(1)).alias("_n")))
        else:   # a ticker's days (not its rows) are in one task here as in the windows below
            days = rows.groupBy(k, day).agg(F.count(F.lit(1)).alias("_n")).withColumn("_limit", limit)
            days = days.withColumn("_all", F.sum("_n").over(Window.partitionBy("_cut"))).filter("_all > _limit")
        before = Window.partitionBy("_cut").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
        cut = F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / F.col("_limit"))
        parts = days.withColumn("_part", cut).groupBy("_cut", "_part") \
                    .agg(F.min("_day").alias("_start"), F.sum("_n").alias("_n"))
        parts = parts.filter((F.col("_part") > 0) & (F.col("_n") >= halo) & F.col("_start").isNotNull())
        self.table = parts.groupBy("_cut").agg(F.sort_array(F.collect_list("_start")).alias("_starts"))
        self._steps: int | None = None

    @classmethod
    def of(cls, table: DataFrame, key: str = "ticker", time: str = "date", bounded: bool = True) -> Blocks:
        """Blocks from a stored ``table``."""
        out = cls.__new__(cls)
        out.key, out.time, out.table, out.bounded, out._steps = key, time, table, bounded, None
        return out

    def _joined(self, df: DataFrame, how: str) -> DataFrame:
        # by hash, a task holds the starts of its tickers: a date for `least` rows or so
        table = F.broadcast(self.table) if self.bounded else self.table.hint("shuffle_hash")
        return df.join(table, F.col(self.key).eqNullSafe(F.col("_cut")), how)

    def tag(self, df: DataFrame) -> DataFrame:
        """``df`` with its rows' block."""
        return self._numbered(self._joined(df, "left"))

    def _numbered(self, joined: DataFrame) -> DataFrame:
        out = joined.withColumn(BLOCK, F.lit(0))
        # found by halving, a step a column: a row looks at log2 of the starts and not at all of them (one step at least, as
        # the windows would not share the exchange on a block that the optimizer sees to be constant)
        for k in reversed(range(max(self.steps, 1))):
            passed = F.get("_starts", F.col(BLOCK) + F.lit((1 << k) - 1)) <= F.col(self.time)
            out = out.withColumn(BLOCK, F.col(BLOCK) + F.when(passed, F.lit(1 << k)).otherwise(F.lit(0)))
        return out.drop("_cut", "_starts")

    @property
    def steps(self) -> int:
        """Steps that find a row's block: the binary digits of the largest number of starts, read once."""
        if self._steps is None:
            most = self.table.agg(F.max(F.size("_starts"))).first()[0]
            self._steps = (most or 0).bit_length()
        return self._steps

    def only(self, df: DataFrame) -> DataFrame:
        """The rows of tickers that are cut."""
        return self._joined(df, "left_semi")

    def cut(self, *parts: DataFrame) -> DataFrame:
        """The rows of tickers that are cut, of all ``parts``, with their block."""
        union = lambda dfs: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
        if self.bounded:    # the semi joins reach the parts' scans
            return self.tag(union(map(self.only, parts)))
        return self._numbered(self._joined(union(parts), "inner"))      # rows are dealt once

    def each(self) -> DataFrame:
        """``ticker, _block, _start`` of every block but the first."""
        return self.table.select(F.col("_cut").alias(self.key), F.posexplode("_starts").alias("_i", "_start")) \
                         .select(self.key, (F.col("_i") + 1).cast("int").alias(BLOCK), "_start")

    def last_rows(self, tagged: DataFrame, n: int, order_desc: list[Column]) -> DataFrame:
        """The last n rows of each block, as rows of the next block."""
        w = Window.partitionBy(self.key, BLOCK).orderBy(*order_desc)
        return tagged.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r") \
                     .withColumn(BLOCK, (F.col(BLOCK) + 1).cast("int"))

    def next_rows(self, tagged: DataFrame, n: int) -> DataFrame:
        """The first n rows after each block in time order, as rows of that block.

        Blocks with fewer than n rows are reached over: a block's first rows
        go to every block before it that has fewer than n rows in between, of
        which a window over blocks sees the numbers only."""
        first = Window.partitionBy(self.key, BLOCK).orderBy(self.time)
        head = tagged.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= n).drop("_r")
        row = F.struct(self.time, *[c for c in tagged.columns if c not in (self.key, BLOCK, self.time)])
        heads = head.groupBy(self.key, BLOCK).agg(F.sort_array(F.collect_list(row)).alias("_rows"))    # n rows at most
        blocks = Window.partitionBy(self.key).orderBy(BLOCK)
        through = F.sum(F.size("_rows")).over(blocks.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        behind = F.collect_list(F.struct(F.col(BLOCK).alias("b"), F.col("_through").alias("n"))).over(blocks.rowsBetween(-n, -1))
        heads = heads.withColumn("_through", through).withColumn("_behind", behind)
        between = lambda to: F.col("_through") - F.size("_rows") - to["n"]
        taken = heads.withColumn("_to", F.explode(F.filter("_behind", lambda to: between(to) < n)))
        rows = F.slice("_rows", F.lit(1), (F.lit(n) - between(F.col("_to"))).cast("int"))
        return taken.select(self.key, F.col("_to.b").alias(BLOCK), F.explode(rows).alias("_row")).select(self.key, BLOCK, "_row.*")

    def later_sum(self, sums: DataFrame, value: str, out: str) -> DataFrame:
        """``ticker, _block, out``: for each block the sum of ``value`` (one row a block) over the blocks after it."""
        after = Window.partitionBy(self.key).orderBy(F.col(BLOCK).desc()).rowsBetween(Window.unboundedPreceding, -1)
        return sums.select(self.key, BLOCK, F.sum(value).over(after).alias(out))

    def entering(self, ends: DataFrame, fields: list[str]) -> DataFrame:
        """``ticker, _block, _start, fields``: the last non-NULL value of each field before the block's start.

        ``ends``: the last non-NULL values within each block (no row: none)."""
        # a block's values enter the next one, as a row before that block's own
        moved = ends.select(self.key, (F.col(BLOCK) + 1).cast("int").alias(BLOCK), *fields)
        state = self.each().unionByName(moved, allowMissingColumns=True)
        before = Window.partitionBy(self.key).orderBy(BLOCK, F.col("_start").asc_nulls_first()) \
                       .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return state.select(self.key, BLOCK, "_start",
                            *[F.last(f, ignorenulls=True).over(before).alias(f) for f in fields]).filter("_start IS NOT NULL")
