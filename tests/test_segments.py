"""Tickers cut into blocks give what whole-ticker windows give."""

import datetime as dt
import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from pitpanel.config import PanelConfig
from pitpanel.operators import windows as W
from pitpanel.operators.segments import BLOCK, Blocks
from pitpanel.plans import intermediate as I
from pitpanel.plans.dag import Build
from pitpanel.session import ensure_checkpoint_dir
from pitpanel.sources import schemas
from pitpanel.stable import stabilize
from tests import fixtures as fx

D = dt.date
WHOLE = PanelConfig()


def long_and_short(spark, days=900, copies=1, seed=3):
    """Ticker L with 100 times the rows of the 12 others; reports, dividends with copies, splits and gaps."""
    rng = random.Random(seed)
    dates = [D(2008, 11, 3) + dt.timedelta(days=k) for k in range(2 * days) if (D(2008, 11, 3) + dt.timedelta(days=k)).weekday() < 5][:days]
    # a long gap, so that blocks and months fall apart
    dates = dates[: days // 2] + [d + dt.timedelta(days=140) for d in dates[days // 2 :]]
    # copies are equal, as the reference leaves the order of different ones open
    prices = [bar for d in dates for bar in [("L", d.isoformat(), float(rng.randrange(50, 500)), rng.randrange(1, 9))] * copies]
    for k in range(12):
        prices += [(f"S{k}", d.isoformat(), float(rng.randrange(50, 500)), 1) for d in dates[k :: days // 9]]
    prices.append((None, dates[5].isoformat(), 10.0, 1))
    divs = [("L", d, str(rng.randrange(90, 99)), "100") for d in rng.sample(dates, 25)]
    divs += divs[:8] + [("L", divs[0][1], "80", "100"), ("S1", dates[200], "95", "100")]
    months = sorted({(d.year, d.month) for d in dates})
    rev = [(t, "co", f"{y}-{m:02d}", rng.randrange(1, 999), None, None, "1.5", None if rng.random() < 0.3 else f"{rng.randrange(-40, 60)}.5", 1, None, "2")
           for y, m in months for t in ("L", "S2") if rng.random() < 0.8]
    inc = [("L", f"{y}-{q}", 100.0 * q, 10.0 * q, 5.0 * q + rng.random(), float(q)) for y in range(2007, 2013) for q in (1, 2, 3, 4)]
    bal = [("L", "co", "50", "50", "100", "10", "10", "20", "20", "5", "5", str(rng.randrange(20, 90)), "10", f"{y}-{q}")
           for y in range(2007, 2013) for q in (1, 3, 4) for _ in range(rng.choice([1, 2]))]
    return fx.sources(
        spark, daily_prices=fx.prices(spark, prices).repartition(4), sii_dividend=fx.dividends(spark, divs),
        monthly_revenue=spark.createDataFrame(rev, schemas.MONTHLY_REVENUE), income_statement=fx.income(spark, inc),
        balance_sheet=spark.createDataFrame(bal, schemas.BALANCE_SHEET),
        corporate_actions=fx.actions(spark, [("L", dates[90], 0.5, 0.5, 2.0), ("L", dates[-60], 0.25, 0.25, 4.0)]))


def folder(spark):
    return f"{ensure_checkpoint_dir(spark)}/test-segments-{uuid.uuid4().hex[:8]}"


def same(a, b):
    a, b = stabilize(a), stabilize(b)
    assert a.columns == b.columns
    a, b = (sorted(map(str, df.collect())) for df in (a, b))
    assert a == b and a


@pytest.mark.parametrize(("days", "copies", "rows", "models"), [
    (600, 1, 64, ("int_daily_prices_adjusted", "mart_vbt_master_dataset")),
    (300, 6, 150, ("int_daily_prices_adjusted", "int_daily_indicators", "mart_vbt_master_dataset"))])
def test_cut_tickers_equal_whole_tickers(spark, days, copies, rows, models):
    src = long_and_short(spark, days, copies)
    cut = PanelConfig(block_rows=rows)
    one, many = Build(spark, src, WHOLE), Build(spark, src, cut, out_dir=folder(spark))
    assert Build(spark, src, WHOLE, out_dir=folder(spark)).blocks.table.count() == 0
    starts = {r._cut: r._starts for r in many.blocks.table.collect()}
    assert set(starts) == {"L"} and len(starts["L"]) >= 5
    for model in models:
        same(many[model], one[model])


def test_blocks_are_of_like_size_and_days_stay_whole(spark):
    dates = [D(2020, 1, 1) + dt.timedelta(days=k) for k in range(500)]
    rows = [("A", d) for d in dates for _ in range(7)] + [("B", d) for d in dates[:80]] + [("A", None)] * 5 + [(None, d) for d in dates[:200]]
    df = spark.createDataFrame(rows, "ticker string, date date")
    blocks = Blocks(df, halo=60, least=100)
    assert {r._cut for r in blocks.table.collect()} == {"A", None}
    tagged = blocks.tag(df)
    sizes = {(r.ticker, r[BLOCK]): r["n"] for r in tagged.groupBy("ticker", BLOCK).agg(F.count("*").alias("n")).collect()}
    assert sizes[("B", 0)] == 80 and all(60 <= n <= 107 for (t, b), n in sizes.items() if t == "A")
    assert sum(sizes.values()) == len(rows)
    assert tagged.filter("date IS NULL").select(BLOCK).distinct().collect()[0][0] == 0
    assert tagged.groupBy("ticker", "date").agg(F.countDistinct(BLOCK).alias("n")).filter("n > 1").count() == 0
    # one day with most of the rows cannot be cut, its neighbours can; small blocks join the one before
    lump = spark.createDataFrame([("A", dates[50])] * 1000 + [("A", d) for d in dates[:300]], "ticker string, date date")
    got = {r[BLOCK]: r["n"] for r in Blocks(lump, halo=60, least=100).tag(lump).groupBy(BLOCK).agg(F.count("*").alias("n")).collect()}
    assert sum(got.values()) == 1300 and max(got.values()) >= 1000 and all(n >= 60 for b, n in got.items() if b)


def test_the_number_of_cut_tickers_is_bounded(spark):
    df = spark.range(4000).select((F.col("id") % 40).cast("string").alias("ticker"), F.date_add(F.lit(D(2020, 1, 1)), (F.col("id") / 40).cast("int")).alias("date"))
    assert Blocks(df, halo=1, least=10, pieces=30).table.count() == 0        # no ticker has a thirtieth of the rows
    assert Blocks(df, halo=1, least=10, pieces=80).table.count() == 40


def test_next_rows_reach_over_small_blocks(spark):
    table = spark.createDataFrame([("A", [D(2020, 1, 3), D(2020, 1, 4), D(2020, 1, 5)])], "_cut string, _starts array<date>")
    blocks = Blocks.of(table)
    days = blocks.tag(spark.createDataFrame([("A", D(2020, 1, k), float(k)) for k in (1, 2, 3, 4, 5, 6)], "ticker string, date date, v double"))
    got = {}
    for r in blocks.next_rows(days, 3).collect():
        got.setdefault(r[BLOCK], []).append(int(r.v))
    assert {b: sorted(v) for b, v in got.items()} == {0: [3, 4, 5], 1: [4, 5, 6], 2: [5, 6]}
    assert sorted(int(r.v) for r in blocks.last_rows(days, 1, [F.col("date").desc()]).collect()) == [2, 3, 4, 6]


def test_blocks_are_found_by_halving(spark):
    """A row looks at log2 of its ticker's starts, not at all of them, and finds the block that counting them gives."""
    starts = [D(2020, 1, 1) + dt.timedelta(days=3 * k) for k in range(100)]
    blocks = Blocks.of(spark.createDataFrame([("A", starts), (None, starts[:1]), ("B", starts[:8])], "_cut string, _starts array<date>"))
    days = [D(2019, 12, 30) + dt.timedelta(days=k) for k in range(310)]
    df = spark.createDataFrame([(t, d) for t in ("A", "B", "C", None) for d in [*days, None]], "ticker string, date date")
    tagged = blocks.tag(df)
    assert blocks.steps == 7 and "lambda" not in tagged._jdf.queryExecution().analyzed().toString()
    own = {"A": starts, "B": starts[:8], None: starts[:1], "C": []}
    got = tagged.collect()
    assert len(got) == df.count()
    assert all(r[BLOCK] == sum(r.date is not None and s <= r.date for s in own[r.ticker]) for r in got)
    empty = Blocks.of(spark.createDataFrame([], "_cut string, _starts array<date>"))
    assert {r[BLOCK] for r in empty.tag(df).collect()} == {0}


def test_next_rows_collects_no_rows_of_several_blocks(spark):
    """The window over blocks sees their numbers of rows; a block's rows are held once, not once for each block before it."""
    starts = [D(2020, 1, 1) + dt.timedelta(days=5 * k) for k in range(1, 40)]
    blocks = Blocks.of(spark.createDataFrame([("A", starts), (None, starts)], "_cut string, _starts array<date>"))
    days = [D(2020, 1, 1) + dt.timedelta(days=k) for k in range(200) if k % 35 > 9 or k % 5 == 0]
    tagged = blocks.tag(spark.createDataFrame([(t, d, float(k)) for t in ("A", None) for k, d in enumerate(days)], "ticker string, date date, v double"))
    out = blocks.next_rows(tagged, 20)
    assert "flatten" not in out._jdf.queryExecution().analyzed().toString()
    got = {}
    for r in out.collect():
        got.setdefault((r.ticker, r[BLOCK]), []).append(int(r.v))
    block = [sum(s <= d for s in starts) for d in days]
    for t in ("A", None):
        for b in set(block):
            after = [k for k in range(len(days)) if block[k] > b][:20]
            assert sorted(got.get((t, b), [])) == after


def test_a_hot_ticker_spreads_over_tasks(spark):
    """One ticker of 100 times the rows: no partition of the windows' exchange holds above 3 times the median."""
    src = long_and_short(spark, 900, 4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        build = Build(spark, src, PanelConfig(block_rows=64), out_dir=folder(spark))
        prices, blocks = build["stg_daily_prices_raw"], build.blocks

        def spread(keys, df):
            sizes = sorted(r["count"] for r in df.repartition(8, *keys).groupBy(F.spark_partition_id()).count().collect())
            return sizes[-1] / sizes[len(sizes) // 2]
        assert spread(["ticker", BLOCK], blocks.tag(prices)) < 3 < spread(["ticker"], prices)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


#: As many pieces as there may be rows: the cut tickers and their blocks grow with the data.
GROWING = PanelConfig(block_rows=64, block_pieces=1 << 30)


def several_long(spark, days=300):
    """Three tickers that are cut (L, M and none), and the short ones."""
    src = long_and_short(spark, days)
    long = src.daily_prices.filter("ticker = 'L'")
    for name in ("M", None):
        src.daily_prices = src.daily_prices.unionByName(long.withColumn("ticker", F.lit(name).cast("string")))
    return src


def test_blocks_that_grow_with_the_data_are_not_broadcast(spark):
    """The driver holds what is broadcast, so nothing with a row a ticker or a block is, even where small tables would be."""
    src = several_long(spark)
    whole, cut = Build(spark, src, WHOLE), Build(spark, src, GROWING, out_dir=folder(spark))
    assert {r._cut for r in cut.blocks.table.collect()} == {"L", "M", None} and not cut.blocks.bounded
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan(I.price_blocks(cut["stg_daily_prices_raw"], GROWING).table)
    for model in ("int_daily_prices_adjusted", "int_daily_indicators", "mart_vbt_master_dataset"):
        joins = [line for line in plan(getattr(cut, f"_{model}")()).splitlines() if "Join" in line]
        assert any("ShuffledHashJoin" in j and "_cut" in j for j in joins)
        assert not any("Broadcast" in j and ("_cut" in j or BLOCK in j or "isnull" in j) for j in joins), joins
        same(cut[model], whole[model])


def test_blocks_are_the_same_whether_or_not_they_are_bounded(spark):
    dates = [D(2020, 1, 1) + dt.timedelta(days=k) for k in range(400)]
    rows = [("A", d) for d in dates for _ in range(3)] + [("B", d) for d in dates[:101]] + [("C", d) for d in dates[:100]]
    rows += [(None, d) for d in dates[:250]] + [("A", None)] * 5
    df = spark.createDataFrame(rows, "ticker string, date date")
    few, many = (Blocks(df, halo=30, least=100, pieces=pieces) for pieces in (1 << 14, 1 << 30))
    assert few.bounded and not many.bounded
    found = sorted(map(str, many.table.collect()))
    assert len(found) == 2 and found == sorted(map(str, few.table.collect()))    # B's second block is too small
    parts = df.filter("ticker = 'A'"), df.filter("ticker IS NULL OR ticker <> 'A'").withColumn("more", F.lit(1))
    assert sorted(map(str, few.cut(*parts).collect())) == sorted(map(str, many.cut(*parts).collect()))
    assert many.cut(*parts).count() == 3 * 400 + 5 + 250
    assert sorted(map(str, few.tag(df).collect())) == sorted(map(str, many.tag(df).collect()))


def test_entering_values_take_no_join(spark):
    starts = [D(2020, 1, k) for k in (3, 5, 7)]
    blocks = Blocks.of(spark.createDataFrame([("A", starts), (None, starts[:2]), ("B", starts[:1])], "_cut string, _starts array<date>"))
    ends = spark.createDataFrame([("A", 0, 1.0, "x"), ("A", 1, None, "y"), ("A", 3, 9.0, "z"), (None, 1, 5.0, None), ("B", 1, 7.0, "w")],
                                 f"ticker string, {BLOCK} int, v double, s string")
    out = blocks.entering(ends, ["v", "s"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan
    got = {(r.ticker, r[BLOCK]): (r["_start"], r.v, r.s) for r in out.collect()}
    assert got == {("A", 1): (starts[0], 1.0, "x"), ("A", 2): (starts[1], 1.0, "y"), ("A", 3): (starts[2], 1.0, "y"),
                   (None, 1): (starts[0], None, None), (None, 2): (starts[1], 5.0, None), ("B", 1): (starts[0], None, None)}


def test_the_log_sum_of_later_blocks_stands_before_a_blocks_rows(spark):
    """No join completes the reverse product, and a block without a logarithm of its own or after it stays NULL."""
    rows = [("A", 0, None, 2, 1.5, False), *[("A", 0, D(2020, 1, k), None, f, True) for k, f in ((2, 2.0), (1, 0.0))],
            ("B", 0, D(2020, 1, 1), None, 0.0, True)]
    df = spark.createDataFrame([(t, b, d, float(c) if c else None, f, p) for t, b, d, c, f, p in rows],
                               f"ticker string, {BLOCK} int, date date, _later double, f double, price boolean")
    ln = W.reverse_log_sum("f", [F.col("date").desc_nulls_first(), F.col("f").asc()], ["ticker", BLOCK], "_later")
    got = {(r.ticker, r.date): r.ln for r in df.withColumn("ln", ln).filter("price").collect()}
    assert got[("B", D(2020, 1, 1))] is None and got[("A", D(2020, 1, 2))] == got[("A", D(2020, 1, 1))] == pytest.approx(2 + math.log(2))
