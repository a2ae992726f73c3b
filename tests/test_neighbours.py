"""Sorted merge against brute force, against the interval form, and with more candidates than a broadcast holds."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pitpanel.config import DEFAULT
from pitpanel.operators import dcf
from pitpanel.operators.nearest import nearest_match
from pitpanel.operators.neighbours import _with_block, first_at_or_after, nearest_by_merge

NAN = float("nan")


@pytest.mark.parametrize("sizes", [{}, {"pieces": 7, "least": 10}])
def test_merge_equals_brute_force(spark, sizes):
    rng = random.Random(3)
    cands = [(rng.choice("ABC"), rng.choice([rng.uniform(-50, 50), float(rng.randrange(-9, 9))]), k) for k in range(300)] + [("A", None, 900), ("A", NAN, 901), ("B", -0.0, 902)]
    probes = [(k, rng.choice("ABCD"), rng.choice([rng.uniform(-70, 70), float(rng.randrange(-9, 9)), 2.5])) for k in range(400)] + [(1000, "A", None), (1001, "A", NAN), (1002, None, 1.0), (1003, "B", 0.0)]
    c = spark.createDataFrame(cands, "g string, value double, tie int").withColumn("name", F.concat(F.lit("n"), F.col("tie")))
    p = spark.createDataFrame(probes, "id int, g string, x double").repartition(3)
    near = {r.id: r.got for r in nearest_by_merge(p, "x", c, "value", ["tie"], {"got": "name"}, ["g"], **sizes).collect()}
    after = {r.id: r.got for r in first_at_or_after(p, "x", c, "value", ["tie"], {"got": "name"}, ["g"], **sizes).collect()}
    assert set(near) == set(after) == {i for i, *_ in probes}
    for i, g, x in probes:
        own = [(v, t) for h, v, t in cands if h == g and v is not None and v == v] if x is not None and x == x else []
        best = min(((abs(x - v), t) for v, t in own), default=(0, None))[1]
        later = min(((v, t) for v, t in own if v >= x), default=(0, None))[1]
        assert near[i] == (None if best is None else f"n{best}") and after[i] == (None if later is None else f"n{later}")


def test_merge_equals_the_interval_form_on_the_grid(spark):
    surface = dcf.dcf_surface(spark).filter((F.col("discount_rate_pct") == DEFAULT.valuation_discount_pct) & (F.col("high_growth_years") == 5))
    probe = spark.range(0, 4000).select("id", F.when(F.col("id") % 97 != 0, F.col("id") / 12.7 - 5).alias("x"))
    args = (probe, "x", surface, "implied_pe")
    got = nearest_by_merge(*args, ["growth_rate_pct"], {"g": "growth_rate_pct", "pe": "implied_pe"}, pieces=16, least=100)
    want = nearest_match(*args, ["high_growth_years"], ["growth_rate_pct"], {"g": "growth_rate_pct", "pe": "implied_pe"}).drop("high_growth_years")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_many_candidates_without_a_broadcast_grid(spark):
    n = 200_000
    cands = spark.range(n).select((F.col("id") * 3).cast("double").alias("v"), F.col("id").alias("tie"))
    probe = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(30.0)).otherwise((F.col("id") * 7 % (3 * n)).cast("double") + 0.4).alias("x"))
    got = nearest_by_merge(probe, "x", cands, "v", ["tie"], {"tie": "tie"}, pieces=32, least=1000)
    bad = got.filter(F.abs(F.col("x") - F.col("tie") * 3) > 1.5)
    assert got.count() == 60_000 and got.filter("tie IS NULL").count() == 0 and bad.count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("pieces", [1, 2, 3, 7, 16, 256])
def test_blocks_by_halving_equal_a_count_of_edges(spark, pieces):
    rng = random.Random(pieces)
    edges = sorted(rng.sample(range(1000), pieces - 1))
    rows = [(float(rng.randrange(-5, 1010)), [float(e) for e in edges] if rng.random() < 0.9 else None) for _ in range(400)]
    for r in _with_block(spark.createDataFrame(rows, "_v double, _edges array<double>"), pieces).collect():
        assert r._block == sum(e <= r._v for e in r._edges or [])
