"""Scalar rules vs independent Python implementations over generated inputs
(one Spark job per property)."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.functions import exprs as X
from pitpanel.plans import intermediate as I

_NUM = re.compile(r"^\s*[+-]?((\d+\.?\d*)|(\.\d+))([eE][+-]?\d+)?\s*$")
_SPECIAL = re.compile(r"^\s*[+-]?(nan|inf|infinity)\s*$", re.I)
_INT = re.compile(r"^\s*[+-]?\d+\s*$")


def _texts(n=4000, seed=5):
    rnd = random.Random(seed)
    pieces = ["", " ", "+", "-", ".", "e", "E", "d", "f", ",", "1", "23", "007", "4.5", "NaN", "inf", "x", "0x1"]
    out = [rnd.choice(pieces) + rnd.choice(pieces) + rnd.choice(pieces) for _ in range(n)]
    out += [str(rnd.randint(-10**12, 10**12)) for _ in range(500)] + [repr(rnd.uniform(-1e6, 1e6)) for _ in range(500)]
    return out


def _py_double(s):
    if _NUM.match(s):
        return float(s.strip())
    if _SPECIAL.match(s):
        return float(s.strip().lower().replace("infinity", "inf"))
    return None


def _py_bigint(s):
    if _INT.match(s):
        v = int(s.strip())
        return v if -2**63 <= v < 2**63 else None
    return None


def test_safe_casts_match_reference_rules(spark):
    texts = _texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    rows = df.select("i", X.safe_double("s").alias("d"), X.safe_bigint("s").alias("b")).collect()
    for r in rows:
        want_d, want_b = _py_double(texts[r.i]), _py_bigint(texts[r.i])
        got_d = r.d
        if want_d is not None and want_d != want_d:          # NaN
            assert got_d is not None and got_d != got_d, texts[r.i]
        else:
            assert got_d == want_d, (texts[r.i], got_d, want_d)
        assert r.b == want_b, (texts[r.i], r.b, want_b)


def test_deadlines_match_calendar_rules(spark):
    rnd = random.Random(9)
    labels = [f"{rnd.randint(1990, 2040)}-{q}" for q in range(1, 5) for _ in range(50)]
    df = spark.createDataFrame([(lb, int(lb[:4]), int(lb[-1])) for lb in labels],
                               "year_quarter string, year bigint, quarter bigint")
    out = df.select("year_quarter", I.income_deadline("year_quarter").alias("i"),
                    I.balance_deadline().alias("b")).collect()
    income = {1: (5, 16), 2: (8, 15), 3: (11, 15)}
    balance = {1: (5, 16), 2: (8, 16), 3: (11, 15)}
    for r in out:
        y, q = int(r.year_quarter[:4]), int(r.year_quarter[-1])
        want_i = dt.date(y, *income[q]) if q in income else dt.date(y + 1, 4, 1)
        want_b = dt.date(y, *balance[q]) if q in balance else dt.date(y + 1, 4, 1)
        assert (r.i, r.b) == (want_i, want_b), r.year_quarter
    months = [f"{y}-{m:02d}" for y in (2009, 2012, 2024) for m in range(1, 13)]
    dd = spark.createDataFrame([(m,) for m in months], "ym string").select(
        "ym", I.revenue_deadline("ym").alias("d")).collect()
    for r in dd:
        y, m = int(r.ym[:4]), int(r.ym[5:])
        nxt = dt.date(y + (m == 12), m % 12 + 1, 11)
        assert r.d == nxt, r.ym
