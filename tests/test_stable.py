"""The cross-engine rounding must be identical in Spark and DuckDB."""

import random
import struct

import duckdb
from pyspark.sql import functions as F

from pitpanel.stable import BANDS, round_sig, round_sig_sql


def _values():
    rnd = random.Random(11)
    vals = [0.0, -0.0, 1.0, -1.0, 0.5, 1011.7025, 1121 * 0.95 * 0.95, 1e-17, -1e-17, 1.1709383462843448e-16]
    for e in BANDS + [BANDS[-1] - 4, BANDS[-1] - 8]:
        edge = 2.0 ** e
        vals += [edge, -edge, edge * (1 + 2 ** -52), edge * (1 - 2 ** -53)]
    for _ in range(3000):
        vals.append(rnd.choice([-1, 1]) * 10 ** rnd.uniform(-20, 13))
        vals.append(struct.unpack("d", struct.pack("Q", rnd.getrandbits(62)))[0])   # arbitrary bit patterns
    return [v for v in vals if v == v and abs(v) < 1e13]


def test_spark_and_sql_rounding_agree(spark):
    vals = _values()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = {r.i: r.y for r in df.select("i", round_sig(F.col("x")).alias("y")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    want = dict(con.execute(f"SELECT i, {round_sig_sql('x')} FROM t").fetchall())
    bad = [(vals[i], got[i], want[i]) for i in got if got[i] != want[i] or repr(got[i]) != repr(want[i])]
    assert not bad, bad[:5]


def test_rounding_is_idempotent_and_close(spark):
    vals = [v for v in _values() if abs(v) > 1e-6]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    rows = df.select("x", round_sig(F.col("x")).alias("y")).select(
        "x", "y", round_sig(F.col("y")).alias("z")).collect()
    for r in rows:
        assert r.y == r.z
        assert abs(r.y - r.x) <= abs(r.x) * 2 ** -23 + 2 ** -29
