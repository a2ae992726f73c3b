"""Run registered queries in Spark and their DuckDB twins; compare row count,
column names/types and an order-insensitive hash of the values.

    python tools/compare.py [--sf DIR] [--write-doubles] [name ...]

``--write-doubles`` regenerates ``twin/doubles.py`` (the per-query list of
DOUBLE columns the twin rounds) from the Spark schemas.
"""

from __future__ import annotations

import argparse
import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

SPARK_TO_DUCK = {"LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "DateType": "DATE", "BooleanType": "BOOLEAN", "IntegerType": "INTEGER",
                 "TimestampNTZType": "TIMESTAMP"}


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if v != v:
            return "∅"
        return repr(float(v))
    return str(v)


def value_hash(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--write-doubles", action="store_true")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()

    from pitpanel.catalog import QUERIES
    from pitpanel.session import local_session
    from twin.sql import oracle

    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{a.sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    doubles = {}
    ok_all = True
    for name, q in QUERIES.items():
        if a.names and name not in a.names:
            continue
        t0 = time.time()
        df = q(spark, a.sf)
        dcols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
        doubles[name] = dcols
        srows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        rel = con.sql(oracle(name, dcols))
        ocols, otypes = rel.columns, [str(t) for t in rel.types]
        orows = rel.fetchall()
        t2 = time.time()
        scols = df.columns
        stypes = [SPARK_TO_DUCK.get(type(f.dataType).__name__, str(f.dataType)) for f in df.schema.fields]
        schema_ok = sorted(zip(scols, stypes)) == sorted(zip(ocols, otypes))
        sh, sl = value_hash(srows, scols)
        oh, ol = value_hash(orows, ocols)
        ok = schema_ok and len(srows) == len(orows) and sh == oh
        ok_all &= ok
        print(f"{'OK ' if ok else 'BAD'} {name:26s} rows {len(srows):7d}/{len(orows):7d} schema={schema_ok} "
              f"hash={'=' if sh == oh else '≠'} spark {t1 - t0:5.1f}s duck {t2 - t1:5.1f}s", flush=True)
        if not schema_ok:
            print("   spark:", sorted(zip(scols, stypes)))
            print("   duck :", sorted(zip(ocols, otypes)))
        elif sh != oh:
            s_only = sorted(set(sl) - set(ol))[:3]
            o_only = sorted(set(ol) - set(sl))[:3]
            print("   cols :", "|".join(sorted(scols)))
            for x in s_only:
                print("   spark-only:", x[:400])
            for x in o_only:
                print("   duck-only :", x[:400])
    if a.write_doubles and not a.names:
        path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "twin", "doubles.py")
        with open(path, "w") as f:
            f.write('"""Generated by tools/compare.py --write-doubles: DOUBLE columns per query."""\n\n')
            f.write("DOUBLE_COLUMNS = {\n")
            for k, v in doubles.items():
                f.write(f"    {k!r}: {v!r},\n")
            f.write("}\n")
    return 0 if ok_all else 1


if __name__ == "__main__":
    sys.exit(main())
