"""The driver contract: every ``queries()`` entry against its ``oracle_sql()``
twin in DuckDB (row count, column names/types, order-insensitive values)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from pitpanel.catalog import QUERIES
from tools.compare import SPARK_TO_DUCK, TABLES, value_hash

SF = os.environ.get("PITPANEL_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 41 and df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_twin(spark, con, name):
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    srows = [tuple(r) for r in df.collect()]
    orows = rel.fetchall()
    stypes = [SPARK_TO_DUCK.get(type(f.dataType).__name__, str(f.dataType)) for f in df.schema.fields]
    assert sorted(zip(df.columns, stypes)) == sorted(zip(rel.columns, [str(t) for t in rel.types]))
    assert len(srows) == len(orows)
    assert value_hash(srows, df.columns)[0] == value_hash(orows, rel.columns)[0]
