"""The subpackage's registered queries against their SQL, and the driver's view of them."""

import re

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from pitpanel.llm.oracle import ORACLE_SQL
from tools.compare import SPARK_TO_DUCK, value_hash

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    rows, want = [tuple(r) for r in df.collect()], rel.fetchall()
    kinds = [SPARK_TO_DUCK.get(type(f.dataType).__name__, str(f.dataType)) for f in df.schema.fields]
    assert sorted(zip(df.columns, kinds, strict=True)) == sorted(zip(rel.columns, map(str, rel.types), strict=True))
    assert len(rows) == len(want) > 0
    assert value_hash(rows, df.columns)[0] == value_hash(want, rel.columns)[0]


def test_registered_names_and_stages():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "substring_dedup", "decontamination", "sentencepiece"]
    assert "pipeline" in E.queries() and "pipeline" not in E.oracle_sql()


def test_native_queries_run_no_python(spark):
    for name in ("op3_url_filter", "op6_fingerprints"):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name
