"""Queries with SQL against DuckDB; every operator and the pipeline are registered."""

import duckdb
import pytest

import corpus_pipeline
from citeflow.llm import catalog
from tools.compare import digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = catalog.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    got = con.execute(catalog.ORACLES[name])
    columns = [d[0] for d in got.description]
    assert sorted(columns) == sorted(df.columns)
    assert digest(df.columns, rows) == digest(columns, got.fetchall())


def test_registered_names():
    assert [k for k in catalog.QUERIES if k != "pipeline"] == sorted((k for k in catalog.QUERIES if k != "pipeline"), key=lambda k: int(k[2:].split("_")[0]))
    assert len(catalog.QUERIES) == 14 and len(corpus_pipeline.STAGES) == 5
