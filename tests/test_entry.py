"""Driver contract: entry runs, every oracle has a query, SQL queries match DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from citeflow.plans import catalog
from tools.compare import TABLES, digest


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert {"model", "metric", "value", "error"} <= set(df.columns) and len(rows) == 4


def test_oracles_are_subset_of_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_oracle(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    sdf = entry.queries()[name](spark, sf_small)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows) == digest(dcols, drows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_join_or_python_in_any_query(spark, sf_small, name):
    plan = entry.queries()[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
