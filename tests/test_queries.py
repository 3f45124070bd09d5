"""Every registered query against its SQL twin in DuckDB on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry
from brisa.catalog import QUERIES, SQL
from tools.check import TABLES, rows_of


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "BatchEvalPython" not in plan
    cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = SQL.get(name)
    if sql is None:
        assert got
        return
    rel = duck.execute(sql)
    ocols, want = rows_of([c[0] for c in rel.description], rel.fetchall())
    assert cols == ocols
    assert got == want


def test_every_query_without_sql_is_random_or_learned():
    assert set(QUERIES) - set(SQL) == {"random_split", "weighted_resample"}
