"""Every registered query against its DuckDB oracle on the smallest scale
(the driver runs the same comparison at sf0.01); rows-only queries must run."""

import re

import duckdb
import pytest

from lakemart.plans.catalog import explain_text

import __spark_entry__ as entry
from tools.check_oracle import TABLES, rows_of

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 140


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    plan = explain_text(df, "formatted")
    # plan hygiene: no cartesian / nested-loop joins, no Python in the plan
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", plan)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert df.columns
        return
    cur = con.execute(ORACLE[name])
    cols = [c[0] for c in cur.description]
    expected = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(expected)
    assert rows_of(df.columns, rows) == rows_of(cols, expected)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
