"""Every query against its DuckDB statement on the smallest sample."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from txloom.plans import sample_queries

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()
QUERIES = {name: entry.queries()[name] for name in sample_queries.QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


def cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return v if isinstance(v, (bool, str)) or v is None else str(v) if not isinstance(v, int) else float(v)


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in data), key=str)


def test_every_query_has_a_statement():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, SF)
    rel = con.execute(ORACLE[name])
    columns = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(columns)
    expected = table(columns, rel.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["address", "feature", "plots", "idx"]
    assert df.count() > 0
