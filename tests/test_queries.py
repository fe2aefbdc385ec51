"""Every registered query against its DuckDB twin on the small tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from logforge.plans.oracle import ORACLE
from logforge.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(r[i]) for i in order) for r in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert table(df.collect(), df.columns) == table(result.fetchall(), columns)
