"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from ledgerline.plans.catalog import ORACLES, QUERIES
from tools.check_oracles import TABLES, rows_key, type_mismatches

ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    return con


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    assert ROWS_ONLY == ["stream_events_daily_windowed"]


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLES[key])
    cols = rel.columns
    assert sorted(df.columns) == sorted(cols)
    assert type_mismatches(df.schema, cols, rel.types) == {}
    assert rows_key(got, df.columns) == rows_key(rel.fetchall(), cols)


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_rows_only_queries_run(spark, key):
    assert QUERIES[key](spark, SF_SMALL).count() > 0


def test_entry_registers_the_catalog():
    assert set(QUERIES) <= set(E.queries())
    assert set(ORACLES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "churn_7d" in df.columns
