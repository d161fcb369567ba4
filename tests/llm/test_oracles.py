"""Registered training-data queries against their DuckDB SQL on the smallest tables."""

import duckdb
import pytest

from ledgerline.llm.queries import ORACLES, QUERIES
from tools.check_oracles import TABLES, rows_key, type_mismatches

SF = "/root/testdata/sf0.001"


def test_thirteen_operators():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[key](spark, SF)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[key])
    cols = rel.columns
    assert sorted(df.columns) == sorted(cols)
    assert type_mismatches(df.schema, cols, rel.types) == {}
    assert rows_key(got, df.columns) == rows_key(rel.fetchall(), cols)
