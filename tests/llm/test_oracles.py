"""Queries of the subpackage against their DuckDB SQL."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))

from check_oracle import TABLES, rows_of, type_mismatches  # noqa: E402

from strata.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.sql(ORACLE[name])
    sdf = QUERIES[name](spark, sf)
    assert sorted(sdf.columns) == sorted(res.columns)
    assert type_mismatches(sdf.schema, res.columns, res.types) == {}
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(res.columns, res.fetchall())
