"""Every registered query against its DuckDB restatement, on the smallest tables.

The driver runs the same comparison at sf 0.01; this keeps it in the suite.
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

from check_oracle import TABLES, rows_of, type_mismatches  # noqa: E402

from __spark_entry__ import entry, queries  # noqa: E402
from strata.plans.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_entry_runs(spark):
    df = entry(spark)
    assert "net_amount" in df.columns and df.count() >= 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF)
    res = duck.sql(ORACLE[name])
    assert sorted(sdf.columns) == sorted(res.columns)
    assert type_mismatches(sdf.schema, res.columns, res.types) == {}
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(res.columns, res.fetchall())
