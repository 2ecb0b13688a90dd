"""Every registered query against its DuckDB twin on the smallest tables
(the driver runs the same comparison on sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.queries()) & set(E.oracle_sql())))
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols, drows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert rows_of(scols, srows) == rows_of(dcols, drows)
