"""Every registered query against its DuckDB oracle, on the smallest tables
(the driver repeats this at sf0.01).  Queries without SQL get a row-count
sanity check."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(got) > 0
        return
    res = con.execute(SQL[name])
    cols = [c[0] for c in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(cols, want)[0]
