"""Every registered query against its DuckDB oracle on the smallest test data:
same row count, same column names, same multiset of values."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from ledgerline import schemas
from ledgerline.queries import QUERIES
from tools.check_oracle import TABLES, rows_of

SF = os.environ.get("LEDGERLINE_ORACLE_SF", "/root/testdata/sf0.001")
DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not available")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    """The optional training-data queries are held to SQL or brute force by their own tests."""
    missing = set(QUERIES) - set(E.oracle_sql())
    assert not missing, f"queries without an oracle: {sorted(missing)}"
    assert not set(E.oracle_sql()) - set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    s_rows, s_names = df.collect(), df.columns
    cur = duck.execute(E.oracle_sql()[name])
    d_names = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(s_names) == sorted(d_names)
    d_types = {c[0]: str(c[1]) for c in cur.description}
    for col, spark_type in df.dtypes:
        assert d_types[col] == DUCK_TYPES.get(spark_type, spark_type.upper()), col
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_names, s_rows) == rows_of(d_names, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == schemas.columns("gold_agg_sales_monthly")
    assert df.count() > 0
