"""Every query that SQL can express against its oracle on the smallest tables; the others have brute-force tests of their own."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF
from verify import TABLES, digest, rows_of


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(rows_of(df.columns, df.collect())) == digest(rows_of(columns, cur.fetchall()))


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
