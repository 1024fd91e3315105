"""Every catalogued query against its SQL counterpart on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    got = rows_of(df.columns, df.collect())
    assert got[1]
    if name in oracle_sql():
        cursor = duck.execute(oracle_sql()[name])
        assert got == rows_of([c[0] for c in cursor.description], cursor.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 10
