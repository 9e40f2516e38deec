"""Every registered query against its DuckDB oracle (the driver's correctness gate, at small scale)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_CHECK

from tools.check_oracle import TABLES, rows_of

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_CHECK}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_entry():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 45


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_CHECK).toPandas()
    want = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows_of(got) == rows_of(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["qid", "rank", "id", "dist"]
    assert df.count() == 250
