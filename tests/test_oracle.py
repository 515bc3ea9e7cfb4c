"""Every named query against its DuckDB twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tagpulse.plans.catalog import QUERIES
from tagpulse.sources.tables import TABLES
from tools.compare import frame_digest

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL)
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(SQL[name])
    o_cols, o_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert frame_digest(s_cols, s_rows) == frame_digest(o_cols, o_rows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["hashtag", "start_ts", "end_ts", "seconds", "tweets"]
    assert df.count() > 0
