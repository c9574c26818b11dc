"""Every query with an oracle matches DuckDB on the sf0.001 tables (the
driver runs the same comparison at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from quarry.sources.tables import TABLES

SKIP = {"token_count_by_vocab"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - SKIP))
def test_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    orows = cur.fetchall()
    ocols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, orows)
