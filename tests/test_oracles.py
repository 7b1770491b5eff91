"""Every query with an oracle matches DuckDB at sf0.001 (the driver checks sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracles import _digest
from tessera.sources.readers import TABLES

from conftest import SF_SMALL

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLES[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert _digest(sdf.columns, s_rows)[0] == _digest(o_cols, o_rows)[0]
