"""Every registered query against its DuckDB restatement on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tools.oracle_check import TABLES, exact, normalize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = Path(SF) / f"{t}.parquet"
        if p.exists():
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("key", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    a = exact(entry_mod.queries()[key](spark, SF).toArrow())
    b = exact(con.execute(entry_mod.oracle_sql()[key]).to_arrow_table())
    assert sorted(a.columns) == sorted(b.columns)
    assert len(a) == len(b)
    assert normalize(a) == normalize(b)
