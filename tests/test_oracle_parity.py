"""Every query with a DuckDB oracle must match it (rows, columns, values)."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

SF = os.environ.get("LOTWISE_TEST_SF", "/root/testdata/sf0.001")
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    s_rows = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = duck.execute(ORACLE[name])
    d_cols = [d[0] for d in res.description]
    d_rows = rows_of(d_cols, res.fetchall())
    assert sorted(sdf.columns) == sorted(d_cols)
    assert s_rows == d_rows


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "survival_probability" in df.columns
