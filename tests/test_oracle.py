"""Every registered query against its DuckDB SQL on sf0.001 (rows + values)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest

from conftest import SF001

@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - set(E.LLM_SQL)))
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 4 and df.columns == ["reason", "documents"]
