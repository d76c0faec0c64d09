"""The corpus queries that SQL can express, against DuckDB."""

import os

import duckdb
import pytest

from folio.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        path = f"{SF}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    want = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = queries.queries()[name](spark, SF).select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
