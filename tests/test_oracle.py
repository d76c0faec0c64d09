"""Every catalogue query against DuckDB's result for its SQL."""

import os

import duckdb
import pytest

from folio.plans import catalog

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_matches_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.execute(catalog.SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    a, b = canon([tuple(r) for r in got.collect()], got.columns), canon(want.fetchall(), names)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert x == y


def test_rows_only(spark):
    for name in set(catalog.QUERIES) - set(catalog.SQL):
        assert catalog.QUERIES[name](spark, SF).count() > 0
