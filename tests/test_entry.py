"""Every registered query of the engine gives the rows of its SQL on the smallest tables."""

import os

import duckdb
import pytest

import dqloom.queries as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return round(float(v), 9) if isinstance(v, (int, float)) else str(v)


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query(spark, duck, name):
    got = Q.queries()[name](spark, SF)
    want = duck.sql(Q.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    places = [want.columns.index(c) for c in order]
    ours = sorted((tuple(plain(r[c]) for c in order) for r in got.collect()), key=str)
    theirs = sorted((tuple(plain(r[i]) for i in places) for r in want.fetchall()), key=str)
    assert ours == theirs
