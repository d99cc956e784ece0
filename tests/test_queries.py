"""Every query with SQL gives what DuckDB gives on the smallest test corpus."""

import math
from pathlib import Path

import pytest

from lexloom.queries import QUERIES, SQL

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test corpus")


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "tzinfo"):
        return str(value.replace(tzinfo=None))
    if isinstance(value, bool) or isinstance(value, str):
        return value
    return round(float(value), 6) if isinstance(value, (int, float)) or hasattr(value, "as_tuple") else str(value)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in FOLDER.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    ours = QUERIES[name](spark, str(FOLDER))
    theirs = duck.sql(SQL[name])
    order = sorted(ours.columns)
    assert order == sorted(theirs.columns)
    a = sorted((tuple(plain(r[c]) for c in order) for r in ours.collect()), key=str)
    at = [theirs.columns.index(c) for c in order]
    b = sorted((tuple(plain(r[i]) for i in at) for r in theirs.fetchall()), key=str)
    assert a == b


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql(spark, name):
    first, again = QUERIES[name](spark, str(FOLDER)), QUERIES[name](spark, str(FOLDER))
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))
