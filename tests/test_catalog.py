"""Every registered query against its SQL equivalent, on the smallest test tables."""

import math
import pathlib

import duckdb
import pytest

from parley.catalog import ORACLES, QUERIES

SF_DIR = pathlib.Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return round(float(value), 6) if isinstance(value, float) else value


def as_set(rows):
    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(SF_DIR))
    columns = sorted(df.columns)
    rows = as_set(df.select(*[f"`{c}`" for c in columns]).collect())
    if name not in ORACLES:
        assert rows
        return
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = as_set(tuple(r[i] for i in order) for r in found.fetchall())
    assert rows == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
