"""Every query with SQL gives the SQL's rows; every query gives a stable schema."""

import glob
import math
import os

import duckdb
import pytest

from gaugeline.plans import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else round(v, 6) if isinstance(v, float) else v


def test_every_query_has_sql():
    assert set(queries.ORACLE_SQL) == set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_rows_equal_the_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    found = duck.sql(queries.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(found.columns)
    at = [found.columns.index(c) for c in df.columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
    assert sorted((tuple(map(plain, r)) for r in df.collect()), key=repr) == want
