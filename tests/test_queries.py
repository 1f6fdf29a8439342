"""Every registered query of the engine against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__
from terracask.plans import registry

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return round(v, 8) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in registry.oracle_sql():
        assert got
        return
    result = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(row[names.index(c)]) for c in columns) for row in result.fetchall()), key=repr)
    assert got == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 5
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
