"""Every query of the library against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from rankloom.plans import registry

from .conftest import canonical

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="the tables aren't here")


@pytest.fixture(scope="module")
def con():
    own = duckdb.connect()
    for name in os.listdir(DIR):
        own.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DIR}/{name}')")
    return own


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    df = registry.QUERIES[name](spark, DIR)
    rows = df.collect()
    if name not in registry.ORACLE:
        assert df.columns
        return
    found = con.execute(registry.ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert canonical([tuple(r) for r in rows], df.columns) == canonical(found.fetchall(), names)
