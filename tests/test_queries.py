"""Every registered query of the library against its SQL over the smallest tables."""

import math
import os

import duckdb
import pytest

from ampliscope.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return tuple(plain(x) for x in v) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(spark, con, name):
    got = registry.queries()[name](spark, SF)
    found = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted((plain(tuple(r)) for r in got.select(*names).collect()), key=repr) == sorted((plain(r) for r in found.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(registry.queries().keys() - registry.oracle_sql().keys()))
def test_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0
