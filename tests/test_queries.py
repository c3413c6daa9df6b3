"""Every query with an oracle against DuckDB on the smallest tables."""

import glob
import math
import os

import pytest

from glyphflow.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
SLOW = {"mining_clusters", "baseline_table"}


def plain(x):
    if isinstance(x, float):
        return round(x, 6) if math.isfinite(x) else str(x)
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return tuple(map(plain, x.values())) if isinstance(x, dict) else x


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_oracle(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    expected = duck.sql(registry.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    at = [expected.columns.index(c) for c in columns]
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in expected.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql()) - SLOW))
def test_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0
