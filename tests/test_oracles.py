"""Every query with an oracle gives the rows that DuckDB gives on the smallest tables."""

import math
import os

import duckdb
import pytest

from siltstone.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.sql(f"create view {t.split('.')[0]} as select * from '{SF}/{t}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "item"):
        return plain(v.item())
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=repr)
    r = duck.sql(registry.ORACLES[name])
    assert sorted(r.columns) == columns
    at = [r.columns.index(c) for c in columns]
    assert got == sorted(([plain(w[i]) for i in at] for w in r.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
