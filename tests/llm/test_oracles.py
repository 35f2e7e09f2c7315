"""Queries of this subpackage against their SQL."""

import pytest

from siltstone.llm.queries import ORACLES, QUERIES
from tests.llm.cases import SF
from tests.test_oracles import duck, plain  # noqa: F401


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):  # noqa: F811
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=repr)
    r = duck.sql(ORACLES[name])
    at = [r.columns.index(c) for c in columns]
    assert got == sorted(([plain(w[i]) for i in at] for w in r.fetchall()), key=repr)
