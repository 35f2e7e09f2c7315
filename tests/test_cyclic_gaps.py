"""Layers of documents whose ids have gaps, as the SQL has them."""

import duckdb
import pytest

from siltstone.plans import registry


@pytest.mark.parametrize(
    "ids",
    [
        [*range(0, 100), *range(101, 400, 2), *range(1000, 1100, 3)],
        [*range(7, 900, 7)],
        [*range(40, 60), *range(800, 1200, 5), 20000, 20001],
        [-4, -3, -1, 0, 3, 3, 5, 41, 44, 2_000_000],
    ],
)
def test_cyclic_layers(spark, tmp_path, ids):
    spark.createDataFrame([(i,) for i in ids], "doc_id long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(c.execute(f"SELECT node, layer FROM ({registry.ORACLES['cyclic_layers']})").fetchall())
    assert sorted(map(tuple, registry.QUERIES["cyclic_layers"](spark, str(tmp_path)).select("node", "layer").collect())) == want
