"""Costly work on rows is spread evenly and done once a row."""

import pytest
from pyspark.sql import functions as F

from siltstone.plans import registry
from siltstone.sources import generated as G

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("make", [G.sources, G.modules, G.damaged])
def test_rows_of_one_row_group_are_dealt_evenly(spark, tmp_path, make):
    spark.range(4000).selectExpr("id AS p_partkey", "id % 50 AS p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096b")  # many splits, all but one of them empty
    try:
        assert spark.read.parquet(f"{tmp_path}/part.parquet").rdd.getNumPartitions() >= 4
        n = [r["count"] for r in make(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sum(n) == 4000 and max(n) <= 600


@pytest.mark.parametrize("name", ["source_scenes", "scene_extract", "scene_predicates", "self_containment", "render_issues", "conversion_issues", "constant_values"])
def test_a_source_is_read_once(spark, name):
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EvalPython [") == 1


def test_a_converted_tree_is_walked_few_times(monkeypatch):
    from siltstone.operators import converter

    walked, walk = [], converter.ast.walk
    monkeypatch.setattr(converter.ast, "walk", lambda n: walked.append(n) or walk(n))
    assert converter.convert("class A(Scene):\n    def construct(self):\n        self.add(you)\n")["valid"]
    assert len(walked) <= 3
