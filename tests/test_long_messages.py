"""Categories of messages take time in proportion to a message's length."""

import time

from pyspark.sql import functions as F

from siltstone import rules as R
from siltstone.operators import rules as ops


def test_category_of_a_long_line(spark):
    texts = ["x" * 300_000, "y" * 300_000 + " Animation Fade not found", "first\n" + "z" * 1000 + " has no attribute 'get_a' and has no attribute 'get_b'"]
    d = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    began = time.time()
    rows = d.select("k", *[c.alias(n) for c, n in zip(ops.first_category(F.col("t"), R.ERROR_CATEGORIES, "none"), ("category", "key"), strict=True)]).orderBy("k").collect()
    assert [tuple(r)[1:] for r in rows] == [("none", None), ("animation_error", None), ("method_not_found", "get_b")]
    assert time.time() - began < 30
