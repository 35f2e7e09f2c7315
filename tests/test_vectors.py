"""Vector and rate expressions against plain arithmetic."""

import math

import pytest
from pyspark.sql import functions as F

from siltstone.functions import text as fn
from siltstone.functions import vectors as V


def arr(*x):
    return F.array(*[F.lit(float(v)) for v in x])


def test_vectors(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first().x
    assert get(V.dot(arr(1, 2, 3), arr(4, 5, 6))) == 32 and get(V.norm(arr(3, 4, 0))) == 5
    assert get(V.cross(arr(1, 0, 0), arr(0, 1, 0))) == [0, 0, 1]
    assert get(V.rotated(arr(1, 0, 0), F.lit(math.pi / 2), arr(0, 0, 2))) == pytest.approx([0, 1, 0], abs=1e-12)
    assert get(V.rotated(arr(1, 2, 3), F.lit(2 * math.pi / 3), arr(1, 1, 1))) == pytest.approx([3, 1, 2])
    assert get(V.interpolated(arr(0, 10), arr(10, 0), 0.25)) == [2.5, 7.5]
    assert get(V.intersection(arr(0, 0), arr(2, 2), arr(0, 2), arr(2, 0))) == [1, 1]
    assert get(V.intersection(arr(0, 0), arr(1, 1), arr(0, 1), arr(1, 2))) is None
    assert get(V.on_line(arr(1, 1), arr(0, 0), arr(2, 2))) and not get(V.on_line(arr(3, 3), arr(0, 0), arr(2, 2))) and not get(V.on_line(arr(1, 1.1), arr(0, 0), arr(2, 2)))


def test_rates(spark):
    t = F.col("id") / 20
    rows = spark.range(21).select(V.smooth(t).alias("s"), V.rush_into(t).alias("i"), V.rush_from(t).alias("f"), V.slow_into(t).alias("w"), V.double_smooth(t).alias("d"), V.there_and_back_with_pause(t).alias("p")).collect()
    for name in "sifwd":
        values = [r[name] for r in rows]
        assert values[0] == pytest.approx(0) and values[-1] == pytest.approx(1) and values == sorted(values)
    there = [r.p for r in rows]
    assert there[0] == pytest.approx(0) and there[10] == 1 and there[-1] == pytest.approx(0) and there[8] == pytest.approx(there[12])


def test_text_parts(spark):
    d = spark.createDataFrame([("import os\nx = 1\n  from a import b\ny",)], "t string")
    assert d.select(fn.without_imports(F.col("t")).alias("r")).first().r == "x = 1\ny"
    m = d.select(*[c.alias(n) for n, c in fn.text_metrics(F.col("t")).items()]).first()
    assert m.lines == 4 and m.complexity == "simple" and m.animations == 0
