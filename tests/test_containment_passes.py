"""Few short texts are found in one pass over the long ones; more of them by their grams, with the same result."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import substrings
from siltstone.operators.substrings import contained_pairs


def texts():
    rng = random.Random(3)
    few = ["", "x", "abc", "abcde", "a" * 40, "éàé", "é\U0001f600", "\U0001f600", None, "abc"]
    return few + ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 14))) for _ in range(80)]


@pytest.mark.parametrize("most", [0, 200, 1000])
def test_all_ways_find_the_same(spark, monkeypatch, most):
    short, long = texts(), texts()[::-1]
    chars = sum(len(t) for t in {t for t in short if t})
    grams = {t[k : k + 4] for t in short if t for k in range(max(1, len(t) - 3))}
    assert {0: len(grams) > most, 200: len(grams) <= most < chars, 1000: chars <= most}[most]
    monkeypatch.setattr(substrings, "MOST_BROADCAST", most)
    monkeypatch.setattr(substrings, "MOST_ROWS", 5)
    a, b = (spark.createDataFrame(list(enumerate(t)), "id long, text string") for t in (short, long))
    want = sorted((k, j) for k, s in enumerate(short) for j, t in enumerate(long) if s is not None and t is not None and s in t)
    assert sorted(tuple(r) for r in contained_pairs(a, b).collect()) == want


def test_few_texts_take_one_pass(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(t):
        read.add(1)
        return t

    b = spark.range(40).select("id", counted.asNondeterministic()(F.concat(F.lit("one two "), F.col("id").cast("string"))).alias("text"))
    a = spark.createDataFrame([(1, "two 1"), (2, "o"), (3, ""), (4, "none")], "id long, text string")
    assert contained_pairs(a, b, gram=8).count() == 11 + 40 + 40
    assert read.value == 40
