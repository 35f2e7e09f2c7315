"""Rules counted in texts take time in proportion to a text's length, and count what their patterns do."""

import random
import time

from pyspark.sql import functions as F

from siltstone import rules as R
from siltstone.operators import rules as ops

RULES = R.COMPLEXITY + R.RUNTIME + R.PROBLEMATIC
PARTS = """if for in : ( ) [ ] { } , : class def lambda Tex MathTex TextMobject OldTex VGroup DL UR FRAME_WIDTH .get_center .points[ a 9 _ b9 é \U0001f600 ): f( é( f" " \\ ' f'""".split()
PARTS += ["\n", "\n  ", "\r", "\r\n", "\u2028", "\x0b", "\t", " ", "  ", "# undefined", "if x:\n  if y:", "for i in x:\n  for j in y:", "[a for b for c]", "class A(B, C):", "f(g(x))", "q" * 30]


def test_linear_patterns_count_alike(spark):
    r = random.Random(7)
    texts = ["".join(r.choices(r.sample(PARTS, r.choice([3, 6, len(PARTS)])), k=r.choice([4, 10, 30]))) for _ in range(20_000)]
    d = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    plain = {x.name: F.regexp_count("t", F.lit(f"(?m){x.pattern}")) for x in RULES}
    odd = [F.count_if((ops.count(F.col("t"), x) != plain[x.name]) | (ops.hits(F.col("t"), x) != (plain[x.name] > 0))).alias(x.name) for x in RULES]
    some = [F.count_if(plain[x.name] > 0).alias(f"some_{x.name}") for x in RULES]
    found = d.agg(*odd, *some).first().asDict()
    assert not any(found[x.name] for x in RULES)
    assert all(found[f"some_{x.name}"] for x in RULES)


def test_counts_in_long_texts(spark):
    texts = ["f(" * 30_000, "w" * 60_000, "a if b " * 15_000, "for x in y " * 10_000, "[" * 60_000 + "x", "( " * 30_000 + ")", "lambda" + " " * 60_000, "if x:" + "\n" * 50_000, "[for " * 15_000]
    d = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").repartition(4)
    began = time.time()
    rows = d.select("k", (ops.occurrences(F.col("t"), R.COMPLEXITY) + ops.occurrences(F.col("t"), R.RUNTIME)).alias("n"), *[ops.hits(F.col("t"), x).alias(x.name) for x in R.PROBLEMATIC]).orderBy("k").collect()
    assert [x.n for x in rows] == [0] * len(texts)
    assert [x.unclosed_parentheses for x in rows] == [True] + [False] * 8
    assert [k for k, x in enumerate(rows) if x.unmatched_brackets] == [4, 8]
    assert time.time() - began < 30
