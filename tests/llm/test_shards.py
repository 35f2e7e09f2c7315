"""Histogram sort against sorting everything in Python."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from siltstone.llm import shards as sh
from tests.llm.cases import awkward


def key(v):
    return int(hashlib.md5(("" if v is None else str(v)).encode()).hexdigest()[:15], 16)


def brute(rows, n):
    """(doc_id, text, size) -> shard, by the middle of what must stay together in the order of the keys."""
    line = sorted((key(t), key(i), len((t or "").encode()) + sh.ROW_BYTES, i, t or "") for i, t in rows)
    total = sum(r[2] for r in line)
    groups, atoms = defaultdict(int), defaultdict(int)
    for a, b, size, _, _ in line:
        groups[a] += size
        atoms[a, b] += size
    first_g, first_a, at = {}, {}, 0
    for a, b, size, _, _ in line:
        first_g.setdefault(a, at)
        first_a.setdefault((a, b), at)
        at += size
    out = []
    for a, b, size, i, t in line:
        lo, all_ = (first_g[a], groups[a]) if groups[a] * n <= sh.GROUP * total else (first_a[a, b], atoms[a, b])
        out.append((i, t, size, min(n - 1, (2 * lo + all_) * n // (2 * total))))
    return sorted(out, key=repr)


def slots(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    return all(sorted(v) == list(range(len(v))) for v in by.values())


@pytest.mark.parametrize(("n", "part_bytes", "fan"), [(3, 64 << 20, 16), (40, 1000, 2), (7, 300, 5), (1, 64 << 20, 16)])
def test_against_brute_force(spark, monkeypatch, n, part_bytes, fan):
    """Hot texts, repeated ids, long texts; parts far smaller than shards, and candidates by twos."""
    monkeypatch.setattr(sh, "PART_BYTES", part_bytes)
    monkeypatch.setattr(sh, "FAN", fan)
    rows = [(r[0], r[1]) for r in awkward()] + [(1000 + k, "hot text " * 20) for k in range(400)] + [(2000 + k, f"text {k} " * (k % 13)) for k in range(300)]
    d = spark.createDataFrame([(i, t, "clash", "x") for i, t in rows], "doc_id long, text string, shard string, extra string").repartition(5)
    out = sh.histogram_shards(d, n).withColumn("text", F.coalesce("text", F.lit(""))).collect()
    assert sorted(((r.doc_id, r.text, r.size, r.shard) for r in out), key=repr) == brute(rows, n)
    assert slots(out) and {r.extra for r in out} == {"x"}


def test_tolerance(spark):
    """Shards may end early or late by the tolerance, in fewer rounds."""
    rows = [(k, f"text {k} " * 9) for k in range(4000)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = [r["b"] for r in sh.histogram_shards(d, 5, tolerance=0.05).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 0.2 * sum(sizes) / 5


def test_rows_that_cannot_be_told_apart(spark):
    """Equal in text and id, they are dealt by a random number, as many to either side as there are bytes for."""
    rows = [(1, "the same row " * 5)] * 3000 + [(k, f"other {k} " * 3) for k in range(2, 900)]
    out = sh.histogram_shards(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    sizes = defaultdict(int)
    for r in out:
        sizes[r.shard] += r.size
    assert len(out) == len(rows) and slots(out) and len(sizes) == 4
    assert max(sizes.values()) < 1.1 * min(sizes.values())


def test_odd_tables(spark):
    schema = "doc_id long, text string"
    assert sh.histogram_shards(spark.createDataFrame([], schema), 4).count() == 0
    one = sh.histogram_shards(spark.createDataFrame([(None, None)], schema), 4).first()
    assert (one.doc_id, one.text, one.size, one.slot) == (None, None, sh.ROW_BYTES, 0)
    long = sh.histogram_shards(spark.createDataFrame([(k, "x" if k else "y" * 500_000) for k in range(50)], schema), 4).collect()
    assert len({r.shard for r in long}) <= 4 and len(long) == 50 and slots(long)
