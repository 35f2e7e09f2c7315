"""Importance resampling against a brute force over Python words, and its parts."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import resample as rs
from tests.llm.cases import DOCS, awkward


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def grams(text, order=2):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return words, [" ".join(words[i : i + k]) for k in range(1, order + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, percent, min_words, seed, buckets, order):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, grams(text, order)[1]))
    for text in target:
        t.update(map(bucket, grams(text, order)[1]))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    rows = []
    for i, text in docs:
        words, g = grams(text, order)
        weight = sum(gain(bucket(x)) for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words), len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    may = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1:4]))
    drawn = may[: percent * len(may) // 100]
    ranked = [(*r, k) for k, r in enumerate(drawn, 1)]
    left = Counter(rows) - Counter(drawn)
    return sorted(ranked + [(*r, None) for r in left.elements()], key=repr)


@pytest.mark.parametrize(("percent", "buckets", "order"), [(25, 10_000, 2), (60, 97, 3), (100, 1, 1)])
def test_against_brute_force(spark, percent, buckets, order):
    rows = [(r[0], r[1]) for r in awkward()] + [(k, f"Word {k % 5} of Zürich-Süd, A1B2 x\x00y {k % 3} " * (k % 9)) for k in range(100, 160)]
    rows += [(200, "the same row " * 9)] * 7 + [(None, "without an id " * 8)] * 3
    docs = spark.createDataFrame([(*r, "clash", 0.5) for r in rows], "doc_id long, text string, rank string, score double").repartition(3)
    target = [None, "", "w1 w2 the same row", "Zürich of word 3"]
    out = rs.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent, 20, 5, buckets=buckets, order=order)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows, target, percent, 20, 5, buckets, order)


def test_empty_tables_and_bounds(spark):
    docs = spark.createDataFrame([(1, None, "", "", 0), (2, "", "", "", 0)], DOCS)
    empty = docs.limit(0)
    assert rs.resample(empty, docs).count() == 0
    assert [(r["n_features"], r["weight"], r["rank"]) for r in rs.resample(docs, empty).collect()] == [(0, 0, None)] * 2
    with pytest.raises(ValueError):
        rs.bucket_streams(docs, buckets=1 << 17)


def test_pieces_cut_no_word(monkeypatch):
    text = ("Ab1 c. " * 50 + "z" * 40 + " é" * 30).encode()
    want = rs.features(text, 10_000, 3)
    for n in (1, 7, 16):
        monkeypatch.setattr(rs, "PIECE", n)
        got = rs.features(text, 10_000, 3)
        assert got[0] == want[0] and sorted(got[1].tolist()) == sorted(want[1].tolist())


def test_streams_of_many_blocks(spark, monkeypatch):
    """Blocks end with a document wherever the bound falls, and sorted runs give the counts."""
    monkeypatch.setattr(rs, "BLOCK", 1)
    rng = np.random.default_rng(1)
    a = rng.integers(0, 50, 1000).astype("<u2")
    values, n = rs.run_lengths(a)
    assert dict(zip(values.tolist(), n.tolist(), strict=True)) == Counter(a.tolist()) and rs.run_lengths(a[:0])[0].size == 0
    docs = spark.createDataFrame([(r[0], r[1]) for r in awkward()], "doc_id long, text string")
    streams = rs.bucket_streams(docs, buckets=1000)
    counts = {r["bucket"]: r["n"] for r in rs.bucket_counts(streams, 1000).collect()}
    want = Counter(zlib.crc32(g.encode()) % 1000 for r in awkward() for g in grams(r[1])[1])
    assert counts == want
    assert rs.document_weights(streams, np.ones(1000, np.int64)).agg(F.sum("n_features")).first()[0] == want.total()
