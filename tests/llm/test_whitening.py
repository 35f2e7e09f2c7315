"""Whitening against exact fractions, with every kind of number."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from siltstone.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<double>, component string, n int"


def check(out, rows, scale, components):
    """Each number of out against plain Python over the rows of one length."""
    xs = {(i, tuple(math.floor(scale * c) for c in v)) for i, v in rows}
    fit = sorted({x for _, x in xs})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    cov = [[Fraction(n * sum(x[j] * x[k] for x in fit) - s[j] * s[k], n * n) for k in range(d)] for j in range(d)]
    v = np.array([[float(c) for c in r] for r in cov])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    by = {}
    for r in out:
        by.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    of = {(i, sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))): x for i, x in xs}
    assert set(by) == set(of)
    signs = {}
    for k, x in of.items():
        assert sorted(by[k]) == list(range(1, components + 1))
        for c, r in by[k].items():
            want = float(np.dot([float(Fraction(a) - Fraction(b, n)) for a, b in zip(x, s, strict=True)], u[:, c - 1]) / math.sqrt(e[c - 1]))
            if abs(want) > 1e-6:
                assert signs.setdefault(c, np.sign(want * r.whitened)) == np.sign(want * r.whitened)
            assert abs(abs(want) - abs(r.whitened)) < 1e-7 and r.n == n
            assert abs(r.explained - e[c - 1] / np.trace(v)) < 1e-9 and r.identity_error < 1e-6


@pytest.mark.parametrize("size", [1, 1e6, 1e13])
def test_against_fractions(spark, size, monkeypatch):
    """Small numbers, such that need limbs, and such whose squares pass 2**63; blocks of a few rows; copies count once."""
    monkeypatch.setattr(wh, "BLOCK", 16)
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, size) * (j + 1) + size for j in range(5)]) for k in range(60)]
    rows += [(100 + k, rows[k][1]) for k in range(30)]
    d = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(7)
    check(wh.whiten(d, components=3).collect(), rows, 256, 3)


def test_limbs_and_shift():
    rng = random.Random(5)
    for top in (3, 1 << 19, 1 << 21, 1 << 40, 1 << 62):
        x = np.array([[rng.randrange(-top, top) for _ in range(4)] for _ in range(33)], np.int64)
        s = wh.Scatter(x[0].copy())
        s.add(x[:20])
        s.add(x[20:])
        n, total, cross = s.unshifted()
        rows = x.astype(object)
        assert n == 33 and (total == rows.sum(axis=0)).all() and (cross == rows.T @ rows).all()


def test_merge_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(wh, "MERGED", 3)
    rows = [([k, k * k % 17],) for k in range(40)]
    found = wh.scatters(spark.createDataFrame(rows, "x array<long>").repartition(11))
    x = np.array([r[0] for r in rows], object)
    n, s, c = found[2]
    assert n == 40 and (s == x.sum(axis=0)).all() and (c == x.T @ x).all()


def test_odd_tables(spark):
    """Dropped rows, unequal lengths, fewer vectors than dimensions, one vector, equal vectors, numbers beyond a long."""
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [-0.0, 0.5]), (7, [0.25, 0.5]), (None, [0.5, -0.5]), (7, [0.25, 0.5]), (8, [3.0])]
    d = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    out = wh.whiten(d).collect()
    assert sorted((r.vec_id or 0, r.component) for r in out) == [(0, 1), (0, 2), (6, 1), (6, 2), (7, 1), (7, 1), (7, 2), (7, 2)]
    assert {r.n for r in out} == {3} and all(r.identity_error < 1e-9 for r in out)
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 0.0], "", 1) for k in range(5)], SCHEMA)
    assert {r.component for r in wh.whiten(line).collect()} == {1}
    assert wh.whiten(d.limit(0)).count() == 0 and wh.whiten(spark.createDataFrame([(1, [1.0], "", 1)] * 3, SCHEMA)).count() == 0
    both = spark.createDataFrame([(k, [float(k * j % 7) for j in range(1, 2 + k % 2)], "", 1) for k in range(20)], SCHEMA)
    got = wh.whiten(both).collect()  # ten rows of each length, seven of them distinct
    assert {r.n for r in got} == {7} and {(r.vec_id, r.component) for r in got} == {(k, c) for k in range(20) for c in range(1, 2 + k % 2)}
    with pytest.raises(Exception, match="does not fit a long"):
        wh.whiten(spark.createDataFrame([(1, [1e30], "", 1)], SCHEMA)).count()
