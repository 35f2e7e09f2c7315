import re

import pytest

from siltstone.llm import jaccard_join as jj
from siltstone.llm._shingles import shingle_sets
from tests.llm.cases import DOCS, awkward, words
import random

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(_LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(id, set size, smallest id that links reach) of each row."""
    s = [shingles(t) for _, t, *_ in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(s[a] & s[b])
            if s[a] and s[b] and 100 * both >= 80 * (len(s[a]) + len(s[b]) - both):
                group[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            g = find(k)
            least[g] = min(least.get(g, r[0]), r[0])
    return sorted(((r[0], len(s[k]), least.get(find(k)) if s[k] else r[0]) for k, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize(("small", "block"), [(2, 3), (2, 2048), (8, 5)])
def test_against_all_pairs(spark, monkeypatch, small, block):
    monkeypatch.setattr(jj, "SMALL", small)
    monkeypatch.setattr(jj, "BLOCK", block)
    monkeypatch.setattr(jj, "TOKENS", 50 if small == 2 else 2 << 20)
    rng = random.Random(5)
    rows = awkward()
    base = words(rng, 150, 10**6).split()
    for k in range(25):  # near copies around the threshold, in a group too large to pair directly
        w = list(base)
        for _ in range(rng.randrange(1, 7)):
            w[rng.randrange(len(w))] = f"e{k}"
        rows.append((1000 + k, " ".join(w), "en", "s", 0))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()), key=repr)
    assert got == brute(rows)


def test_one_shingle_in_every_class(spark, monkeypatch):
    """A shingle that all sets share, first in many prefixes, in buckets of a few shingles; some sets are near copies."""
    monkeypatch.setattr(jj, "TOKENS", 20)
    rng, shared = random.Random(6), "the very same five words"
    rows = [(k, f"{shared} {words(rng, k % 7, 10**6)}", "en", "s", 0) for k in range(150)]
    rows += [(200 + k, rows[k][1] + (" more" if k % 2 else ""), "en", "s", 0) for k in range(0, 60, 3)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()), key=repr)
    assert got == brute(rows)


def test_exact_threshold(spark):
    rows = [(1, " ".join(f"a{k}" for k in range(9)), "", "", 0), (2, " ".join(f"a{k}" for k in range(8)), "", "", 0)]  # 4 of 5 shingles
    rows += [(3, " ".join(f"b{k}" for k in range(8)), "", "", 0), (4, " ".join(f"b{k}" for k in range(7)), "", "", 0)]  # 3 of 4
    got = {r.doc_id: r.component_id for r in jj.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_pairs_must_meet_under_every_order(spark):
    """A pair known under some orders stays only if it shares a shingle under the others."""
    g = [(o, t, c) for o, t, c in [(0, 1, 10), (0, 1, 11), (0, 1, 12), (1, 5, 10), (1, 5, 11), (1, 6, 12), (2, 8, 10), (2, 8, 11), (2, 8, 12)]]
    groups = spark.createDataFrame([(o, t, c, 9, 2) for o, t, c in g], "ord int, tok long, cls long, n int, g int")
    pairs = spark.createDataFrame([(10, 11, 1), (10, 12, 1), (11, 12, 7)], "a long, b long, met int")
    assert sorted((r.a, r.b) for r in jj._intersected(pairs, groups).collect()) == [(10, 11), (11, 12)]


def test_empty(spark):
    assert jj.jaccard_components(spark.createDataFrame([], DOCS)).count() == 0


def test_long_text_in_pieces():
    text = ("ab " * 500_000 + "c d e f").encode()
    h, n = shingle_sets([text, b"x y"])
    assert n.tolist() == [5, 1] and len(h) == 6


def test_near_copies_are_linked_before_all_their_pairs_are_asked_for(spark, monkeypatch):
    rng, rows = random.Random(5), []
    base = [f"w{k}" for k in range(300)]
    for i in range(400):
        words = list(base)
        for k in rng.sample(range(300), rng.choice([2, 3, 3, 4])):
            words[k] = f"x{i}_{k}"
        rows.append((i, " ".join(words)))
    asked, apart = [], jj._apart

    def counted(*args):
        pairs = apart(*args)
        asked.append(pairs.count())
        return pairs

    monkeypatch.setattr(jj, "_apart", counted)
    got = jj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows)
    assert sum(asked) <= 10 * len(rows)


def test_pairs_of_leaders_are_not_sought_again(spark):
    member = "ord int, tok long, cls long, n int, g int, lead long, lead_n int"
    pair = [(o, 7, c, 10, 2, 1, 10) for o in range(jj.ORDERS) for c in (1, 2)]
    three = [(o, 8, c, 10, 3, 3, 10) for o in range(jj.ORDERS) for c in (3, 4, 5)]
    groups = spark.createDataFrame(pair + three, member)
    comps = spark.createDataFrame([], "node long, root long")
    classes = spark.createDataFrame([(c, c, 10, bytes(8)) for c in range(1, 6)], "cls long, rep long, n int, bits binary")
    assert {(r.a, r.b) for r in jj._led(groups).collect()} == {(1, 2), (3, 4), (3, 5)}
    assert [tuple(r) for r in jj._apart(groups, comps, classes).collect()] == [(4, 5)]
