"""The pipeline's stages against brute force, one by one on each stage's own input."""

import hashlib
import math
from collections import Counter, defaultdict

import corpus_pipeline as cp
from siltstone.llm import mixing, quality
from siltstone.session import materialize
from tests.llm.cases import SF
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_suffix_dedup import brute as substrings


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    outs = []
    for name, stage in cp.STAGES:
        outs.append((docs, materialize(stage(spark, docs, SF), "t")))
        docs = outs[-1][1]
    rows = [[tuple(r) for r in d.select(*d.columns).collect()] for d in (outs[0][0], *[o for _, o in outs])]
    assert all(o.columns == names for _, o in outs[:-1])
    scorer = quality.train(outs[0][0], spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r[0] for r in rows[0] if scorer.score(quality.features([r[1] or ""]))[0] >= quality.THRESHOLD}
    assert {r[0] for r in rows[1]} == kept and 0 < len(kept) < len(rows[0])
    assert {r[0] for r in rows[2]} == {i for i, _, c in components(rows[1]) if i == c}
    want = {i: kept.decode("utf-8", "ignore") for i, _, _, _, kept in substrings(rows[2], raw=True)}
    assert {r[0]: r[1] for r in rows[3]} == want and all(r[4] == len(r[1]) for r in rows[3])
    assert Counter(r[0] for r in rows[4]) == Counter({i: n for i, n in counts(rows[3]).items() if n})
    assert {(r[0], r[1]) for r in rows[4]} <= {(r[0], r[1]) for r in rows[3]}
    pieces = Counter((r[0], r[1]) for r in rows[5])
    assert sum(n for (_, piece), n in pieces.items() if piece == 0) == len(rows[4]) and {i for i, _ in pieces} == {r[0] for r in rows[4]}
    by = defaultdict(list)
    for r in docs.select("sequence_id", "offset", "length").collect():
        by[r.sequence_id].append((r.offset, r.length))
    for s in by.values():
        ends = [at + n for at, n in sorted(s)]
        assert [at for at, _ in sorted(s)] == [0, *ends[:-1]] and ends[-1] <= 2048


def counts(rows):
    """How often each document (id, text, lang, source, ...) is drawn when all sources have the same share of characters."""
    size = Counter()
    for r in rows:
        size[r[3]] += len(r[1])
    live = [s for s in size if size[s]]
    out = {}
    for r in rows:
        rate = sum(size.values()) / (len(live) * size[r[3]]) if size[r[3]] else 0.0
        parts = max(1, math.ceil(rate / mixing.MAX_RATE))
        out[r[0]] = 0
        for k in range(parts if rate else 0):
            key = f"{mixing.SEED}:{r[3]}:{r[0]}" + (f":part:{k}" if k else "")
            u, p, total = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52, math.exp(-rate / parts), 0.0
            for n in range(mixing.STEPS + 1):
                total += p
                if total > u:
                    break
                out[r[0]] += 1
                p *= rate / parts / (n + 1)
    return out


def test_stages_on_odd_tables(spark, tmp_path):
    """Every stage takes an empty table, nulls in all columns, long and repeated rows, and further columns of clashing names."""
    from tests.llm.cases import DOCS, awkward

    rows = [(*r, "c", 1.0) for r in awkward()] + [(None, None, None, None, None, None, None)]
    schema = DOCS + ", score string, copy double"
    spark.createDataFrame([(r[0], 1, 0) for r in rows[:9]] + [(None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for data in (rows, []):
        for name, stage in cp.STAGES:
            docs = spark.createDataFrame(data, schema)
            out = stage(spark, docs, str(tmp_path))
            if name != cp.STAGES[-1][0]:
                assert out.columns == docs.columns
            n = out.count()
            assert n == 0 if not data else n > 0
            if data and name == "n-gram Jaccard join":
                assert {r.doc_id for r in out.select("doc_id").collect()} == {i for i, _, c in components([r[:5] for r in rows]) if i == c}
