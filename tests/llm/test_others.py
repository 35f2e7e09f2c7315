"""URL filters, classifier, mixing, top-k, WARC and fingerprints on small and awkward inputs."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import fingerprint, mixing, quality, topk, url_filter, warc
from siltstone.session import scratch
from tests.llm.cases import DOCS, SF, awkward


def glob_regex(g):
    parts = re.split(r"(\*\*|\*|\?)", g)
    return re.compile("".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in parts), re.S)


def test_globs_against_regex():
    rng = random.Random(2)
    globs = ["".join(rng.choice(["a", "b", "/", ".", "*", "**", "?"]) for _ in range(rng.randrange(1, 9))) for _ in range(60)] + ["", "x" * 90 + "*"]
    urls = ["".join(rng.choice("ab/.") for _ in range(rng.randrange(12))) for _ in range(300)] + ["", "x" * 5000]
    got = url_filter.GlobAutomaton(globs).match([u.encode() for u in urls])
    want = np.array([[bool(glob_regex(g).fullmatch(u)) for g in globs] for u in urls])
    assert (got == want).all()
    assert url_filter.GlobAutomaton(["a"]).match([]).shape == (0, 1)


def test_url_cases(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG", "x://Sub.example.org/en/12?q", "http://org/", "https://b.com/de/#f", "http://xcom/de/", "a://b://c.com/fr/x", "http://c.net/ads/x", "http://d.net/a.zip?x", "http://É.com/fr/é"]
    d = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(urls)], "page_id long, url string, rule string")
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(d, "url", url_filter.RULES, url_filter.BLOCKED).collect()}
    assert out[0] == out[1] == out[2] == out[3] == ("", "", None, "allow")
    assert out[4] == ("a.example.org", "", None, "allow")
    assert out[5] == ("sub.example.org", "/en/12", "example.org/en/1", "block")
    assert out[6] == ("org", "/", "org/", "allow") and out[7] == ("b.com", "/de/", "com/de/", "block")
    assert out[8] == ("xcom", "/de/", None, "allow") and out[9] == ("b:", "//c.com/fr/x", None, "allow")
    assert out[10][3] == out[11][3] == "block" and out[12][2:] == ("com/fr/", "allow")


def test_url_odd_tables(spark):
    """An empty table, repeated rows, a very long URL, no rules at all, and rules of equal length."""
    schema = "page_id long, url string, verdict string"
    long = "http://a.example.org/es/" + "p/" * 40_000
    d = spark.createDataFrame([(1, long, "c"), (1, long, "c"), (2, "http://b.net/" + "x" * 50_000 + ".zip", "c"), (3, None, None)], schema)
    out = sorted((r.page_id, r.rule, r.verdict) for r in url_filter.filter_urls(d, "url", url_filter.RULES, url_filter.BLOCKED).collect() if r.page_id < 3)
    assert out == [(1, "example.org/es/", "block")] * 2 + [(2, None, "block")]
    assert url_filter.filter_urls(d.limit(0), "url", url_filter.RULES, url_filter.BLOCKED).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(d, "url", [], []).collect()} == {"allow"}
    twice = [(True, "org", "/es/"), (False, "org", "/es/")]
    assert url_filter.filter_urls(d, "url", twice, []).where("page_id = 1").first().verdict == "allow"


def test_many_rules(spark, monkeypatch):
    """Thousands of rules, and states simulated a few URLs at a time."""
    monkeypatch.setattr(url_filter, "STATES", 1 << 12)
    globs = [f"*.h{k}.net/p{k}/**" for k in range(1500)]
    auto = url_filter.GlobAutomaton(globs)
    urls = [f".h{k}.net/p{j}/x".encode() for k, j in [(3, 3), (3, 4), (1499, 1499), (700, 700)]]
    row, glob = auto.found(urls)
    assert row.tolist() == [0, 2, 3] and glob.tolist() == [3, 1499, 700]


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scorer = quality.train(docs, labels)
    out = quality.classify(docs.withColumn("score", F.lit("clash")), scorer).join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in out) / len(out) > 0.95
    odd = quality.classify(spark.createDataFrame(awkward(), DOCS), scorer).collect()
    assert len(odd) == len(awkward()) and all(0 <= r.score <= 1 for r in odd)
    same = {}
    for r in odd:
        assert same.setdefault(r.text or "", r.score) == r.score
    empty = spark.createDataFrame([], DOCS)
    assert quality.classify(empty, scorer).count() == 0
    none = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.classify(docs, none).select("score").distinct().collect()} == {0.5}
    assert {r.score for r in quality.classify(docs, quality.train(docs, labels.withColumn("quality", F.lit(0)))).limit(9).collect()} == {0.5}
    assert {r.score for r in quality.classify(docs.limit(3), quality.train(empty, labels)).collect()} == {0.5}


def test_nonnegative_risk_by_brute_force():
    """The risk from single losses, and the gradient by differences on both sides of the correction."""
    import math

    rng = np.random.default_rng(3)
    zp, zu = rng.normal(0.3, 1, (40, 5)), rng.normal(0, 1, (70, 5))
    loss = lambda z, w, y: math.log1p(math.exp(-y * sum(a * b for a, b in zip(z, w, strict=True))))
    mean = lambda x: sum(x) / len(x)
    seen = set()
    for prior in (0.1, 0.6, 0.98):
        for w in rng.normal(0, 1.5, (6, 5)):
            want = (prior * mean([loss(z, w, 1) for z in zp]), mean([loss(z, w, -1) for z in zu]) - prior * mean([loss(z, w, -1) for z in zp]))
            assert np.allclose(quality.risk(w, zp, zu, prior), want)
            seen.add(want[1] >= 0)
            side = (lambda v: sum(quality.risk(v, zp, zu, prior))) if want[1] >= 0 else (lambda v: -quality.risk(v, zp, zu, prior)[1])
            steps = [(side(w + e) - side(w - e)) / 2e-5 for e in np.eye(5) * 1e-5]
            assert np.allclose(quality.gradient(w, zp, zu, prior), steps, atol=1e-5)
    assert seen == {True, False}


def test_class_prior_of_a_mixture():
    rng = np.random.default_rng(4)
    for share in (0.2, 0.5, 0.9):
        unlabelled = np.where(rng.random(4000) < share, rng.normal(3, 1, 4000), rng.normal(-3, 1, 4000))
        assert abs(quality.class_prior(rng.normal(3, 1, 2000), unlabelled) - share) < 0.06


def test_quality_odd_tables(spark):
    """Repeated ids and labels, null ids and labels, clashing names; negatives change nothing but the contrast's texts."""
    rows = [(k % 30, ("good plain words of text " * 5) if k % 3 else "|x|#" * 20, "en", "s", 0) for k in range(90)] + awkward()
    docs = spark.createDataFrame(rows, DOCS).withColumn("held_out", F.lit("clash")).withColumn("use", F.lit("clash"))
    labels = spark.createDataFrame([(k % 30, int(k % 3 > 0), None) for k in range(90)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, order int")
    scorer = quality.train(docs, labels)
    out = quality.classify(docs, scorer).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.use == "clash" and r.predicted == int(r.score >= 0.3) for r in out)
    assert {r.held_out for r in out} == {True, False}


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_RATE", 8.0)
    rows = [(k, "x" * (10 + k % 7), "en", "hot" if k % 3 else f"s{k % 5}", 0) for k in range(3000)] + [(None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("copy", F.lit("clash"))
    out = mixing.mix_sources(docs, {"hot": 1.0, "s0": 1.0})
    sizes = Counter()
    for r in out.collect():
        sizes[r.source] += len(r.text)
    assert set(sizes) == {"hot", "s0"} and abs(sizes["hot"] / sizes["s0"] - 1) < 0.15
    keys = [r.shuffle_key for r in out.collect()]
    assert keys == sorted(keys) == [r.shuffle_key for r in mixing.mix_sources(docs, {"hot": 1.0, "s0": 1.0}).collect()]
    assert mixing.mix_sources(docs, {"none": 1.0}).count() == 0 and mixing.mix_sources(docs.limit(0)).count() == 0
    big = mixing.mix_sources(docs, {"s0": 1.0}).select("rate").first().rate
    assert big > 10 and abs(mixing.mix_sources(docs, {"s0": 1.0}).count() / docs.where("source = 's0'").count() / big - 1) < 0.1


@pytest.mark.parametrize("shard", [17, 40, 10_000])
def test_top_k(spark, shard):
    rng = np.random.default_rng(1)
    rows = [(int(k), (rng.normal(size=4) * (0 if k % 3 == 0 else 1)).tolist()) for k in range(300)]
    rows += [(301, None), (302, []), (303, [1.0, None, 0.0, 0.0]), (304, [float("nan"), 0.0, 0.0, 0.0]), (305, [1.0]), (320, [2.0, 1.0]), (340, []), (7, rows[7][1]), (None, [9.0])]
    d = spark.createDataFrame([(*r, "x") for r in rows], "id long, e array<double>, rank string").select("rank", "id", topk.integers(F.col("e")).alias("v"))
    got = {}
    for r in topk.top_k(d, F.col("id") % 20 == 0, 5, shard=shard, block=4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    v = [(i, np.floor(64 * np.array([*e, 0, 0, 0, 0][:4]))) for i, e in rows if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    assert set(got) == {i for i, _ in v if i % 20 == 0}
    for q, x in v:
        if q % 20 == 0:
            best = sorted((-int(x @ y), i) for i, y in v if i != q)[:5]
            assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert topk.top_k(d.limit(0), F.col("id") % 20 == 0, 5).count() == 0
    few = topk.top_k(d.where("id in (20, 21)"), F.col("id") % 20 == 0, 5).collect()
    assert [(r.query_id, r.vec_id) for r in few] == [(20, 21)]


def test_top_k_large_integers(spark):
    """Scores beyond 2**53 are exact; beyond a long they raise."""
    big = 134217729
    d = spark.createDataFrame([(0, [big, 1]), (1, [big, 0]), (2, [-big, 3])], "id long, v array<long>")
    out = topk.top_k(d, F.col("id") == 0, 5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in out] == [(1, big * big), (2, 3 - big * big)]
    with pytest.raises(OverflowError):
        topk.products(np.array([[2**62, 0]]), np.array([[4, 0]]))
    huge = spark.createDataFrame([(0, [1.0, 3e38])], "id long, e array<float>")
    with pytest.raises(Exception, match="does not fit a long"):
        huge.select(topk.integers(F.col("e"))).collect()
    assert topk.products(np.array([[2**61, 5]]), np.array([[3, -1]])).tolist() == [[3 * 2**61 - 5]]


def test_warc_round_trip(spark):
    same = "<p>" + "s" * 200
    rows = [(5, "http://a/é\r\nx", same, 1), (3, None, same, 1), (9, "u", same, 1), (3, "u2", same, 1), (None, "u", same, 1), (4, "u", None, 1), (6, "u", "", 1), (7, "u", "short", 1), (8, "u", "short", 1), (10, "u", "é" * 300_000, 1)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    a, b = scratch(spark, "warc"), scratch(spark, "warc")
    m = warc.write_warc(d, a, roll_bytes=400).collect()
    assert sum(r.records for r in m) == len(rows) and len(m) > 2
    assert sorted((r.file, r.sha256) for r in m) == sorted((r.file, r.sha256) for r in warc.write_warc(d.orderBy("html"), b, roll_bytes=400).collect())
    out = warc.read_warc(spark, a, with_payload=True).collect()
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out)
    want = Counter()
    for i, _, h, _ in rows:
        p = (h or "").encode()
        again = h == same and i != 3
        want[i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", 3 if again else None] += 1
    assert got == want
    assert {bytes(r.payload) for r in out if r.record_type == "response"} == {(h or "").encode() for _, _, h, _ in rows}
    empty = scratch(spark, "warc")
    assert warc.write_warc(d.limit(0), empty).count() == 0 and warc.read_warc(spark, empty).count() == 0


def test_warc_second_write_and_dead_runs(spark, monkeypatch):
    """A writer that dies before or after either rename, a second write, and a writer that comes too late."""
    old = spark.createDataFrame([(k, f"http://a/{k}", f"old {k}" * 50) for k in range(9)], "page_id long, url string, html string")
    new = spark.createDataFrame([(k, f"http://a/{k}", f"new {k}" * 70) for k in range(20)], "page_id long, url string, html string")
    read = lambda folder: {r.page_id: bytes(r.payload).decode() for r in warc.read_warc(spark, folder, with_payload=True).collect()}
    whole = lambda d: {r.page_id: r.html for r in d.collect()}
    commit, folder = warc.commit_manifest, scratch(spark, "warc")

    def died(*_):
        raise KeyboardInterrupt

    for first in (old, new):  # parts are named, the manifest is not: nothing can be read, and the run can be repeated
        monkeypatch.setattr(warc, "commit_manifest", died)
        with pytest.raises(KeyboardInterrupt):
            warc.write_warc(first, folder, roll_bytes=300)
        with pytest.raises(FileNotFoundError):
            warc.read_warc(spark, folder)
    monkeypatch.setattr(warc, "commit_manifest", commit)
    warc.write_warc(old, folder, roll_bytes=300)
    assert read(folder) == whole(old)
    with pytest.raises(FileExistsError):
        warc.write_warc(new, folder)
    assert read(folder) == whole(old)
    monkeypatch.setattr(warc, "commit_manifest", died)  # a replacement that dies leaves the old archive
    with pytest.raises(KeyboardInterrupt):
        warc.write_warc(new, folder, replace=True)
    assert read(folder) == whole(old)
    monkeypatch.setattr(warc, "commit_manifest", lambda *a: (commit(*a), died()))  # dies after the commit
    with pytest.raises(KeyboardInterrupt):
        warc.write_warc(new, folder, roll_bytes=300, replace=True)
    monkeypatch.setattr(warc, "commit_manifest", commit)
    assert read(folder) == whole(new) and warc.generations(spark, folder) == [0, 1]
    (late := spark.createDataFrame([("x",)], "file string")).write.json(f"{folder}/.late.tmp")
    with pytest.raises(OSError, match="could not be committed"):
        warc.commit_manifest(spark, folder, ".late.tmp", 1)
    assert late.count() == 1 and warc.sweep(spark, folder) == 6  # four hidden manifests and the older generation
    assert read(folder) == whole(new) and warc.generations(spark, folder) == [1]


def test_warc_bytes_ignore_the_layout(spark):
    """Cuts follow from the rows: other partitions, the same files. Heavy ranges, one heavy id and null ids are cut too."""
    rng = random.Random(6)
    ids = [k * 7 for k in range(300)] + [5_000] * 120 + [None] * 60 + [2**62 + k for k in range(40)]
    rows = [(i, f"u{rng.random()}", "x" * rng.randrange(400)) for i in ids]
    made = []
    for n, by in ((1, "url"), (7, "html"), (3, "page_id")):
        rng.shuffle(rows)
        d = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(n, by)
        folder = scratch(spark, "warc")
        made.append(sorted((r.file, r.sha256, r.records) for r in warc.write_warc(d, folder, shard_bytes=3000).collect()))
        assert warc.read_warc(spark, folder).count() == len(rows)
    assert made[0] == made[1] == made[2] and len(made[0]) > 20
    assert max(n for _, _, n in made[0]) < 60


def brute_sketch(text):
    """(words, retained hashes) of a text."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    s = [w[k : k + 5] for k in range(len(w) - 4)] if len(w) >= 5 else [w] if w else []
    h = sorted({hashlib.md5(" ".join(x).encode()).hexdigest()[: fingerprint.DIGITS] for x in s})
    return w, [x for x in h if x[0] in "0123"]


def brute_likeness(a, b):
    (x, p), (y, q) = a, b
    return 1.0 if x == y else len(set(p) & set(q)) / len(set(p) | set(q)) if p or q else 0.0


@pytest.mark.parametrize("partitions", [1, 4])
def test_fingerprints(spark, partitions):
    """Every column against brute force: ties of ids, repeated rows, a null id, the wrap-around."""
    rows = awkward() + [(7, f"t{k} " * 7, "", "", 0) for k in range(40)] + [(None, "more null ids", "", "", 0)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", mark int").repartition(partitions)
    out = fingerprint.compare_edited(docs).select("*", fingerprint.to_string(F.col("sketch")).alias("f"), fingerprint.to_string(F.col("edited_sketch")).alias("e")).collect()
    line = sorted(((-(10**9) if r[0] is None else r[0], hashlib.md5((r[1] or "").encode()).hexdigest(), r[0], r[1] or "") for r in rows), key=lambda r: r[:2])
    want = []
    for k, (_, _, i, t) in enumerate(line):
        nxt, n = line[k - 1][3], len(t) // 3
        edited = t[: len(t) - n] + nxt[:n]
        a, b, c = map(brute_sketch, (t, edited, nxt))
        show = lambda s: (hashlib.md5(" ".join(s[0]).encode()).hexdigest()[: fingerprint.DIGITS] if s[0] else "") + ":" + "".join(s[1])
        want.append((i, len(t), edited, show(a), show(b), round(brute_likeness(a, b), 9), round(brute_likeness(a, c), 9)))
    got = [(r.doc_id, r.n_chars, r.edited, r.f, r.e, round(r.near_edited, 9), round(r.near_next, 9)) for r in out]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert fingerprint.compare_edited(spark.createDataFrame([], DOCS)).count() == 0
    one = fingerprint.compare_edited(spark.createDataFrame([(1, "a b c d e f", "", "", 0)], DOCS)).first()
    assert one.near_next == 1.0


def test_sketches_merge(spark):
    """The sketch of a union is the union of the sketches; containment tells a short text inside a long one."""
    rng = random.Random(9)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(4000))
    short, other = " ".join(long.split()[500:900]), " ".join(f"v{k}" for k in range(300))
    d = spark.createDataFrame([(long, short, other, long + " " + other)], "a string, b string, c string, u string")
    for c in "abcu":
        d = fingerprint.with_sketch(d, c, f"s{c}")
    s = {c: F.col(f"s{c}") for c in "abcu"}
    r = d.select(
        fingerprint.merge(s["a"], s["c"]).alias("m"), "su", fingerprint.containment(s["b"], s["a"]).alias("in_long"), fingerprint.containment(s["a"], s["b"]).alias("in_short"),
        fingerprint.containment(s["c"], fingerprint.merge(s["a"], s["b"])).alias("none"), fingerprint.likeness(fingerprint.merge(s["a"], s["b"]), s["a"]).alias("same"),
    ).first()
    ends = {hashlib.md5(" ".join((long.split() + other.split())[k : k + 5]).encode()).hexdigest()[: fingerprint.DIGITS] for k in range(3996, 4000)}
    assert set(r.su.hashes) - ends == set(r.m.hashes) and r.m.hashes == sorted(r.m.hashes) and r.m.digest is None
    assert r.in_long == 1.0 and abs(r.in_short - 0.1) < 0.03 and r.none == 0.0 and r.same == 1.0


def test_fingerprint_accuracy(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    r = fingerprint.compare_edited(d).select("near_edited", "near_next").collect()
    assert 0.35 < np.mean([x.near_edited for x in r]) < 0.6 and np.mean([x.near_next for x in r]) < 0.1


def test_mixing_spread_at_high_rates(spark):
    """Counts at a mean rate of about 100 spread as a Poisson distribution's."""
    from siltstone.llm import mixing

    docs = spark.createDataFrame([(k, "abcd", "rare") for k in range(400)] + [(-1, "z" * 320_000, "common")], "doc_id long, text string, source string")
    out = mixing.mix_sources(docs, shuffle=False).where("source = 'rare'").groupBy("doc_id").count().collect()
    n = [r["count"] for r in out]
    mean = sum(n) / len(n)
    assert len(n) == 400 and abs(mean - 100.5) < 3 and 75 < sum((x - mean) ** 2 for x in n) / (len(n) - 1) < 130


def test_mixing_odd_rows(spark):
    """Rows of one source and id draw alike, long texts only count, and the copies of a row are numbered from 0."""
    rows = [(1, "a" * 50, "s")] * 3 + [(2, "b" * 300_000, "t"), (3, None, "u"), (4, "", "u"), (5, "c" * 9, None)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, rate string")
    out = mixing.mix_sources(docs).collect()
    copies = Counter((r.doc_id, r.copy) for r in out)
    assert all(n % 3 == 0 for (i, _), n in copies.items() if i == 1) and {r.source for r in out} <= {"s", "t", None}
    assert all(isinstance(r.rate, float) for r in out)
