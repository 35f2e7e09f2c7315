"""Readers of folders, logs that are upserted, graphs against plain Python, containment joins, retries."""

import json
import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import graph, rewrite, running, stages
from siltstone.operators import substrings
from siltstone.operators.substrings import contained_pairs
from siltstone.sources import files, sinks, versioned


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_folders(spark, tmp_path):
    c = tmp_path / "c"
    put(c / "2015" / "how-to-count" / "video_url.txt", "https://youtu.be/a1\n")
    put(c / "2015" / "how-to-count" / "english" / "sentence_timings.json", json.dumps([["One.", 0, 1], ["Two.", 1], "odd", []]))
    put(c / "2015" / "plain" / "video_url.txt", "https://youtu.be/b2")
    put(c / "2015" / "plain" / "transcript.txt", " some words \n")
    put(c / "2015" / "named" / "english" / "sentence_timings.json", "[]")
    put(c / "2015" / "named" / "english" / "title.json", '{"input": "A Name"}')
    assert {r.entry: r.has_english for r in files.read_catalogue(spark, str(c)).collect()} == {"how-to-count": True, "plain": False}
    assert {tuple(r) for r in files.read_transcripts(spark, str(c / "2015")).collect()} == {("how-to-count", "One. Two.", "How To Count"), ("named", "", "A Name")}
    assert [tuple(r) for r in files.read_plain_transcripts(spark, str(c / "2015")).collect()] == [("plain", "some words")]
    sizes = {r.folder: (r.files, r.total_size) for r in files.total_sizes(spark, str(c), "*.txt").collect()}
    assert sizes == {"how-to-count": (1, 20), "plain": (2, 19 + 13)}


def test_damaged_matches(spark, tmp_path):
    put(tmp_path / "a" / "matches.json", '{"status": "matched", "confidence_score": 0.9, "primary_files": ["f"]}')
    put(tmp_path / "b" / "matches.json", 'log line\n  {"match_data": {\n "confidence_score": 0.7},\n "process_status": "done"}\n$ shell }')
    put(tmp_path / "c" / "matches.json", '{"status": ')
    put(tmp_path / "d" / "matches.json", "  ")
    got = {r.entry: (r.state, r.status, r.confidence, r.primary_files) for r in files.read_matches(spark, str(tmp_path)).collect()}
    assert got == {"a": ("valid", "matched", 0.9, ["f"]), "b": ("salvaged", "done", 0.7, []), "c": ("corrupt", "corrupted_recovered", 0.0, []), "d": ("empty", "corrupted_recovered", 0.0, [])}


def test_mappings_and_symbols(spark, tmp_path):
    put(tmp_path / "m.json", '{"v1": {"files": ["a"]}, "v2": {"files": []}}')
    m = files.read_mappings(spark, str(tmp_path / "m.json")).select("key", F.try_variant_get("value", "$.files[0]", "string").alias("f"))
    assert {tuple(r) for r in m.collect()} == {("v1", "a"), ("v2", None)}
    index = {"modules": {"data/videos/geo.py": ["Shape"], "data/videos/custom/geo.py": ["Other"], "data/videos/x/characters/pi.py": ["Pi"]}, "imports": {"data/videos/geo.py": ["import os"]}}
    put(tmp_path / "i.json", json.dumps(index))
    symbols, statements = files.read_symbol_index(spark, str(tmp_path / "i.json"))
    assert statements.count() == 1
    wanted = spark.createDataFrame([(1, "geo"), (2, "characters.pi"), (3, "some_animation_lib"), (4, "nowhere")], "key int, module string")
    got = {(r.key, r.symbol, r.way) for r in files.resolve_star_imports(wanted, symbols, {"animation": ["FadeIn", "Write"]}).collect()}
    assert got == {(1, "Shape", "index"), (2, "Pi", "index"), (3, "FadeIn", "heuristic"), (3, "Write", "heuristic")}


def test_logs(spark, tmp_path):
    path, row = str(tmp_path / "log"), "video string, stage string, at long, data string"
    assert sinks.upsert_log(spark, path, spark.createDataFrame([("v", "match", 1, "a"), ("v", "clean", 1, "b")], row), ["video", "stage"], "at") == 2
    assert sinks.upsert_log(spark, path, spark.createDataFrame([("v", "match", 2, "c"), ("w", "match", 1, "d")], row), ["video", "stage"], "at") == 3
    log = versioned.VersionedLog(spark, path, ["video", "stage"], "at")
    assert {(r.video, r.stage): r.data for r in log.read().collect()}["v", "match"] == "c"
    for f in (tmp_path / "log").rglob("*.parquet"):
        f.write_bytes(b"damaged")
    assert sinks.upsert_log(spark, path, spark.createDataFrame([("z", "match", 9, "e")], row), ["video", "stage"], "at") == 1
    assert (tmp_path / "log.corrupted").exists()
    sinks.write_summary(spark.createDataFrame([(2015, 3), (2016, 4)], "year int, n int"), str(tmp_path / "s"), "year")
    assert spark.read.json(str(tmp_path / "s")).count() == 2


def test_damaged_stage_is_run_again(spark, tmp_path):
    steps = [("a", lambda d: d.where("id > 1"))]
    stages.run_stages(spark, spark.range(5), steps, str(tmp_path))
    for f in (tmp_path / "a").glob("*.parquet"):
        f.write_bytes(b"damaged")
    for f in (tmp_path / "a").glob(".*.crc"):
        f.unlink()
    out, ran = stages.run_stages(spark, spark.range(5), steps, str(tmp_path))
    assert ran == ["a"] and out.count() == 3
    page = stages.dashboard(spark.createDataFrame([("<a>", 1), ("b", 2), ("b", 3)], "g string, n int"), "g", {"sum": "sum(n)"}, "T")
    assert "<td>&lt;a&gt;</td><td>1</td>" in page and "<td>b</td><td>5</td>" in page


def test_stages_follow_input_and_code(spark, tmp_path):
    """A stage runs again when the rows it is made of or its code changed, and only then."""
    run = lambda df, steps: stages.run_stages(spark, df, steps, str(tmp_path))
    keep = lambda least: [("a", lambda d: d.where(F.col("id") > least)), ("b", lambda d: d.selectExpr("id * 2 AS id"))]
    assert run(spark.range(6), keep(1))[1] == ["a", "b"] and run(spark.range(6).orderBy(F.desc("id")), keep(1))[1] == []
    out, ran = run(spark.range(7), keep(1))
    assert ran == ["a", "b"] and out.count() == 5
    out, ran = run(spark.range(7), keep(3))
    assert ran == ["a", "b"] and out.count() == 3
    out, ran = run(spark.range(7), [keep(3)[0], ("b", lambda d: d.selectExpr("id * 3 AS id"))])
    assert ran == ["b"] and out.agg(F.max("id")).first()[0] == 18


def test_retries():
    pauses = []
    assert stages.retried(lambda k: k == 2, wait=pauses.append) == (True, [600.0, 900.0, 1350.0]) and pauses == [10.0, 20.0]
    assert stages.retried(lambda k: False, attempts=2, wait=pauses.append)[0] is False


def test_graphs_against_python(spark):
    rng = random.Random(4)
    edges = {(rng.randrange(25), rng.randrange(25)) for _ in range(30)}
    e = spark.createDataFrame([*edges, (None, 1), (2, None)], "src long, dst long")
    out = {}
    for a in range(25):
        seen, todo = set(), [a]
        while todo:
            x = todo.pop()
            for s, d in edges:
                if s == x and d not in seen:
                    seen.add(d)
                    todo.append(d)
        out[a] = seen
    assert {tuple(r) for r in graph.closure(e).collect()} == {(a, b) for a, s in out.items() for b in s}
    roots = spark.createDataFrame([(3,), (7,)], "node long")
    assert {r.node for r in graph.reachable(e, roots).collect()} == {3, 7} | out[3] | out[7]
    nodes = spark.range(25).withColumnRenamed("id", "node")
    layer = {r.node: r.layer for r in graph.layers(nodes, e).collect()}
    assert set(layer) == set(range(25))
    free = [(a, b) for a, b in edges if a not in out[a] and b not in out[b] and not any(x in out[x] for x in out[a])]
    assert all(layer[a] > layer[b] for a, b in free) and graph.layers(nodes.limit(0), e).count() == 0


def test_depths(spark):
    e = spark.createDataFrame([(k, (k - 1) // 2) for k in range(1, 40)] + [(100, 101)], "src long, dst long")
    got = {r.node: r.depth for r in graph.depths(e).collect()}
    assert got[0] == 0 and got[39] == 5 and got[100] == 1 and got[101] == 0 and got[7] == 3
    with pytest.raises(ValueError, match="cycle"):
        graph.depths(spark.createDataFrame([(1, 2), (2, 1)], "src long, dst long"), rounds=5)


def _random_graph(seed, n=40, m=70):
    rng = random.Random(seed)
    rows = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
    reach = {k: {k} for k in range(n)}
    for _ in range(n):
        for a, b in rows:
            reach[a] |= reach[b]
    return rows, reach


@pytest.mark.parametrize("seed", range(2))
def test_components_layers_and_reachability(spark, seed):
    """Random graphs with cycles of many lengths, loops, repeated and null edges, against plain Python."""
    rows, reach = _random_graph(seed)
    e = spark.createDataFrame(rows + rows[:5] + [(3, 3), (None, 1), (2, None)], "src long, dst long")
    used = {x for r in rows for x in r}
    same = lambda k: min(j for j in reach[k] if k in reach[j])
    assert {r.node: r.component for r in graph.components(e).collect()} == {k: same(k) for k in used}
    nodes = spark.range(45).select(F.col("id").alias("node"))
    layer = {r.node: r.layer for r in graph.layers(nodes, e).collect()}
    assert set(layer) == set(range(45)) and all(layer[a] > layer[b] if same(a) != same(b) else layer[a] == layer[b] for a, b in rows)
    pairs = [(a, b) for a in range(40) for b in range(40)] + [(None, 1), (1, None), (99, 1)]
    got = {(r.a, r.b): r.reaches for r in graph.Reachability(nodes, e).reaches(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {(a, b): a in reach and b in reach[a] for a, b in pairs}


def test_many_cycles_in_few_rounds(spark):
    """Ten thousand cycles of two nodes settle in under forty rounds; a long search is ended."""
    two = spark.range(10_000).selectExpr("id * 2 AS src", "id * 2 + 1 AS dst")
    e = two.unionByName(two.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    assert graph.components(e, rounds=39).where("component = node - node % 2").count() == 20_000
    line = spark.range(60).selectExpr("id AS src", "(id + 1) % 60 AS dst")
    with pytest.raises(ValueError, match="not settled"):
        graph.components(line, rounds=10)
    assert graph.components(e.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [1, 3, 4096])
def test_containment(spark, monkeypatch, hot):
    """Against trying all pairs: empty, null and short texts, repeats of one gram, overlaps, and hot grams dealt out by salts."""
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "PIECE", 7)
    monkeypatch.setattr(substrings, "MOST_BROADCAST", 0 if hot == 3 else 1000)
    rng = random.Random(hot)
    texts = ["", "x", "abc", "bcde", "abcde", "zz", "aaaaa", "a" * 40, "a" * 60 + "b", "abababab", "éàé", None] + ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 14))) for _ in range(60)]
    a = spark.createDataFrame([(k, t, "c") for k, t in enumerate(texts)], "id long, text string, at string")
    b = spark.createDataFrame([(1000 + k, t, "c") for k, t in enumerate(texts[::-1])], "id long, text string, gram string")
    got = sorted(tuple(r) for r in contained_pairs(a, b).collect())
    want = sorted((k, 1000 + j) for k, s in enumerate(texts) for j, t in enumerate(texts[::-1]) if s is not None and t is not None and s in t)
    assert got == want
    assert contained_pairs(a.limit(0), b).count() == contained_pairs(a, b.limit(0)).count() == 0


def test_containment_looks_up_rare_grams(spark):
    """At most ten candidates a result, on the parts' brands and types, and texts are joined by id only."""
    p = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    a = p.groupBy(F.col("p_brand").alias("text")).agg(F.min("p_partkey").alias("id"))
    b = p.groupBy(F.concat("p_brand", F.lit(" "), "p_type").alias("text")).agg(F.min("p_partkey").alias("id"))
    tried, found = substrings.candidates(a, b), contained_pairs(a, b).count()
    assert found and tried.count() <= 10 * found and set(tried.columns) == {"short_id", "long_id"}


def test_running_sums(spark):
    rng = random.Random(8)
    rows = [(k, rng.choice(["a", "b", None]), rng.randrange(100)) for k in range(500)]
    d = spark.createDataFrame(rows, "id long, g string, v long").repartition(3)
    sums, want = {}, {}
    for k, g, v in rows:
        s = sums.setdefault(g, [0, 0])
        s[0] += v
        s[1] += 1
        want[k] = tuple(s)
    assert {r.id: (r.running_sum, r.running_count) for r in running.running_sums(d, "g", "id", "v", 7).collect()} == want
    assert running.running_sums(d.limit(0), "g", "id", "v").count() == 0


def test_folded_one_projection_a_rule(spark):
    d = spark.createDataFrame([("aab",), (None,)], "t string")
    got = [(r.folded, r.counts) for r in rewrite.with_folded(d, "t", [("a", "b"), ("b", "c")]).collect()]
    assert got == [("ccc", [2, 3]), (None, [None, None])]


def test_look_ahead_rule(spark):
    from siltstone import rules as R
    from siltstone.operators import rules as ops

    d = spark.createDataFrame([("f(x)  # undefined\ng(y)\n",), ("f(x); h(z) # undefined",)], "t string")
    rule = [r for r in R.RUNTIME if r.name == "undefined_functions"]
    assert [r.n for r in d.select(ops.occurrences(F.col("t"), rule).alias("n")).collect()] == [1, 2]


def test_fast_patterns_occur_in_the_same_texts(spark):
    """Patterns without backtracking against the ones they stand for, over random texts of the pieces that they look for."""
    import re

    from siltstone import rules as R
    from siltstone.operators import rules as ops

    rng = random.Random(12)
    pieces = ["(", ")", "[", "]", ",", ":", "\n", "\n  ", " ", "if", "for", "in", "self.add(", "self.play(", "x", "[[", "]]"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25))) for _ in range(3000)]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    fast = [r for r in R.HIGH_RISK if r.fast]
    got = d.select("t", *[ops.hits(F.col("t"), r, "ms").alias(r.name) for r in fast]).collect()
    assert len(fast) == 6
    for r in fast:
        want = [re.search(r.pattern, x.t, re.M | re.S) is not None for x in got]
        assert [x[r.name] for x in got] == want and {True, False} == set(want), r.name
