"""Operators on literals: sources, sinks, gates, dedup, graphs, rewriting, stages."""

import json

import pytest
from pyspark.sql import functions as F

from siltstone.functions import text as fn
from siltstone.operators import dedup, gates, graph, rewrite, stages, syntax
from siltstone.sources import files, sinks


def test_url_ids(spark):
    urls = ["https://www.youtube.com/watch?v=Ab-_9", "https://youtu.be/xyz", "http://a/embed/q1", "http://a/", None]
    d = spark.createDataFrame([(u,) for u in urls], "u string").select(files.url_id(F.col("u")).alias("id"))
    assert [r.id for r in d.collect()] == ["Ab-_9", "xyz", "q1", None, None]


def test_catalogue_and_exclusions(spark, tmp_path):
    for year, name, url in ((2015, "one", "https://youtu.be/a1\n"), (2016, "two", "nothing")):
        (tmp_path / "c" / str(year) / name).mkdir(parents=True)
        (tmp_path / "c" / str(year) / name / "video_url.txt").write_text(url)
    rows = files.read_catalogue(spark, str(tmp_path / "c")).collect()
    assert [(r.entry, r.year, r.video_id) for r in rows] == [("one", 2015, "a1")]
    (tmp_path / "x.txt").write_text("We should skip these\nList of them\n\n2015\n- a https://e.com/watch?v=Q_1&pp=2\n- b no link\n- a https://e.com/watch?v=Q_1\n")
    assert [r.video_id for r in files.read_exclusions(spark, str(tmp_path / "x.txt")).collect()] == ["Q_1"]


def test_json_states_and_salvage(spark):
    raw = ["", "  ", '{"a": 1}', '{\n"a": 2\n}\n$ shell', '{"a": ', None]
    d = spark.createDataFrame([(k, r) for k, r in enumerate(raw)], "k int, r string")
    out = d.select("k", files.json_state(F.col("r")).alias("s"), files.salvage_json(F.col("r")).alias("j")).orderBy("k").collect()
    assert [r.s for r in out] == ["empty", "empty", "valid", "corrupt", "corrupt", "empty"]
    assert json.loads(out[3].j) == {"a": 2} and out[4].j is None


def test_match_layouts(spark):
    raw = ['{"status": "matched", "confidence_score": 0.9, "primary_files": ["a"]}', '{"process_status": "done", "match_data": {"confidence_score": 0.5}}']
    d = spark.createDataFrame([(r,) for r in raw], "r string").select(files.normalise_matches(F.col("r")).alias("m")).select("m.*")
    assert [tuple(r) for r in d.collect()] == [("matched", 0.9, ["a"]), ("done", 0.5, [])]


def test_logs(spark, tmp_path):
    (tmp_path / "new.json").write_text('{"v": "a", "x": 1}\n{"v": "b"}\n')
    (tmp_path / "old.json").write_text('{"v": "a", "x": 9, "y": 2}\n{"v": "c", "y": 3}\n')
    rows = files.read_logs(spark, str(tmp_path / "new.json"), str(tmp_path / "old.json"), "v").orderBy("v").collect()
    assert [(r.v, r.x, r.y) for r in rows] == [("a", 1, 2), ("b", None, None), ("c", None, 3)]


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([(1, True, "a"), (2, False, "b"), (3, None, "c")], "k int, ok boolean, t string")
    sinks.write_valid(d, "ok", str(tmp_path / "v"), str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "v")).count() == 1 and spark.read.parquet(str(tmp_path / "q")).count() == 2
    for _ in range(2):
        sinks.append_jsonl(d, str(tmp_path / "h"))
    assert spark.read.json(str(tmp_path / "h")).count() == 6
    new = spark.createDataFrame([(1, 5, "n"), (9, 1, "z")], "k int, at int, t string")
    old = spark.createDataFrame([(1, 5, "o"), (2, 7, "p")], "k int, at int, t string")
    assert sorted(map(tuple, sinks.upsert(old, new, ["k"], "at").collect())) == [(1, 5, "n"), (2, 7, "p"), (9, 1, "z")]
    assert sinks.monolith(d.withColumn("g", F.lit(1)), "g", "k", "t").first().t == "a\n\nb\n\nc"


def test_gate_order(spark):
    d = spark.createDataFrame([(1, None), (0, 0.2), (0, 0.9)], "x int, c double")
    out = gates.first_failing(d, [("excluded", "x = 1"), ("low", "coalesce(c, 0D) < 0.8D")]).collect()
    assert [(r.reason, r.eligible) for r in out] == [("excluded", False), ("low", False), ("ok", True)]


def test_dedup(spark):
    d = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "a"), (5, None)], "k int, v string")
    kept = dedup.drop_consecutive(d.withColumn("g", F.lit(0)), ["g"], ["k"], "v").select("k").collect()
    assert sorted(r.k for r in kept) == [1, 2, 3]
    assert sorted(r.k for r in dedup.keep_first(d, ["v"], ["k"]).collect()) == [1, 2, 5]
    h = spark.createDataFrame([("a # x\n\nb",), ("a\nb  ",), ("a\n b",)], "t string").select(dedup.content_hash(F.col("t")).alias("h")).collect()
    assert h[0] == h[1] != h[2]


def test_closure(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 4), (None, 1)], "src long, dst long")
    assert {tuple(r) for r in graph.closure(e).collect()} == {(a, b) for a in (1, 2, 3) for b in (1, 2, 3)} | {(4, 4)}
    assert graph.closure(e.limit(0)).count() == 0


def test_rewrite(spark):
    d = spark.createDataFrame([("aab",)], "t string")
    out, counts = rewrite.fold_counted(F.col("t"), [("a", "b"), ("b", "c")])
    assert tuple(d.select(out, counts).first()) == ("ccc", [2, 3])
    assert fn.import_kind(F.col("t"))


def test_syntax_facts():
    f = syntax.facts("import os\nX = 1\ndef f():\n    return X + g()\nclass S(Scene):\n    def construct(self, a):\n        f()\n")
    assert f["valid"] and f["functions"] == ["f"] and f["constants"] == ["X"] and f["undefined"] == ["Scene", "g"]
    assert {(u["src"], u["dst"]) for u in f["uses"]} == {("f", "X"), ("S", "f")}
    assert f["scenes"][0]["parameters"] == 1
    assert not syntax.facts("def f(:")["valid"] and syntax.facts(None)["valid"] and not syntax.facts("'\\U1'")["valid"]


@pytest.mark.parametrize(
    ("code", "want"),
    [
        ("x = VGroup([a, b])", "x = VGroup(a, b)"),
        ("x = DL", "x = DOWN + LEFT"),
        ("x = a.points[0] - b.points[-1]", "x = a.get_start() - b.get_end()"),
        ("x = a.get_width()", "x = a.width"),
        ("Tex(['a', 'b'])", "Text2"),
        ("ShowCreation(Tex('x^2'))", "Create(MathTex('x^2'))"),
        ("from manimlib import x", "from manim import *"),
    ],
)
def test_convert(code, want):
    out = syntax.convert(code)
    assert out["valid"]
    assert out["code"] == ("Tex('a b')" if want == "Text2" else want)


def test_convert_config_and_parameters():
    out = syntax.convert("class A(Scene):\n    CONFIG = {'c': 1}\n    def construct(self):\n        pass\n")["code"]
    assert "CONFIG" not in out and "self.c = 1" in out and "super().__init__(**kwargs)" in out
    moved = syntax.parameterless("class A(Scene):\n    def construct(self, n, m=2):\n        self.add(n + m)\n", "A")
    assert "def construct(self):" in moved and "self.add(self.n + self.m)" in moved and "m=2" in moved
    assert syntax.parameterless("class A: pass", "A") is None
    assert syntax.repair("def f(x:\n    g(h(1)\n") != "def f(x:\n    g(h(1)\n"


def test_stages(spark, tmp_path):
    first = spark.range(5)
    steps = [("a", lambda d: d.where("id > 1")), ("b", lambda d: d.withColumn("x", F.col("id") * 2))]
    out, ran = stages.run_stages(spark, first, steps, str(tmp_path))
    assert ran == ["a", "b"] and out.count() == 3
    assert stages.run_stages(spark, first, steps, str(tmp_path))[1] == []
    out, ran = stages.run_stages(spark, first, steps, str(tmp_path), force=True)
    assert ran == ["a", "b"]
    assert stages.resume(first, out, "id").count() == 2
    assert "n" in stages.report(out, "x", {"top": "max(id)"})


def test_screened_rules(spark):
    """Whatever a rule matches holds one of its strings; screening changes no result; rules without strings are always tried."""
    import re

    from siltstone import rules as R
    from siltstone.operators import rules as ops
    from siltstone.operators.screening import matched_if_worth, required

    assert required(r"a(?:bc|d)+e?") == {"abc", "ad"} or required(r"a(?:bc|d)+e?") is not None
    assert required(r"(foo|barbaz)\s*\(\s*\[") == {"foo", "barbaz"} and required(r"\w+\d") is None and required(r"x?y*") is None and required(r"(?i)abc") is None
    assert required(r"^def [ab]x:") == {"def ax:", "def bx:"} and required("(") is None
    every = R.UNFIXABLE + R.HIGH_RISK + R.RUNTIME + R.PROBLEMATIC
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(40).collect()]
    texts = [*texts, None, "", *["Tex([x]) MathTex (['a'])", "self.play(Transform(a, b)) CONFIG = {", "class A(PiCreatureScene):\n  pass", "from manimlib import *\nimport cv2\nRandolph()", "DL DR FRAME_WIDTH x.get_width()"]]
    for r in every:
        for t in filter(None, texts):
            if not r.literal and required(r.pattern) and re.search(r.pattern, t, re.M):
                assert any(s in t for s in required(r.pattern)), (r.pattern, t[:80])
    d = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id long, t string")
    want = {r.id: r.m for r in d.select("id", ops.matched(F.col("t"), every).alias("m")).collect()}
    assert {r.id: r.m for r in matched_if_worth(d, "t", every, "m").select("id", "m").collect()} == {k: v or [] for k, v in want.items()}
    assert any(want.values())


def test_prompts(spark):
    """Unknown and tied terms, no terms, null fields, braces that are no fields, solutions that tie."""
    from siltstone.operators import prompts

    asked = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (1, "new"), (2, "b"), (3, "d"), (3, "e")], "key long, term string")
    history = spark.createDataFrame([("a", 1, 3), ("b", 3, 1), ("c", 0, 0), ("d", 2, 2), ("other", 9, 0)], "term string, ok long, bad long")
    assert {r.key: r.terms for r in prompts.ranked_terms(asked, history).collect()} == {1: ["b", "c", "new", "a"], 2: ["b"], 3: ["d", "e"]}
    d = spark.createDataFrame([(1, None, ["b", "c", "new", "a"], 11, 5), (2, "{x}", [], 1, 10_001), (3, "t", None, 11, 20_000)], "id long, t string, terms array<string>, files int, largest int")
    base = prompts.filled("Of {title}{none} {title}.", title=F.col("t"))
    got = d.select(prompts.matching_prompt(base, F.col("terms")).alias("m"), prompts.cleaning_prompt(F.lit("b"), F.col("files"), F.col("largest")).alias("c"), prompts.timeout_class(F.col("largest")).alias("t")).collect()
    assert got[0].m.startswith("Of unknown{none} unknown.\n\nLEARNED") and got[0].m.endswith("well: b, c, new") and got[1].m == "Of {x}{none} {x}." and got[2].m == "Of t{none} t."
    assert [r.c.count("\n") for r in got] == [3, 3, 4] and [r.t for r in got] == ["small", "medium", "large"]
    best = prompts.best_solutions(spark.createDataFrame([("x", "s", 2), ("x", "t", 2), ("x", "u", 1), ("y", "v", 0)], "category string, solution string, worked long"))
    assert {tuple(r) for r in best.collect()} == {("x", "t", 2), ("y", "v", 0)}
    p = best.select(*[prompts.fixing_prompt(F.lit("b"), F.lit(k), F.col("solution"), F.col("worked")).alias(f"p{k}") for k in (1, 2)]).orderBy("p1").collect()
    assert p[1].p1 == "b\n\nLEARNED SOLUTIONS:\nKNOWN SOLUTION (worked 2 times):\nt" and {r.p2 for r in p} == {"b"}
