"""Queries read whole texts: what lies far into a text counts. Results are compared with plain Python."""

import hashlib
import re

import pytest

from siltstone import rules as R
from siltstone.plans import registry
from siltstone.sources.samples import CODE

FAR = "plain words " * 60
TAILS = [
    "\nimport late_module\nfrom manimlib.imports import *\nself.play(ShowCreation(x.get_center()))\n",
    " costs $5 ((( [",
    " see http://example.org/",
    "\nclass Late(PiCreatureScene):\n    CONFIG = {'a': TextMobject('x')}\n",
    "",
]
DOCS = [(k, FAR + TAILS[k % len(TAILS)], "en", f"s{k % 2}", 0) for k in range(20)]


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    return d


def rows(spark, sf, name):
    return {r.doc_id: r for r in registry.QUERIES[name](spark, sf).collect()}


def code(k, text):
    return CODE[k % len(CODE)] + text


def test_rules_and_markers(spark, sf):
    hit = lambda r, c: r.pattern in c if r.literal else re.search(r.pattern, c, re.M) is not None
    n = lambda rules, c: sum(int(r.weight) * len(re.findall(r.pattern, c, re.M)) for r in rules)
    found = {name: rows(spark, sf, name) for name in ("rule_match_matrix", "bracket_balance", "math_content", "change_labels", "complexity_score", "post_conversion_quality")}
    for k, text, *_ in DOCS:
        c = code(k, text)
        assert found["rule_match_matrix"][k].found == ",".join(r.name for r in R.UNFIXABLE if hit(r, c))
        assert found["bracket_balance"][k].round_open == c.count("(") - c.count(")")
        assert found["bracket_balance"][k].square_open == c.count("[") - c.count("]")
        assert (k in found["math_content"]) == ("http" not in c)
        if "http" not in c:
            assert found["math_content"][k].has_math == any(w in c for w in ("$", "\\frac", "\\sum", "^"))
        assert ("creation" in found["change_labels"][k].labels) == ("ShowCreation" in c)
        assert found["complexity_score"][k].complexity == n(R.COMPLEXITY, c) + len(c.split("\n")) // 50
        assert found["post_conversion_quality"][k].issues == n(R.RUNTIME, c)
    assert sum(r.n for r in registry.QUERIES["rule_hits_rollup"](spark, sf).collect()) == sum(hit(r, code(k, t)) for k, t, *_ in DOCS for r in R.UNFIXABLE)


def test_rewritten_texts(spark, sf):
    def folded(c, rules):
        for p, r in rules:
            c = re.sub(p, re.sub(r"\$(\d)", r"\\\1", r), c)
        return c

    renamed, fixed, imports = (rows(spark, sf, name) for name in ("rename_fold", "runtime_regex_fix", "import_organize"))
    for k, text, *_ in DOCS:
        c = code(k, text)
        assert renamed[k].renamed == md5(folded(c, R.RENAMES))
        assert fixed[k].fixed == md5(folded(c, R.RUNTIME_FIXES))
        lines = {s.strip(" ") for s in c.split("\n") if s.strip(" ").startswith(("import ", "from "))}
        assert (imports[k].n if k in imports else 0) == len(lines)


def test_includes_shared_parts_and_fixes(spark, tmp_path):
    head = "the same opening of forty characters and more "
    docs = [(1, head + "a\n", "s"), (2, head + "b", "s"), (3, head + "a  # note", "s"), (4, head + "b", "t"), (5, head * 20, "s")]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(2, head + "fix")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    turns = [(1, 1, "user", head + "x"), (1, 2, "user", head + "y"), (2, 1, "user", head + "x"), (2, 2, "tool", head + "y")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    run = lambda name: registry.QUERIES[name](spark, str(tmp_path)).collect()
    whole = {1: docs[0][1], 2: docs[1][1], 5: docs[4][1]}
    assert {r.source: (r.content, r.files) for r in run("simple_include")} == {"s": (md5("\n".join(whole.values())), 3), "t": (md5(docs[3][1]), 1)}
    assert {(r.conv_id, r.turn): r.shared for r in run("shared_code_factoring")} == {(1, 1): True, (1, 2): False, (2, 1): True, (2, 2): False}
    assert {r.doc_id: r.fix for r in run("manual_fix_lookup")} == {1: "none", 2: head + "fix", 3: "none", 4: "none", 5: "none"}


def test_every_row_takes_part(spark, tmp_path):
    def put(name, data, schema):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    run = lambda name: registry.QUERIES[name](spark, str(tmp_path)).collect()
    put("orders", [(k, "P", "FOP"[k % 3]) for k in range(1, 13)], "o_orderkey long, o_orderpriority string, o_orderstatus string")
    put("documents", [(k, None if k == 5 else "en" if k < 4 else "de") for k in range(1, 8)], "doc_id long, lang string")
    put("labels", [(5, 1), (5, 1), (6, 0), (99, 1)], "doc_id long, quality int")
    put("events", [(k, "error" if k % 3 else "view", '{"k": %d}' % (95 + k if k > 8 else 1)) for k in range(1, 13)], "event_id long, event_type string, props string")
    merged = {r.o_orderkey: r.action for r in run("logs_merge_outer")}
    assert merged == {k: ("move", "new", "merge")[k % 3] for k in range(1, 13)}
    assert {r.kind: r.n for r in run("union_all_sources")} == {"primary": 3, "supporting": 4}
    assert sorted(r.node for r in run("graph_unused")) == [3, 4, 6, 7]
    errors = {k: k > 8 for k in range(1, 13) if k % 3}
    want = {k: (min(x for x in errors if errors[x] == b), sum(v == b for v in errors.values())) for k, b in errors.items()}
    assert {r.event_id: (r.fix_id, r.n_similar) for r in run("fix_suggestions")} == want
