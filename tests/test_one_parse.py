"""A source is parsed once a query and its tree walked by tables of fields."""

import ast
import inspect

import pytest

from siltstone.operators import constants, snippets, syntax, trees, validators
from siltstone.plans import registry

SF = "/root/testdata/sf0.001"
CODE = "import os\nfrom manimlib.imports import *\nN = 2\nM = N + 1\n\ndef f(x):\n    return x + N\n\nclass S(Scene):\n    CONFIG = {'a': 1}\n    def construct(self, k):\n        global G\n        self.add(f(M), lost.get_width())\n        type T = int\n"
MARKS = (ast.expr_context, ast.operator, ast.unaryop, ast.boolop, ast.cmpop)


@pytest.mark.parametrize("code", ["", CODE, *map(inspect.getsource, (ast, inspect, trees, syntax)), "match x:\n    case P(a=[1, *r], b={'k': None, **q}) | None: pass\n", "def f(*, a, b=1): ...\ntype T[U: int] = list[U]\nd = {**a, 1: 2}\n"])
def test_nodes_are_those_of_walk(code):
    tree = ast.parse(code)
    assert [id(n) for n in trees.nodes(tree)] == [id(n) for n in ast.walk(tree) if not isinstance(n, MARKS)]


@pytest.mark.parametrize("name", ["star_symbols", "source_undefined", "scene_files"])
def test_one_python_step(spark, name):
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EvalPython [") == 1


def test_symbols_are_counted_before_the_join(spark):
    plan = registry.QUERIES["star_symbols"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner")
    assert "count(1)" in plan[join:]  # below the join


def test_one_parse_and_no_plain_walk(monkeypatch):
    parsed, parse = [], ast.parse
    monkeypatch.setattr(ast, "walk", None)
    monkeypatch.setattr(ast, "parse", lambda code: parsed.append(code) or parse(code))
    facts = syntax.facts(CODE)
    assert sorted((u["src"], u["dst"]) for u in facts["uses"]) == [("M", "N"), ("S", "M"), ("S", "f"), ("f", "N")]
    assert syntax.file_imports(CODE)["star"] == ["manimlib.imports"]
    assert [i["type"] for i in validators.before_conversion(CODE)] == ["method_to_property"]
    assert {i["type"] for i in validators.before_render(CODE)} == {"invalid_import", "deprecated_config", "invalid_construct", "deprecated_method"}
    assert [i["message"] for i in validators.scene(CODE)] == ["Potentially undefined names: lost"]
    assert {c["name"]: c["value"] for c in constants.constants(CODE)} == {"N": "2", "M": "3"}
    assert [f["scene"] for f in snippets.scene_files(CODE)] == ["S"]
    assert len(parsed) == 7


def test_scene_files_are_those_of_each_scene():
    code = CODE + "\nclass R(S2Scene):\n    x = f\n"
    assert snippets.scene_files(code) == [{"scene": s, "file": snippets.self_contained(code, s)} for s in ("S", "R")]
    assert snippets.scene_files("x = (") == [] == snippets.scene_files(None)
