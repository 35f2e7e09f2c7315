"""Operators on source code against awkward sources, one by one."""

import ast

import pytest
from pyspark.sql import functions as F

from siltstone.operators import attempts, constants, repair, scopes, shared, syntax

ODD = [None, "", "Prose and nothing else. It isn't code.", "x = " + "(" * 400 + ")" * 400, "x\0y", "y = (ShowCreation(z)", "x = " + "-" * 20_000 + "1"]


def parses(s):
    try:
        ast.parse(s)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return False
    return True


def test_repair():
    sources = ["x = 1\n", "def f(a:\n    return g(a\n", "class A\n    def g(self:\n        self.add(f(1)\n", "if x\n    y = (1, [2)\n", "no python here at all", ""]
    assert [(parses(s), parses(syntax.repair(s))) for s in sources] == [(True, True), (False, False), (False, True), (False, False), (False, False), (True, True)]
    for s in [*sources, *ODD]:
        fixed = syntax.repair(s)
        assert fixed == (s or "") or (not parses(s) and parses(fixed))
    code = "a = 'x' # it's (\nb = r'\\d' \"\"\"t\n'q'\"\"\" f'{x!r}' + \"open\n"
    assert "".join(t.text for t in repair.tokens(code)) == code
    assert repair.edited("abcdef", [(4, 5, "X"), (1, 2, ""), (1, 3, "no")]) == "acdXf"


def uses(code, index=()):
    """(line, name, level) of one source among itself."""
    rows = scopes.scope_rows(code)
    return {(r[5], r[2]) for r in rows if r[0] == "reads"}


def test_scopes(spark):
    """Nested and class scopes, global, nonlocal, defaults, decorators, lambdas, comprehensions, handlers, shadowed builtins."""
    code = """from a import b as c
from star import *
import d.e
len = 3
class A(c):
    f = len
    g = [f for _ in range(3)]
    def h(self, k=f):
        return f, A, other, d
def outer(n):
    def inner():
        nonlocal n
        n = n + 1
        global made
        made = n
        return [n for n in c if n]
    return inner
try:
    pass
except E as err:
    print(err, made)
@deco
def last(*args, **kw) -> len:
    return (lambda x, *y: (x, y, kw, args, starred))
"""
    sources = spark.createDataFrame([("one", code), ("two", "def other(): pass\nclass E: pass\nc = E\n"), ("bad", "x = ("), ("none", None)], "key string, code string")
    index = spark.createDataFrame([("star", "starred"), ("star", "print"), ("elsewhere", "deco")], "module string, symbol string")
    got = {(r.line, r.name): r.level for r in scopes.resolve(scopes.with_scopes(sources, "key", "code").cache(), index).collect() if r.key == "one"}
    want = {
        (5, "c"): "import", (6, "len"): "constant", (7, "f"): "unresolved", (7, "range"): "builtin", (8, "f"): "local", (9, "f"): "unresolved", (9, "A"): "class", (9, "other"): "cross_file",
        (9, "d"): "import", (13, "n"): "local", (15, "n"): "local", (16, "n"): "local", (16, "c"): "import", (17, "inner"): "function", (20, "E"): "cross_file", (21, "print"): "star",
        (21, "err"): "constant", (21, "made"): "constant", (22, "deco"): "unresolved", (23, "len"): "constant", (24, "x"): "local", (24, "y"): "local", (24, "kw"): "local", (24, "args"): "local",
        (24, "starred"): "star",
    }
    assert got == want
    assert all(scopes.scope_rows(s) == [] for s in ODD[2:6])


def test_constants():
    code = "A = B * 2\nB = -3 ** 2\nC = 'x' * 3 + 'y'\nD = [A, (C, 1.5)]\nE = F_\nF_ = G\nG = E + A\nH = E\nI = f(A)\nJ = I\nK = 1\nK = 2\nL = K\nM = 10 ** 99\nN = 'x' * 99\nO: int = 1 // 0\nP = Q = 4\n"
    got = {c["name"]: c for c in constants.constants(code)}
    assert {n: (c["state"], c["value"], c["layer"]) for n, c in got.items()} == {
        "A": ("value", "-18", 1), "B": ("value", "-9", 0), "C": ("value", "'xxxy'", 0), "D": ("value", "[-18, ('xxxy', 1.5)]", 2), "E": ("cycle", None, None), "F_": ("cycle", None, None),
        "G": ("cycle", None, None), "H": ("cycle", None, None), "I": ("computed", None, 2), "J": ("computed", None, 3), "L": ("computed", None, 0), "M": ("computed", None, 0), "N": ("computed", None, 0), "O": ("computed", None, 0),
    }
    assert got["E"]["cycle"] == got["H"]["cycle"] == "E,F_,G" and got["A"]["cycle"] is None
    assert all(constants.constants(s) == [] for s in ODD[:6])


def test_shared_blocks(spark):
    """Equal code on equal constants moves, whatever it is called; code on what changes, or on other constants, stays."""
    one = "import math\nN = 2\nM = N + 1\nT = 0\n\n@deco\ndef f(a, b=M):\n    c = a + b\n    return math.sin(c)\n\ndef g(x):\n    return f(x, 1) + N\n\ndef h():\n    return T\n\ndef set_():\n    global T\n    T = 1\n"
    two = one.replace("def f(a", "def ff(u").replace("a + b", "u + b").replace("f(x, 1)", "ff(x, 1)").replace("def g(", "def gg(").replace("N = 2", "N = 2  # two")
    three = one.replace("N = 2", "N = 3")
    d = spark.createDataFrame([(1, one), (2, two), (3, three), (4, "x = ("), (5, None)], "id long, code string")
    modules, out = shared.share(d, "id", "code")
    got = {r.key: r for r in out.collect()}
    assert [got[k].moved for k in range(1, 6)] == [2, 2, 0, 0, 0] and got[5].after is None and got[4].after == "x = ("
    assert "from shared_1_f import f\n" in got[1].after and "from shared_1_f import f as ff\n" in got[2].after and "from shared_1_g import g as gg\n" in got[2].after
    assert "@deco" not in got[1].after and "def h" in got[1].after and all(parses(got[k].after) for k in (1, 2, 3))
    texts = {r.module: r.text for r in modules.collect()}
    assert set(texts) == {"shared_1_f", "shared_1_g"} and all(map(parses, texts.values()))
    assert texts["shared_1_g"].startswith("import math\nN = 2\nM = N + 1\n@deco\ndef f(") or "N = 2" in texts["shared_1_g"]
    made: dict = {}
    exec(texts["shared_1_g"].replace("@deco\n", ""), made)
    assert abs(made["g"](1) - (__import__("math").sin(2) + 2)) < 1e-12


def test_attempts(spark):
    """A check that passes at once, after one fix, after two, never, and a fix that changes nothing."""
    d = spark.createDataFrame([(1, "ok"), (2, "b"), (3, "ab"), (4, "aaaab"), (5, "x"), (6, None), (None, "b"), (None, "x")], "id long, code string")
    check = lambda df, code: df.withColumn("message", F.when(F.coalesce(F.col(code), F.lit("null")) != "ok", F.concat(F.lit("bad "), F.coalesce(F.col(code), F.lit("null")))))
    step = F.when(F.col("code") == "b", "ok").when(F.col("code").startswith("a"), F.substr("code", F.lit(2))).otherwise(F.coalesce("code", F.lit("")))
    fix = lambda df, code: df.withColumns({"fixed": step, "fixes": F.array(F.lit("step"))})
    states, history = attempts.run_attempts(d, "id", "code", 3, check, fix)
    assert {(r.key, r.state, r.attempts) for r in states.collect()} == {
        (1, "clean", 1), (2, "recovered", 2), (3, "recovered", 3), (4, "exhausted", 3), (5, "gave_up", 1), (6, "gave_up", 1), (None, "recovered", 2), (None, "gave_up", 1),
    }
    assert sorted((r.key or 0, r.attempt) for r in history.collect()) == [(0, 1), (0, 1), (0, 2), (1, 1), (2, 1), (2, 2), (3, 1), (3, 2), (3, 3), (4, 1), (4, 2), (4, 3), (5, 1), (6, 1)]
    states, history = attempts.run_attempts(d.limit(0), "id", "code")
    assert states.count() == history.count() == 0


@pytest.mark.parametrize("code", ODD)
def test_first_failure_takes_anything(code):
    assert attempts.first_failure(code) is None or isinstance(attempts.first_failure(code), str)
