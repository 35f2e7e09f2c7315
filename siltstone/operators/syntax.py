"""Syntax-tree operators: facts of a source, dependencies, validation and conversion.

Each source is parsed once, in an Arrow-batched UDF that returns all facts as one struct; everything after that is
columns. Sources are only parsed, never run. A source that does not parse has valid = false and empty lists.
"""

from __future__ import annotations

import ast
import builtins
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.batches import each
from siltstone.operators.converter import convert, with_converted  # noqa: F401
from siltstone.operators.trees import nodes
from siltstone.rules import dialect as D

FACTS = """valid boolean, error string, functions array<string>, classes array<string>, constants array<string>, imports array<string>,
star_imports array<string>, scenes array<struct<name: string, start: int, end: int, parameters: int, config: boolean, complex_config: boolean, constructs: boolean, code: string>>,
uses array<struct<src: string, dst: string>>, undefined array<string>"""

_BUILTINS = frozenset(dir(builtins))


def _names(node: ast.AST) -> set[str]:
    return {n.id for n in nodes(node) if isinstance(n, ast.Name) and isinstance(n.ctx, ast.Load)}


def _bound(tree: ast.AST) -> set[str]:
    """Names that anything in the tree binds."""
    out: set[str] = set()
    for n in nodes(tree):
        if isinstance(n, ast.Name) and isinstance(n.ctx, ast.Store | ast.Del):
            out.add(n.id)
        elif isinstance(n, ast.FunctionDef | ast.AsyncFunctionDef | ast.ClassDef):
            out.add(n.name)
        elif isinstance(n, ast.arg):
            out.add(n.arg)
        elif isinstance(n, ast.alias):
            out.add((n.asname or n.name).split(".")[0])
        elif isinstance(n, ast.ExceptHandler) and n.name:
            out.add(n.name)
    return out


def _base(b: ast.expr) -> str:
    return b.id if isinstance(b, ast.Name) else b.attr if isinstance(b, ast.Attribute) else ""


def is_scene(node: ast.ClassDef) -> bool:
    """Renderable: a class one of whose bases has Scene in its name."""
    return any("Scene" in _base(b) for b in node.bases)


def is_scene_class(node: ast.ClassDef) -> bool:
    """The cleaner's predicate: a name that ends with Scene or is known as one, or a plain base with Scene in its name."""
    return node.name.endswith("Scene") or node.name in D.SCENE_NAMES or any(isinstance(b, ast.Name) and "Scene" in b.id for b in node.bases)


def inherits_from_scene(node: ast.ClassDef) -> bool:
    """A third predicate: a base whose name ends with Scene or is one of three."""
    return any(_base(b).endswith("Scene") or _base(b) in D.SCENE_BASES for b in node.bases)


_SCENE_LINE = re.compile(r"^class\s+(\w+)\s*\([^)]*Scene[^)]*\)\s*:", re.M)


def scene_predicates(code: str | None) -> list[dict]:
    """(name, scene_class, inherits, renderable) of all classes; where the source does not parse, of those its text shows."""
    try:
        tree = ast.parse(code or "")
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return [{"name": n, "scene_class": None, "inherits": None, "renderable": True} for n in _SCENE_LINE.findall(code or "")]
    return [{"name": n.name, "scene_class": is_scene_class(n), "inherits": inherits_from_scene(n), "renderable": is_scene(n)} for n in nodes(tree) if isinstance(n, ast.ClassDef)]


def with_scene_predicates(df: DataFrame, code: str, out: str = "predicates") -> DataFrame:
    """df with an array of scene_predicates."""

    kind = "array<struct<name: string, scene_class: boolean, inherits: boolean, renderable: boolean>>"
    return df.withColumn(out, each(scene_predicates, kind, once=True)(F.col(code)))


def file_imports(code: str | None) -> dict:
    """What a source imports, sorted: direct names, modules of star imports, and modules by the name they are bound to; all empty where it does not parse."""
    try:
        found = nodes(ast.parse(code or ""))
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        found = []
    froms = [(n.module or "", a) for n in found if isinstance(n, ast.ImportFrom) for a in n.names]
    return {
        "direct": sorted({a.asname or a.name for _, a in froms if a.name != "*"}),
        "star": sorted({m for m, a in froms if a.name == "*"}),
        "modules": sorted({a.asname or a.name for n in found if isinstance(n, ast.Import) for a in n.names}),
    }


def with_imports(df: DataFrame, code: str, out: str = "imported") -> DataFrame:
    """df with the struct of file_imports."""
    return df.withColumn(out, each(file_imports, "direct array<string>, star array<string>, modules array<string>", once=True)(F.col(code)))


def _complex(m: ast.stmt) -> bool:
    """CONFIG with a value that is computed: a lambda, a comprehension, an evaluation."""
    if not (isinstance(m, ast.Assign) and any(isinstance(t, ast.Name) and t.id == "CONFIG" for t in m.targets) and isinstance(m.value, ast.Dict)):
        return False
    return any(isinstance(v, ast.Lambda | ast.ListComp | ast.DictComp) or (isinstance(v, ast.Call) and isinstance(v.func, ast.Name) and v.func.id in ("eval", "exec")) for v in m.value.values)


def _empty() -> dict[str, list]:
    return {k: [] for k in ("functions", "classes", "constants", "imports", "star_imports", "scenes", "uses", "undefined")}


def facts(code: str | None) -> dict:
    """All facts of one source."""
    try:
        tree = ast.parse(code or "")
    except (SyntaxError, ValueError, RecursionError, MemoryError) as e:
        line = getattr(e, "lineno", None)
        return {"valid": False, "error": f"line {line}: {e.msg if isinstance(e, SyntaxError) else e}", **_empty()}
    return facts_of(tree, code or "")


def facts_of(tree: ast.Module, code: str) -> dict:
    """The facts of a source that has been parsed."""
    lines = code.split("\n")
    out: dict = {"valid": True, "error": None, **_empty()}
    bodies: dict[str, ast.AST] = {}
    for n in tree.body:
        if isinstance(n, ast.FunctionDef | ast.AsyncFunctionDef):
            out["functions"].append(n.name)
            bodies[n.name] = n
        elif isinstance(n, ast.ClassDef):
            out["classes"].append(n.name)
            bodies[n.name] = n
            if is_scene(n):
                made = next((m for m in n.body if isinstance(m, ast.FunctionDef) and m.name == "construct"), None)
                out["scenes"].append(
                    {
                        "name": n.name,
                        "start": n.lineno,
                        "end": n.end_lineno,
                        "parameters": len(made.args.args) - 1 if made else 0,
                        "config": any(isinstance(m, ast.Assign) and any(isinstance(t, ast.Name) and t.id == "CONFIG" for t in m.targets) for m in n.body),
                        "complex_config": any(_complex(m) for m in n.body),
                        "constructs": made is not None,
                        "code": "\n".join(lines[n.lineno - 1 : n.end_lineno]),
                    }
                )
        elif isinstance(n, ast.Assign):
            for t in n.targets:
                if isinstance(t, ast.Name) and t.id.isupper():
                    out["constants"].append(t.id)
                    bodies[t.id] = n.value
        elif isinstance(n, ast.Import):
            out["imports"] += [a.name for a in n.names]
        elif isinstance(n, ast.ImportFrom):
            for a in n.names:
                (out["star_imports"] if a.name == "*" else out["imports"]).append(n.module or "" if a.name == "*" else f"{n.module}.{a.name}")
    out["uses"] = [{"src": k, "dst": d} for k, body in bodies.items() for d in sorted(_names(body) & bodies.keys() - {k})]
    if not out["star_imports"]:
        out["undefined"] = sorted(_names(tree) - _bound(tree) - _BUILTINS)
    return out


def with_facts(df: DataFrame, code: str, out: str = "facts") -> DataFrame:
    """df with the struct of facts of a code column."""
    return df.withColumn(out, each(facts, FACTS, once=True)(F.col(code)))


def dependency_edges(df: DataFrame, key: str, out: str = "facts") -> DataFrame:
    """(src, dst) over names qualified by key, for graph.closure."""
    e = df.select(key, F.explode(f"{out}.uses").alias("u"))
    name = lambda c: F.concat_ws(":", F.col(key).cast("string"), F.col(c))
    return e.select(name("u.src").alias("src"), name("u.dst").alias("dst"))


def issues(out: str = "facts") -> Column:
    """array<struct<severity, type, detail>>: what a validator would say of a source, from its facts."""
    f = F.col(out)
    one = lambda severity, kind, detail: F.struct(F.lit(severity).alias("severity"), F.lit(kind).alias("type"), detail.cast("string").alias("detail"))
    syntax = F.when(~f["valid"], F.array(one("error", "syntax_error", f["error"]))).otherwise(F.array())
    missing = F.transform(F.filter(f["scenes"], lambda s: ~s["constructs"]), lambda s: one("error", "missing_construct", s["name"]))
    extra = F.transform(F.filter(f["scenes"], lambda s: s["parameters"] > 0), lambda s: one("error", "invalid_construct", s["name"]))
    config = F.transform(F.filter(f["scenes"], lambda s: s["config"]), lambda s: one("warning", "deprecated_config", s["name"]))
    unknown = F.transform(f["undefined"], lambda n: one("warning", "undefined_name", n))
    return F.concat(syntax.cast("array<struct<severity:string,type:string,detail:string>>"), missing, extra, config, unknown)


def parameterless(code: str | None, scene: str) -> str | None:
    """The source with the scene's construct arguments moved into __init__; None where there is nothing to move."""
    try:
        tree = ast.parse(code or "")
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return None
    for n in tree.body:
        if isinstance(n, ast.ClassDef) and n.name == scene:
            made = next((m for m in n.body if isinstance(m, ast.FunctionDef) and m.name == "construct" and len(m.args.args) > 1), None)
            if made is None:
                return None
            moved, names = made.args, [a.arg for a in made.args.args[1:]]
            init = ast.parse("def __init__(self, **kwargs):\n    super().__init__(**kwargs)").body[0]
            init.args = ast.arguments([], moved.args, None, [], [], ast.arg("kwargs"), moved.defaults)
            init.body += [ast.parse(f"self.{a} = {a}").body[0] for a in names]
            made.args = ast.arguments([], [moved.args[0]], None, [], [], None, [])

            class Own(ast.NodeTransformer):
                def visit_Name(self, x: ast.Name):
                    return ast.Attribute(ast.Name("self", ast.Load()), x.id, x.ctx) if x.id in names else x

            made.body = [Own().visit(s) for s in made.body]
            n.body.insert(n.body.index(made), init)
            return ast.unparse(ast.fix_missing_locations(tree))
    return None


def repair(code: str | None) -> str:
    """Damage undone where the source does not parse; a source that cannot be mended stays as it is."""
    from siltstone.operators.repair import rules

    code = code or ""
    if facts(code)["valid"]:
        return code
    mended = rules(code)
    return mended if facts(mended)["valid"] else code


def with_repaired(df: DataFrame, code: str, out: str = "repaired") -> DataFrame:
    """df with the repaired source."""
    return df.withColumn(out, each(repair, "string")(F.col(code)))
