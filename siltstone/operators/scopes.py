"""Name resolution over many sources: scopes as tables, lookups as joins.

One pass over each tree gives rows: the scopes that a scope sees and how far they are, what each scope binds, and the names each
reads. A name is then found by joins: the nearest scope seen that binds it, else other sources, imports, star imports through an index of
modules, builtins. Class scopes are seen by themselves alone; what a function declares global is read and bound in the module; nonlocal
names are left to the scopes around.
"""

from __future__ import annotations

import ast
import builtins
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.batches import each

LEVELS = ["function", "class", "constant", "local", "cross_file", "import", "star", "builtin", "unresolved"]
_ROWS = "what string, scope int, name string, kind string, far int, line int"
_FUNCTIONS = (ast.FunctionDef, ast.AsyncFunctionDef, ast.Lambda)
_COMPREHENSIONS = (ast.ListComp, ast.SetComp, ast.DictComp, ast.GeneratorExp)


class _Scope:
    def __init__(self, number: int, kind: str, parent: _Scope | None):
        self.number, self.kind, self.parent = number, kind, parent
        self.globals: set[str] = set()
        self.nonlocals: set[str] = set()

    def seen(self) -> Iterator[tuple[int, int]]:
        """(scope, how far) of itself and the scopes around it that it sees."""
        at, far = self, 0
        while at is not None:
            if at is self or at.kind != "class":
                yield at.number, far
            at, far = at.parent, far + 1


class _Walker(ast.NodeVisitor):
    """Fills rows (what, scope, name, kind, far, line): see _ROWS."""

    def __init__(self, tree: ast.Module):
        self.rows: list[tuple] = []
        self.count = 0
        self.at = self.module = self._scope("module", None)
        self._body(tree.body)

    def _scope(self, kind: str, parent: _Scope | None) -> _Scope:
        scope = _Scope(self.count, kind, parent)
        self.count += 1
        self.rows += [("sees", scope.number, None, str(n), far, None) for n, far in scope.seen()]
        return scope

    def _body(self, body: list[ast.AST]) -> None:
        """Declarations hold for a whole function, wherever they stand in it."""
        todo = list(body)
        while todo:
            n = todo.pop()
            if isinstance(n, ast.Global):
                self.at.globals |= set(n.names)
            elif isinstance(n, ast.Nonlocal):
                self.at.nonlocals |= set(n.names)
            elif not isinstance(n, (*_FUNCTIONS, ast.ClassDef)):
                todo += ast.iter_child_nodes(n)
        for n in body:
            self.visit(n)

    def _bind(self, name: str, kind: str) -> None:
        if name in self.at.nonlocals:
            return
        scope = self.module if name in self.at.globals else self.at
        if kind == "variable":
            kind = "constant" if scope is self.module else "local"
        self.rows.append(("binds", scope.number, name, kind, None, None))

    def _inside(self, kind: str, parts: list[ast.AST], bound: list[str] = ()) -> None:
        around, self.at = self.at, self._scope(kind, self.at)
        for name in bound:
            self._bind(name, "local")
        self._body(parts)
        self.at = around

    def visit_Name(self, n: ast.Name) -> None:
        if isinstance(n.ctx, ast.Load):
            scope = self.module if n.id in self.at.globals else self.at
            self.rows.append(("reads", scope.number, n.id, None, None, n.lineno))
        else:
            self._bind(n.id, "variable")

    def _function(self, n: ast.AST, body: list[ast.AST]) -> None:
        a = n.args
        every = [*a.posonlyargs, *a.args, *a.kwonlyargs, *filter(None, (a.vararg, a.kwarg))]
        # Defaults, annotations and decorators are read where the function is made.
        for x in [*getattr(n, "decorator_list", []), *a.defaults, *filter(None, a.kw_defaults), *filter(None, (p.annotation for p in every)), *filter(None, [getattr(n, "returns", None)])]:
            self.visit(x)
        self._inside("function", body, [p.arg for p in every])

    def visit_FunctionDef(self, n: ast.FunctionDef) -> None:
        self._bind(n.name, "function")
        self._function(n, n.body)

    visit_AsyncFunctionDef = visit_FunctionDef

    def visit_Lambda(self, n: ast.Lambda) -> None:
        self._function(n, [n.body])

    def visit_ClassDef(self, n: ast.ClassDef) -> None:
        self._bind(n.name, "class")
        for x in (*n.decorator_list, *n.bases, *(k.value for k in n.keywords)):
            self.visit(x)
        self._inside("class", n.body)

    def _comprehension(self, n: ast.AST) -> None:
        first, *rest = n.generators
        self.visit(first.iter)  # read in the scope around
        parts = [first.target, *first.ifs, *(x for g in rest for x in (g.iter, g.target, *g.ifs))]
        self._inside("comprehension", [*parts, *([n.key, n.value] if isinstance(n, ast.DictComp) else [n.elt])])

    visit_ListComp = visit_SetComp = visit_DictComp = visit_GeneratorExp = _comprehension

    def visit_Import(self, n: ast.Import) -> None:
        for a in n.names:
            self._bind((a.asname or a.name).split(".")[0], "import")

    def visit_ImportFrom(self, n: ast.ImportFrom) -> None:
        for a in n.names:
            if a.name == "*":
                self.rows.append(("star", 0, n.module or "", None, None, n.lineno))
            else:
                self._bind(a.asname or a.name, "import")

    def visit_ExceptHandler(self, n: ast.ExceptHandler) -> None:
        if n.name:
            self._bind(n.name, "variable")
        self.generic_visit(n)


def scope_rows(code: str | None) -> list[tuple]:
    """All rows of a source; none where it does not parse."""
    try:
        return list(dict.fromkeys(_Walker(ast.parse(code or "")).rows))
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return []


def with_scopes(sources: DataFrame, key: str, code: str) -> DataFrame:
    """(key, what, scope, name, kind, far, line): the scope tables of all sources."""
    rows = each(scope_rows, f"array<struct<{', '.join(f'{c.split()[0]}: {c.split()[1]}' for c in _ROWS.split(', '))}>>", once=True)
    return sources.select(F.col(key).alias("key"), F.inline(rows(F.col(code))))


def resolve(scopes: DataFrame, index: DataFrame) -> DataFrame:
    """(key, line, name, level) of all names read. scopes: see with_scopes, written; index: (module, symbol) of modules that are known.

    The nearest scope that binds a name decides. What only an import binds, or nothing, may be defined at the top of another source.
    """
    reads = scopes.where("what = 'reads'").select("key", "scope", "name", "line").distinct()
    sees = scopes.where("what = 'sees'").select("key", "scope", F.col("kind").cast("int").alias("around"), "far")
    binds = scopes.where("what = 'binds'").select("key", F.col("scope").alias("around"), "name", "kind").distinct()
    order = F.element_at(F.create_map(*[x for k, level in enumerate(LEVELS) for x in (F.lit(level), F.lit(k))]), F.col("kind"))
    near = reads.select("key", "scope", "name").distinct().join(sees, ["key", "scope"]).join(binds, ["key", "around", "name"])
    near = near.groupBy("key", "scope", "name").agg(F.min(F.struct("far", order.alias("order"), "kind"))["kind"].alias("own"))
    defined = scopes.where("what = 'binds' AND scope = 0 AND kind IN ('function', 'class')").groupBy("name").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    stars = scopes.where("what = 'star'").select("key", F.col("name").alias("module")).join(index, "module").select("key", F.col("symbol").alias("name")).distinct().withColumn("starred", F.lit(True))
    out = reads.join(near, ["key", "scope", "name"], "left").join(defined, "name", "left").join(stars, ["key", "name"], "left")
    elsewhere = (F.col("first") != F.col("key")) | (F.col("last") != F.col("key"))
    level = (
        F.when(F.col("own").isin(LEVELS[:4]), F.col("own"))
        .when(elsewhere, "cross_file")
        .when(F.col("own") == "import", "import")
        .when(F.col("starred"), "star")
        .when(F.col("name").isin(sorted(dir(builtins))), "builtin")
        .otherwise("unresolved")
    )
    return out.select("key", "line", "name", level.alias("level")).distinct()
