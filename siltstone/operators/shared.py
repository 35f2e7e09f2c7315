"""Code that several sources share, moved into one module that they import.

Each top-level function and class gets a hash, built from its leaves upwards: of a node's kind and its children's hashes, where names of its
own (its name, parameters, variables of its functions) count by the order they first occur in, and free names that the source defines count
by the hash of their definition. So equal hashes mean equal code on equal constants, whatever things are called. Hashes that
several sources have are grouped by Spark; the block of the least source goes into a module, with the constants and imports it needs, and
every source of the group imports it under its own name.
"""

from __future__ import annotations

import ast
import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.constants import definitions
from siltstone.session import materialize

_BLOCKS = "array<struct<name: string, hash: string, first: int, last: int, text: string>>"
_DEFS = (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)


def _own_names(block: ast.AST) -> set[str]:
    """The block's name, and what its functions bind; what a class binds are attributes, known by name."""
    out = {block.name}
    for f in ast.walk(block):
        if isinstance(f, (ast.FunctionDef, ast.AsyncFunctionDef, ast.Lambda)):
            out |= {a.arg for a in ast.walk(f.args) if isinstance(a, ast.arg)}
            for n in ast.walk(f):
                if isinstance(n, ast.Name) and isinstance(n.ctx, ast.Store):
                    out.add(n.id)
                elif n is not f and isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef)):
                    out.add(n.name)
    return out


class _Hasher:
    """Hashes of the nodes of a block, leaves first."""

    def __init__(self, own: set[str], free: dict[str, str]):
        self.own, self.free, self.seen = own, free, {}

    def name(self, n: str) -> str:
        if n in self.own:
            return f"#{self.seen.setdefault(n, len(self.seen))}"
        return self.free.get(n, n)

    def __call__(self, node) -> str:
        if isinstance(node, ast.AST):
            parts = [type(node).__name__]
            for field, v in ast.iter_fields(node):
                named = field in ("id", "arg") or (field == "name" and isinstance(node, _DEFS))
                parts.append(self.name(v) if named and isinstance(v, str) else self(v))
        elif isinstance(node, list):
            parts = ["list", *map(self, node)]
        else:
            parts = [type(node).__name__, repr(node)]
        return hashlib.md5("\x1f".join(parts).encode()).hexdigest()


def blocks(code: str | None) -> list[dict]:
    """(name, hash, first, last, text) of the top-level functions and classes that can move: text is the module that holds the block.

    A block moves if all it reads at the top of its source are constants bound once, imports, and other blocks of that kind that come
    before it; what a source does not define at all (names of star imports) stays where the block's reader would look for it too.
    """
    try:
        tree = ast.parse(code or "")
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return []
    values = definitions(tree)
    imports = {(a.asname or a.name).split(".")[0]: ast.unparse(s) for s in tree.body if isinstance(s, ast.Import | ast.ImportFrom) for a in s.names if a.name != "*"}
    tops = {n.id for s in tree.body for n in ast.walk(s) if not isinstance(s, _DEFS) and isinstance(n, ast.Name) and isinstance(n.ctx, ast.Store)} | {s.name for s in tree.body if isinstance(s, _DEFS)}
    tops |= {g for n in ast.walk(tree) if isinstance(n, ast.Global) for g in n.names}
    known: dict[str, str] = {}
    lines: dict[str, list[str]] = {}  # what a name needs before it, itself last

    def reads(node: ast.AST, own: set[str]) -> list[str]:
        return list(dict.fromkeys(n.id for n in ast.walk(node) if isinstance(n, ast.Name) and n.id not in own))

    def needed(names: list[str]) -> list[str]:
        return list(dict.fromkeys(x for n in names if n in lines for x in lines[n]))

    for n, s in imports.items():
        known[n], lines[n] = hashlib.md5(s.encode()).hexdigest(), [s]
    out = []
    for s in tree.body:
        target = s.targets[0].id if isinstance(s, ast.Assign) and len(s.targets) == 1 and isinstance(s.targets[0], ast.Name) else None
        if target in values:
            free = reads(s.value, set())
            if all(n in known or n not in tops for n in free):
                known[target], lines[target] = _Hasher(set(), known)(s.value), [*needed(free), ast.unparse(s)]
        elif isinstance(s, _DEFS):
            own = _own_names(s)
            free = reads(s, own)
            if all(n in known or n not in tops for n in free) and not any(isinstance(n, ast.Global) for n in ast.walk(s)):
                known[s.name], lines[s.name] = _Hasher(own, known)(s), [*needed(free), ast.unparse(s)]
                first = min([s.lineno, *(d.lineno for d in s.decorator_list)])
                out.append({"name": s.name, "hash": known[s.name], "first": first, "last": s.end_lineno, "text": "\n".join(lines[s.name]) + "\n"})
    return out


def rewritten(code: str, moved: list[dict]) -> str:
    """The source with some blocks (first, last, name, module, known_as) replaced by imports."""
    lines: list[str | None] = list(code.split("\n"))
    for m in moved:
        lines[m["first"] - 1 : m["last"]] = [None] * (m["last"] - m["first"] + 1)
        lines[m["first"] - 1] = f"from {m['module']} import {m['known_as']}" + (f" as {m['name']}" if m["name"] != m["known_as"] else "")
    return "\n".join(s for s in lines if s is not None)


def share(sources: DataFrame, key: str, code: str) -> tuple[DataFrame, DataFrame]:
    """(modules, rewritten sources). Modules: module, users, text. Sources: key, before, after (code), moved (how many blocks)."""

    @F.pandas_udf(_BLOCKS)
    def find(codes: pd.Series) -> pd.Series:
        return pd.Series([blocks(c) for c in codes])

    d = sources.select(F.col(key).alias("key"), F.col(code).alias("before"))
    found = materialize(d.select("key", F.inline(find("before"))), "blocks")
    owner = F.struct("key", "first", "name")
    groups = found.groupBy("hash").agg(F.count_distinct("key").alias("users"), F.min(owner).alias("owner")).where("users > 1")
    groups = groups.select("hash", "users", F.col("owner.key").alias("of"), F.col("owner.name").alias("known_as"), F.concat_ws("_", F.lit("shared"), "owner.key", "owner.name").alias("module"))
    groups = materialize(groups, "groups")
    held = found.select(F.col("key").alias("of"), F.col("name").alias("known_as"), "hash", "text")
    modules = groups.join(held, ["hash", "of", "known_as"]).select("module", "users", "text").distinct()
    moved = found.join(groups, "hash").groupBy("key").agg(F.collect_list(F.struct("first", "last", "name", "module", "known_as")).alias("moved"))  # of one source

    @F.pandas_udf("string")
    def move(codes: pd.Series, all_: pd.Series) -> pd.Series:
        return pd.Series([c if m is None else rewritten(c, list(m)) for c, m in zip(codes, all_, strict=True)])

    out = d.join(moved, "key", "left").withColumn("after", move("before", "moved"))
    return modules, out.select("key", "before", "after", F.coalesce(F.size("moved"), F.lit(0)).alias("moved"))
