"""Snippets: sources cut into their top-level blocks, and blocks put together again.

A block begins at a line without indentation; decorators and the lines indented under it belong to it. Cutting looks at the
text alone, so it works on sources that do not parse.
"""

from __future__ import annotations

import ast
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.batches import each
from siltstone.operators.syntax import facts_of

_NAMED = re.compile(r"(?:class|def)\s+(\w+)")
_CONSTANT = re.compile(r"([A-Z_]+)\s*=|(\w+)\s*=\s*[\[\{\(]")


def blocks(code: str | None) -> list[dict]:
    """(kind, name, text) of the top-level blocks: import, constant, function, class, scene, other."""
    out: list[list[str]] = []
    for line in (code or "").split("\n"):
        if line[:1].strip() and not (out and out[-1][-1].startswith("@")) and not line.startswith((")", "]", "}")):
            out.append([line])
        elif out:
            out[-1].append(line)
    found = []
    for lines in out:
        text = "\n".join(lines).rstrip()
        head = next((s for s in lines if not s.startswith("@")), "")
        name = _NAMED.match(head)
        if head.startswith(("import ", "from ")):
            found.append({"kind": "import", "name": text, "text": text})
        elif head.startswith("class ") and name:
            found.append({"kind": "scene" if "Scene" in head else "class", "name": name[1], "text": text})
        elif head.startswith("def ") and name:
            found.append({"kind": "function", "name": name[1], "text": text})
        elif m := _CONSTANT.match(head):
            found.append({"kind": "constant", "name": m[1] or m[2], "text": text})
        elif not head.startswith("#"):
            found.append({"kind": "other", "name": "", "text": text})
    return found


def with_blocks(df: DataFrame, code: str, out: str = "blocks") -> DataFrame:
    """df with the array of blocks."""
    return df.withColumn(out, each(blocks, "array<struct<kind: string, name: string, text: string>>", once=True)(F.col(code)))


def combine(df: DataFrame, group: str, order: str, code: str) -> DataFrame:
    """(group, text, scenes): all snippets of a group as one source.

    Imports once, plain ones before others, after the main import; of constants, functions and classes of one name the first
    in order; scenes by name. Blocks are told apart before the shuffle, so a group's row holds distinct blocks only.
    """
    b = with_blocks(df.select(group, order, code), code).select(group, order, F.posexplode("blocks").alias("at", "b")).select(group, order, "at", "b.*")
    b = b.where("kind <> 'other' AND NOT (kind = 'import' AND contains(text, 'manim'))")
    first = b.groupBy(group, "kind", "name").agg(F.min(F.struct(order, "at", "text")).alias("f"))
    rank = F.when(F.col("kind") == "import", 0).when(F.col("kind") == "constant", 1).when(F.col("kind") == "function", 2).when(F.col("kind") == "class", 3).otherwise(4)
    plain = F.startswith("name", F.lit("import ")) & ~F.contains(F.split_part("name", F.lit(" "), F.lit(2)), F.lit("."))
    sub = F.when(F.col("kind") == "import", F.when(plain, 0).otherwise(1)).otherwise(0)
    by_name = F.when(F.col("kind").isin("import", "scene"), F.col("name")).otherwise("")
    sorted_ = F.array_sort(F.collect_list(F.struct(rank.alias("r"), sub.alias("s"), by_name.alias("n"), F.col(f"f.{order}").alias("o"), F.col("f.at").alias("a"), F.col("f.text").alias("t"))))
    parts = F.concat(F.array(F.lit("from manim import *")), F.transform(sorted_, lambda x: x["t"]))
    return first.groupBy(group).agg(F.array_join(parts, "\n\n").alias("text"), F.count_if(F.col("kind") == "scene").alias("scenes"))


def _parsed(code: str) -> tuple[ast.Module, dict] | None:
    """The tree of a source and its facts."""
    try:
        tree = ast.parse(code)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return None
    return tree, facts_of(tree, code)


def _file(tree: ast.Module, facts: dict, lines: list[str], scene: str) -> str:
    needs, todo = {scene}, [scene]
    uses: dict[str, list[str]] = {}
    for u in facts["uses"]:
        uses.setdefault(u["src"], []).append(u["dst"])
    while todo:
        for d in uses.get(todo.pop(), []):
            if d not in needs:
                needs.add(d)
                todo.append(d)
    keep = []
    order = {"import": 0, "constant": 1, "function": 2, "class": 3}
    for n in tree.body:
        text = "\n".join(lines[n.lineno - 1 : n.end_lineno])
        if isinstance(n, ast.Import | ast.ImportFrom):
            keep.append((order["import"], text))
        elif isinstance(n, ast.Assign) and any(isinstance(t, ast.Name) and t.id in needs for t in n.targets):
            keep.append((order["constant"], text))
        elif isinstance(n, ast.FunctionDef | ast.AsyncFunctionDef | ast.ClassDef) and n.name in needs:
            keep.append((4 if n.name == scene else order["class" if isinstance(n, ast.ClassDef) else "function"], text))
    return "\n\n".join(t for _, t in sorted(keep, key=lambda x: x[0]))


def self_contained(code: str | None, scene: str) -> str | None:
    """A scene with the imports of its source and the definitions that it needs, directly or not, in the order of the source; None where it is not found."""
    found = _parsed(code or "")
    if found is None or scene not in found[1]["classes"]:
        return None
    return _file(*found, (code or "").split("\n"), scene)


def scene_files(code: str | None) -> list[dict]:
    """(scene, file) of each scene of a source, as self_contained has them, from one tree."""
    found = _parsed(code or "")
    if found is None:
        return []
    lines = (code or "").split("\n")
    return [{"scene": s["name"], "file": _file(*found, lines, s["name"])} for s in found[1]["scenes"]]


def with_self_contained(df: DataFrame, code: str, scene: str, out: str = "file") -> DataFrame:
    """df with the self-contained source of a scene."""
    return df.withColumn(out, each(self_contained, "string")(F.col(code), F.col(scene)))


def with_scene_files(df: DataFrame, code: str, out: str = "files") -> DataFrame:
    """df with the array of scene_files."""
    return df.withColumn(out, each(scene_files, "array<struct<scene: string, file: string>>", once=True)(F.col(code)))
