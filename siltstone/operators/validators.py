"""Validators of sources: before conversion, of a scene, before rendering; and what can be put right without help.

Each validator is a function from a source to a list of issues (severity, type, line, message); one Arrow-batched UDF
runs any of them. A source that does not parse has one issue, a syntax error.
"""

from __future__ import annotations

import ast
import builtins
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.batches import each
from siltstone.operators.trees import nodes
from siltstone.rules import dialect as D

ISSUES = "array<struct<severity: string, type: string, line: int, message: string>>"


def issue(severity: str, kind: str, line: int | None, message: str) -> dict:
    return {"severity": severity, "type": kind, "line": line or 0, "message": message}


def parsed(code: str) -> ast.Module | dict:
    """The tree, or the issue that there is none."""
    try:
        return ast.parse(code)
    except (SyntaxError, ValueError, RecursionError, MemoryError) as e:
        return issue("error", "syntax_error", getattr(e, "lineno", 0), f"Syntax error: {getattr(e, 'msg', e)}")


def _called(node: ast.AST) -> str:
    return node.func.id if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) else ""


def before_conversion(code: str) -> list[dict]:
    """What a conversion will meet: removed imports, classes, methods and parameters, changed bases and properties, complex calls."""
    tree = parsed(code)
    if isinstance(tree, dict):
        return [tree]
    out = []
    found = nodes(tree)
    say = lambda severity, kind, node, message: out.append(issue(severity, kind, node.lineno, message))
    calls_of = {id(c): n for n in found if isinstance(n, ast.Call) for c in ast.iter_child_nodes(n)}
    for n in found:
        if isinstance(n, ast.ImportFrom) and n.module == "manimlib.imports":
            for a in n.names:
                if a.name in D.REMOVED_CLASSES:
                    say("error", "removed_import", n, f"Importing removed class: {a.name}")
        elif isinstance(n, ast.ClassDef):
            for b in n.bases:
                name = b.id if isinstance(b, ast.Name) else ""
                if name in D.REMOVED_CLASSES:
                    say("error", "removed_base_class", n, f"Inheriting from removed class: {name}")
                elif name in ("GraphScene", "ThreeDScene", "MovingCameraScene"):
                    say("warning", "changed_base_class", n, f"{name} has significant API changes")
        elif isinstance(n, ast.Call):
            name = _called(n)
            method = n.func.attr if isinstance(n.func, ast.Attribute) else ""
            if name in D.REMOVED_CLASSES:
                say("error", "removed_class", n, f"Using removed class: {name}")
            if method in D.NOW_PROPERTIES:
                say("warning", "method_to_property", n, f"{method}() is now a property")
            if method == "set_submobjects":
                say("warning", "api_behavior_change", n, "set_submobjects behavior may differ")
            if method == "play" and len(n.args) > 3:
                say("info", "complex_play_call", n, "Complex play() call with many animations")
            if name in D.MAPPED_CLASSES and (len(n.args) > 2 or len(n.keywords) > 3):
                say("info", "complex_animation", n, f"Complex {name} with many parameters")
            if name in ("Tex", "TexMobject", "MathTex", "Text") and any(k.arg == "size" for k in n.keywords):
                say("error", "removed_parameter", n, f"{name} no longer accepts 'size' parameter")
            if method == "add_updater":
                say("warning", "updater_api_change", n, "Updater API has changed significantly")
        elif isinstance(n, ast.Attribute):
            if n.attr in D.REMOVED_API_METHODS:
                say("error", "removed_method", n, f"Using removed method: {n.attr}")
            if n.attr in ("width", "height", "depth", "center") and id(n) in calls_of:
                say("warning", "property_as_method", n, f"Accessing property {n.attr} as method")
            if n.attr in ("x_axis", "y_axis", "coords_to_point", "point_to_coords"):
                say("info", "coordinate_api", n, "Coordinate system APIs may behave differently")
    return out


def scene(code: str) -> list[dict]:
    """A cleaned scene: imports and where they are, a scene class with construct, names, leftovers, long lines."""
    tree = parsed(code)
    if isinstance(tree, dict):
        return [tree]
    out, lines = [], code.split("\n")
    found = nodes(tree)
    modules = [n.module or "" for n in found if isinstance(n, ast.ImportFrom)] + [a.name for n in found if isinstance(n, ast.Import) for a in n.names]
    if not any("manimlib" in m or "manim_imports_ext" in m for m in modules):
        out.append(issue("error", "missing_import", 0, "No manimlib or manim_imports_ext import found"))
    late = [k for k, s in enumerate(lines) if k > 20 and s.strip().startswith(("import ", "from "))]
    if late:
        out.append(issue("warning", "import_location", late[0] + 1, f"Imports found after line 20 at lines: {late}"))
    scenes = [n for n in found if isinstance(n, ast.ClassDef) and any(isinstance(b, ast.Name) and "Scene" in b.id for b in n.bases)]
    if not scenes:
        out.append(issue("error", "no_scene_class", 0, "No Scene class found in file"))
    for s in scenes:
        if not any(isinstance(m, ast.FunctionDef) and m.name == "construct" for m in s.body):
            out.append(issue("error", "missing_construct", s.lineno, f"Scene class '{s.name}' has no construct method"))
    unknown = undefined(found)
    if unknown:
        out.append(issue("warning", "undefined_names", 0, f"Potentially undefined names: {', '.join(unknown)}"))
    for k, s in enumerate(lines):
        if "open(" in s and ".py" in s:
            out.append(issue("warning", "file_operation", k + 1, f"File operation found at line {k + 1}"))
        if len(s) > 120:
            out.append(issue("info", "long_line", k + 1, f"Line {k + 1} is {len(s)} characters long"))
    out += [issue("info", "print_statement", n.lineno, f"Print statement found at line {n.lineno}") for n in found if _called(n) == "print"]
    return out


_KNOWN = frozenset(dir(builtins)) | frozenset(D.COMMON_GLOBALS) | {"self"}
_STAR = frozenset(D.STAR_NAMES)
_SHADE = re.compile(r"(?:BLUE|RED|GREEN|YELLOW)_[A-E]")


def undefined(found: list[ast.AST]) -> list[str]:
    """Names that the nodes of a tree read and neither bind, nor are they built in, common, or taken to come with a star import; sorted."""
    bound = set()
    for n in found:
        if isinstance(n, ast.Import | ast.ImportFrom):
            bound |= _STAR if any(a.name == "*" for a in n.names) else {(a.asname or a.name).split(".")[0] for a in n.names}
        elif isinstance(n, ast.FunctionDef | ast.AsyncFunctionDef | ast.ClassDef):
            bound.add(n.name)
        elif isinstance(n, ast.arg):
            bound.add(n.arg)
        elif isinstance(n, ast.Name) and not isinstance(n.ctx, ast.Load):
            bound.add(n.id)
        elif isinstance(n, ast.ExceptHandler) and n.name:
            bound.add(n.name)
    read = {n.id for n in found if isinstance(n, ast.Name) and isinstance(n.ctx, ast.Load)}
    return sorted(n for n in read - bound - _KNOWN - _STAR if not _SHADE.fullmatch(n))


_TEX = re.compile(r"(?:Tex|MathTex|Text)\s*\(\s*[\"']([^\"']*\\[^\"']*)[\"']\s*\)")


def before_render(code: str) -> list[dict]:
    """Converted code: imports, deprecated names, structure of scenes, patterns that fail when rendered."""
    tree = parsed(code)
    if isinstance(tree, dict):
        return [tree]
    out, lines = [], code.split("\n")
    found = nodes(tree)
    modules = {n.module: n.lineno for n in found if isinstance(n, ast.ImportFrom) and n.module}
    modules |= {a.name: n.lineno for n in found if isinstance(n, ast.Import) for a in n.names}
    for m, line in modules.items():
        if "manimlib" in m:
            out.append(issue("error", "invalid_import", line, f"Found manimlib import: {m}"))
        for p in D.PROBLEM_IMPORTS:
            if p in m:
                out.append(issue("warning", "problematic_import", line, f"Problematic import: {m}"))
    if not any("manim" in m for m in modules):
        out.append(issue("error", "missing_import", 1, "No manim imports found"))
    for n in found:
        if isinstance(n, ast.ClassDef):
            for b in n.bases:
                if isinstance(b, ast.Name) and b.id in D.DEPRECATED:
                    out.append(issue("error", "deprecated_class", n.lineno, f"Deprecated base class: {b.id}"))
            if any(isinstance(b, ast.Name) and "Scene" in b.id for b in n.bases):
                out += _structure(n)
        elif isinstance(n, ast.Call):
            name = _called(n)
            if name in D.DEPRECATED:
                out.append(issue("error", "deprecated_api", n.lineno, f"Deprecated class: {name}"))
            if name == "ShowCreation":
                out.append(issue("error", "deprecated_animation", n.lineno, "ShowCreation is deprecated"))
            if isinstance(n.func, ast.Attribute) and n.func.attr in ("get_width", "get_height") and not n.args:
                out.append(issue("warning", "deprecated_method", n.lineno, f"Method {n.func.attr}() should be property access"))
    for m in _TEX.finditer(code):
        out.append(issue("warning", "tex_string_issue", code[: m.start()].count("\n") + 1, "TeX string with backslashes should use raw string"))
    for k, s in enumerate(lines, 1):
        if "ContinualAnimation" in s:
            out.append(issue("error", "continual_animation", k, "ContinualAnimation not supported"))
        if not s.strip().startswith("#"):
            out += [issue("error", "pi_creature_usage", k, f"Pi Creature '{p}' not available") for p in ("PiCreature", "Randolph", "Mortimer", "get_students") if p in s]
        if ".glsl" in s:
            out.append(issue("error", "shader_reference", k, "GLSL shader references not supported"))
    return out


def _structure(n: ast.ClassDef) -> list[dict]:
    out = []
    made = next((m for m in n.body if isinstance(m, ast.FunctionDef) and m.name == "construct"), None)
    if made is None:
        out.append(issue("error", "missing_construct", n.lineno, f"Scene class {n.name} missing construct method"))
    elif [a.arg for a in made.args.args] != ["self"]:
        out.append(issue("error", "invalid_construct", made.lineno, "construct method should only have 'self' parameter"))
    for m in n.body:
        if isinstance(m, ast.Assign) and any(isinstance(t, ast.Name) and t.id == "CONFIG" for t in m.targets):
            out.append(issue("warning", "deprecated_config", m.lineno, "CONFIG dict is deprecated"))
    return out


VALIDATORS: dict[str, Callable[[str], list[dict]]] = {"before_conversion": before_conversion, "scene": scene, "before_render": before_render}


def with_issues(df: DataFrame, code: str, validator: str, out: str = "issues", once: bool = False) -> DataFrame:
    """df with the array of a validator's issues; once: for results that are exploded or filtered by (see each)."""
    check = VALIDATORS[validator]
    return df.withColumn(out, each(lambda c: check(c or ""), ISSUES, once)(F.col(code)))


def confidence(issues: Column) -> Column:
    """How sure a conversion is, from the numbers of errors and warnings."""
    n = lambda severity: F.size(F.filter(issues, lambda i: i["severity"] == severity))
    errors, warnings = n("error"), n("warning")
    score = F.when(errors > 5, 0.1).when(errors > 0, F.lit(0.3) - F.lit(0.05) * errors).when(warnings > 10, 0.6).when(warnings > 0, F.lit(0.8) - F.lit(0.02) * warnings)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score.otherwise(0.95)))


def auto_fix(code: str) -> tuple[str, list[str]]:
    """What the issues before rendering allow to put right: imports, names, bases, construct, colours, doubled brackets, stubs."""
    from siltstone.operators.fixer import _after_imports, animation_stubs

    kinds = {i["type"] for i in before_render(code)}
    done = []

    def swap(pattern: str, new: str, fix: str) -> None:
        nonlocal code
        code, n = re.subn(pattern, new, code)
        if n:
            done.append(fix)

    if "missing_import" in kinds and "from manim import *" not in code:
        lines = code.split("\n")
        lines.insert(_after_imports("\n".join(lines)), "from manim import *")
        code = "\n".join(lines)
        done.append("Added missing 'from manim import *'")
    swap(r"from manim_imports_ext import", "from manim import", "Converted manim_imports_ext to manim import")
    if "deprecated_api" in kinds:
        for old, new in (("ShowCreation", "Create"), ("TextMobject", "Text"), ("TexMobject", "MathTex")):
            swap(rf"\b{old}\b", new, f"Replaced {old} with {new}")
    if "invalid_import" in kinds:
        swap(r"(?m)^(\s*)from manimlib[\w.]* import .*$", r"\1from manim import *", "Fixed manimlib imports to manim")
        swap(r"\bimport manimlib\b", "import manim", "Fixed manimlib imports to manim")
    for s in D.VIDEO_SCENES:
        if f"class {s}" not in code:
            swap(rf"class\s+(\w+)\s*\({s}\):", r"class \1(Scene):", f"Changed inheritance from {s} to Scene")
    if "missing_construct" in kinds:
        for i in before_render(code):
            if i["type"] == "missing_construct":
                name = i["message"].split()[2]
                swap(rf"(class {name}\([^)]*\):[^\n]*\n)", "\\1    def construct(self):\n        pass\n\n", f"Added missing construct method to {name}")
    for old, new in (("LIGHT_GRAY", "LIGHT_GREY"), ("DARK_GRAY", "DARK_GREY"), ("GRAY", "GREY")):
        swap(rf"\b{old}\b", new, f"Fixed color name: {old} -> {new}")
    if "syntax_error" in kinds:
        swap(r'((?:Old|Math)?Tex\("[^"]*"\))\)(?=\s*$)', r"\1", "Fixed extra closing parenthesis in Tex string literal")
        swap(r"return\s+def\s+", 'return ""\n\n    def ', "Fixed invalid 'return def' syntax")
    code, stubs = animation_stubs(code)
    return code, done + stubs


def with_auto_fix(df: DataFrame, code: str, out: str = "auto") -> DataFrame:
    """df with struct<code, fixes>."""
    return df.withColumn(out, each(lambda c: auto_fix(c or ""), "code string, fixes array<string>")(F.col(code)))


def statistics(code: Column) -> dict[str, Column]:
    """Eight counts of a text, as built-in expressions."""
    lines = F.split(code, "\n")
    n = lambda pattern: F.regexp_count(code, F.lit(pattern)).cast("long")
    return {
        "total_lines": F.size(lines).cast("long"),
        "non_empty_lines": F.size(F.filter(lines, lambda s: F.trim(s) != "")).cast("long"),
        "comment_lines": F.size(F.filter(lines, lambda s: F.startswith(F.trim(s), F.lit("#")))).cast("long"),
        "class_count": n(r"(?m)^class\s+\w+"),
        "function_count": n(r"(?m)^def\s+\w+"),
        "scene_count": n(r"class\s+\w+\([^)]*Scene[^)]*\)"),
        "animation_count": n(r"self\.play\("),
        "mobject_count": n(r"\b(?:" + "|".join(D.MOBJECTS) + r")\s*\("),
    }
