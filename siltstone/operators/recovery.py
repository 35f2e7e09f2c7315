"""Recovery: an error message picks patterns, and each pattern picked changes the code that failed.

Patterns are tried from the most to the least successful, all that match, each on what the ones before left. Recovery has
succeeded where anything changed.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.batches import each
from siltstone.operators.fixer import _after_imports
from siltstone.rules import dialect as D

Fix = Callable[[str], str]


@dataclass(frozen=True)
class Pattern:
    """A named pattern over messages, the fix it asks for, and how often that has worked."""

    name: str
    error: str
    fix: Fix
    rate: float


def _subs(*rules: tuple[str, str]) -> Fix:
    """Rules over the text, one after another."""

    def fix(code: str) -> str:
        for pattern, new in rules:
            code = re.sub(pattern, new, code)
        return code

    return fix


def _insert(line: str, used: str = "", unless: str = "") -> Fix:
    """A line after the imports, if the code uses something and lacks it."""

    def fix(code: str) -> str:
        if (used and not re.search(used, code)) or re.search(unless or re.escape(line), code):
            return code
        lines = code.split("\n")
        lines.insert(_after_imports("\n".join(lines)), line)
        return "\n".join(lines)

    return fix


def _helpers(names: list[str], used: str, module: str) -> Fix:
    """An import of those of the names that are used (by a pattern with {}), after the main import."""

    def fix(code: str) -> str:
        need = [n for n in names if re.search(used.format(n), code) and not re.search(rf"(?m)^(?:class|def)\s+{n}\b|^{n}\s*=", code)]
        lines = code.split("\n")
        have = next((k for k, s in enumerate(lines) if s.startswith(f"from {module} import")), None)
        if have is not None:
            known = {w.strip() for w in lines[have].split("import", 1)[1].split(",")}
            need = [] if "*" in known else [n for n in need if n not in known]
            lines[have] += "".join(f", {n}" for n in need)
        elif need:
            lines.insert(max((k + 1 for k, s in enumerate(lines) if "from manim import" in s), default=0), f"from {module} import {', '.join(need)}")
        return "\n".join(lines)

    return fix


def _lines(change: Callable[[str], list[str]]) -> Fix:
    return lambda code: "\n".join(x for s in code.split("\n") for x in change(s))


def _gone_import(line: str) -> list[str]:
    gone = not line.strip().startswith("#") and re.search(r"(?:import|from) (?:displayer|cv2|scipy\.ndimage|pygame|pydub|constants|utils)\b", line)
    return [f"# {line}  # Commented out - ManimGL specific"] if gone else [line]


def _old_import(line: str) -> list[str]:
    old = not line.strip().startswith("#") and re.search(r"\bfrom manimlib.* import\b|\bimport manimlib\b", line)
    return ["from manim import *  # Converted from manimlib import", f"# Original: {line.strip()}"] if old else [line]


def _config_line(line: str) -> list[str]:
    if "CONFIG = {" in line:
        return ["    # CONFIG converted to __init__ attributes", f"    # Original: {line.strip()}"]
    return [re.sub(r"\.CONFIG\[['\"](.*?)['\"]\]", r".\1", line)]


def _initials(code: str) -> str:
    if "def initials(" in code:
        return code
    code = _insert("import string", unless="import string")(code)
    lines = code.split("\n")
    at = next((k for k, s in enumerate(lines) if s.strip().startswith(("class ", "def "))), len(lines))
    lines[at:at] = ["", "def initials(chars):", '    """Capitals of a list of characters."""', "    return ''.join([c for c in chars if c.isupper()])", ""]
    return "\n".join(lines)


def _you(code: str) -> str:
    if re.search(r"\byou\s*=", code):
        return code
    return re.sub(r"(?m)^(\s*)(.*\bself\.add\s*\(\s*you\s*\))", r"\1you = draw_you()\n\1\2", code, count=1)


_NOT_CALLED = ["get_center", "get_width", "get_height", "get_left", "get_right", "get_top", "get_bottom", "get_corner", "copy", "strip", "lower", "upper"]
_SHADES = [(rf"\b{k}\b", v) for k, v in D.TREE_COLORS.items() if k[-2] == "_"]
_HELPERS = "manimce_constants_helpers"
_BOOL = r"invert\s*=\s*(?:True|False)"

# Patterns of messages, and how often their fixes have worked.
PATTERNS = [
    Pattern("Missing Manim Import", r"ModuleNotFoundError.*manim|ImportError.*manim|name 'Scene' is not defined|name '.*' is not defined", _insert("from manim import *", unless=r"from manim import|import manim"), 0.95),
    Pattern("manim_imports_ext to manim", r"ModuleNotFoundError.*manim_imports_ext|ImportError.*manim_imports_ext", _subs((r"from manim_imports_ext import", "from manim import")), 0.98),
    Pattern("Missing reduce import", r"name 'reduce' is not defined", _insert("from functools import reduce", used=r"reduce\("), 0.95),
    Pattern("Missing method call parentheses", r"'builtin_function_or_method' object.*not subscriptable|'method' object.*not subscriptable", _subs(*[(rf"\.{m}\b(?!\s*\()", f".{m}()") for m in _NOT_CALLED]), 0.90),
    Pattern("Invalid ImageMobject invert", r"unexpected keyword.*invert|got an unexpected keyword argument.*invert|ImageMobject.*invert",
            _subs((rf"(ImageMobject\([^()]*?),\s*{_BOOL}", r"\1"), (rf"ImageMobject\(\s*{_BOOL}\s*,?\s*", "ImageMobject(")), 0.90),
    Pattern("GrowFromCenter not found", r"name ['\"]GrowFromCenter['\"] is not defined", _subs((r"\bGrowFromCenter\b", "FadeIn")), 0.85),
    Pattern("ShowCreation deprecated", r"name ['\"]ShowCreation['\"] is not defined", _subs((r"\bShowCreation\b", "Create")), 0.85),
    Pattern("ApplyMethod deprecated", r"ApplyMethod.*deprecated|name 'ApplyMethod' is not defined", _subs((r"ApplyMethod\(([^,()]+)\.(shift|scale|rotate|move_to),\s*([^)]+)\)", r"\1.animate.\2(\3)")), 0.80),
    Pattern("Transform deprecated", r"name ['\"]Transform['\"] is not defined", _subs((r"\bTransform\b", "ReplacementTransform")), 0.80),
    Pattern("Problematic imports", r"ModuleNotFoundError.*(?:displayer|cv2|scipy\.ndimage|pygame|pydub|manimlib)", _lines(_gone_import), 0.85),
    Pattern("manimlib imports conversion", r"ModuleNotFoundError.*manimlib|ImportError.*manimlib", _lines(_old_import), 0.90),
    Pattern("Missing custom animations", r"name '(?:FlipThroughNumbers|DelayByOrder|ContinualAnimation)' is not defined",
            _helpers(["FlipThroughNumbers", "DelayByOrder", "CounterclockwiseTransform", "ClockwiseTransform", "ShimmerIn", "ContinualAnimation"], r"\b{}\b", "manimce_custom_animations"), 0.75),
    Pattern("Custom classes", r"name '(?:TeacherStudentsScene|PiCreatureScene|Face|SpeechBubble|ThoughtBubble|PiCreature)' is not defined",
            _subs((r"\b(?:TeacherStudentsScene|PiCreatureScene)\b", "Scene"), (r"(?m)^(\s*)(?!#|pass)(.*\b(?:Face|SpeechBubble|ThoughtBubble|PiCreature|Eyes|Mouth)\(.*)$", r"\1pass  # \2")), 0.80),
    Pattern("InteractiveScene conversion", r"name 'InteractiveScene' is not defined", _subs((r"\bInteractiveScene\b", "Scene")), 0.90),
    Pattern("Color variants", r"name '(?:BLUE_[A-E]|RED_[A-E]|GREEN_[A-E]|YELLOW_[A-E]|PURPLE_[A-E]|MAROON_[A-E])' is not defined", _subs(*_SHADES), 0.85),
    Pattern("CONFIG attribute errors", r"type object.*has no attribute 'CONFIG'", _lines(_config_line), 0.70),
    Pattern("Tex vs MathTex issues", r"unexpected keyword argument.*tex_template|Tex.*unexpected.*arg", _subs((r"\bTex\(([^)]*(?:math|\$|\\\\\w)[^)]*)\)", r"MathTex(\1)")), 0.70),
    Pattern("Undefined helper functions", r"name '(?:get_norm|rotate_vector|interpolate|choose|color_to_int_rgb|inverse_power_law|interpolate_mobject)' is not defined",
            _helpers(["get_norm", "rotate_vector", "interpolate", "inverse_interpolate", "choose", "color_to_int_rgb", "inverse_power_law", "interpolate_mobject", "sigmoid", "binary_search"], r"(?<![\w.]){}\(", _HELPERS), 0.90),
    Pattern("Undefined constants", r"name '(?:FRAME_X_RADIUS|FRAME_Y_RADIUS|FRAME_WIDTH|FRAME_HEIGHT|SMALL_BUFF|MED_SMALL_BUFF|MED_LARGE_BUFF|LARGE_BUFF|RADIUS)' is not defined",
            _helpers(["FRAME_X_RADIUS", "FRAME_Y_RADIUS", "FRAME_WIDTH", "FRAME_HEIGHT", "SMALL_BUFF", "MED_SMALL_BUFF", "MED_LARGE_BUFF", "LARGE_BUFF", "RADIUS", "DEFAULT_MOBJECT_TO_EDGE_BUFFER", "DEFAULT_MOBJECT_TO_MOBJECT_BUFFER"], r"\b{}\b", _HELPERS), 0.90),
    Pattern("Undefined rate functions", r"name '(?:rush_into|rush_from|slow_into|double_smooth|there_and_back_with_pause)' is not defined",
            _helpers(["rush_into", "rush_from", "slow_into", "double_smooth", "there_and_back_with_pause"], r"rate_func\s*=\s*{0}\b|\b{0}\s*\(", _HELPERS), 0.90),
    Pattern("Missing deepcopy import", r"name 'deepcopy' is not defined", _insert("from copy import deepcopy", used=r"(?<![.\w])deepcopy\(", unless=r"from copy import.*deepcopy"), 0.95),
    Pattern("Missing initials function", r"name 'initials' is not defined", _initials, 0.95),
    Pattern("Python 2 string.letters", r"module 'string' has no attribute 'letters'|AttributeError.*string.*letters", _subs((r"\bstring\.letters\b", "string.ascii_letters")), 0.98),
    Pattern("Undefined you variable", r"name 'you' is not defined", _you, 0.95),
    Pattern("List constants in MathTex", r"AttributeError.*'list' object has no attribute 'find'", _subs((r"\bMathTex\s*\(\s*(" + "|".join(D.LIST_CONSTANTS) + r")\s*(?=[,)])", r"MathTex(' '.join(\1)")), 0.95),
]
_TRIED = sorted(((re.compile(p.error, re.I), p) for p in PATTERNS), key=lambda x: -x[1].rate)


def recover(code: str | None, message: str | None) -> dict:
    """The code after all fixes that the message asks for, and the names of those that changed it."""
    code, changes = code or "", []
    for error, p in _TRIED if message else []:
        if error.search(message):
            fixed = p.fix(code)
            if fixed != code:
                code, changes = fixed, [*changes, p.name]
    return {"code": code, "recovered": bool(changes), "changes": changes}


def with_recovered(df: DataFrame, code: str, message: str, out: str = "recovery") -> DataFrame:
    """df with struct<code, recovered, changes>."""
    return df.withColumn(out, each(recover, "code string, recovered boolean, changes array<string>")(F.col(code), F.col(message)))
