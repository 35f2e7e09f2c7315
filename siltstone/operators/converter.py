"""The tree converter: a source in the old dialect, rewritten as a syntax tree, statement by statement.

One walk from the leaves up rewrites expressions (calls, names, subscripts); statements and classes are then looked at as
wholes, where their order matters: imports, CONFIG, construct, timing. Every change is counted by kind. A source that does
not parse takes the text converter instead.
"""

from __future__ import annotations

import ast
import copy
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.batches import each
from siltstone.rules import dialect as D

_TEXTS = ("Tex", "MathTex", "Text")


def _name(x: ast.AST) -> str:
    return x.id if isinstance(x, ast.Name) else ""


def _expr(text: str) -> ast.expr:
    return ast.parse(text, mode="eval").body


def _is_self_call(s: ast.stmt, method: str) -> bool:
    """self.method(...) as a statement."""
    c = s.value if isinstance(s, ast.Expr) else None
    return isinstance(c, ast.Call) and isinstance(c.func, ast.Attribute) and c.func.attr == method and _name(c.func.value) == "self"


def _strings(x: ast.AST) -> list[str] | None:
    """The strings of a list of string constants."""
    if isinstance(x, ast.List) and x.elts and all(isinstance(e, ast.Constant) and isinstance(e.value, str) for e in x.elts):
        return [e.value for e in x.elts]
    return None


class _Rewriter(ast.NodeTransformer):
    def __init__(self, defined: set[str]):
        self.did, self.defined = Counter(), defined

    def _new(self, kind: str, node: ast.AST, old: ast.AST) -> ast.AST:
        self.did[kind] += 1
        return ast.copy_location(node, old)

    # Names

    def visit_Name(self, node: ast.Name):
        if not isinstance(node.ctx, ast.Load) or node.id in self.defined:
            return node
        if node.id in D.TREE_COLORS:
            return self._new("color", ast.Name(D.TREE_COLORS[node.id], node.ctx), node)
        if node.id in D.TREE_CLASSES:
            return self._new("rename", ast.Name(D.TREE_CLASSES[node.id], node.ctx), node)
        if node.id in D.SUMS:
            return self._new("direction", _expr(" + ".join(D.SUMS[node.id])), node)
        if node.id in D.FRAME:
            return self._new("constant", _expr(D.FRAME[node.id]), node)
        if node.id in D.FUNCTIONS:
            return self._new("function", _expr(D.FUNCTIONS[node.id]), node)
        return node

    # Attributes and subscripts

    def visit_Attribute(self, node: ast.Attribute):
        self.generic_visit(node)
        owner = _name(node.value)
        if owner == "string" and node.attr == "letters":
            node.attr = "ascii_letters"
            self.did["python3"] += 1
        elif owner == "config" and isinstance(node.ctx, ast.Load):
            return self._new("config_access", ast.Subscript(node.value, ast.Constant(node.attr), node.ctx), node)
        return node

    def visit_Subscript(self, node: ast.Subscript):
        self.generic_visit(node)
        v, at = node.value, node.slice
        if isinstance(v, ast.Call) and isinstance(v.func, ast.Attribute) and v.func.attr == "get_center" and not v.args:
            node.value = self._new("subscript", ast.Attribute(v.func.value, "center", ast.Load()), v)
        elif isinstance(v, ast.Attribute) and v.attr == "get_center":
            node.value = self._new("subscript", ast.Attribute(v.value, "center", ast.Load()), v)
        elif isinstance(v, ast.Attribute) and v.attr == "points" and isinstance(node.ctx, ast.Load):
            try:
                place = ast.literal_eval(at)
            except ValueError:
                place = None
            if place in (0, -1):
                return self._new("points", ast.Call(ast.Attribute(v.value, "get_end" if place else "get_start", ast.Load()), [], []), node)
        return node

    def visit_BinOp(self, node: ast.BinOp):
        self.generic_visit(node)
        if isinstance(node.left, ast.Attribute) and node.left.attr == "get_center":
            node.left.attr = "center"
            self.did["method_attribute"] += 1
        ints = all(isinstance(x, ast.Constant) and type(x.value) is int for x in (node.left, node.right))
        if isinstance(node.op, ast.Div) and ints:
            node.op = ast.FloorDiv()
            self.did["python3"] += 1
        return node

    # Calls

    def visit_Call(self, node: ast.Call):
        old = _name(node.func)
        texts = self._split_texts(node)
        if texts:
            return texts
        self.generic_visit(node)
        if old in D.TREE_COMMENTED and old not in self.defined:
            return self._new("custom_class", ast.Constant(f"{old} removed: no counterpart"), node)
        if isinstance(node.func, ast.Name):
            return self._constructor(node, old)
        if isinstance(node.func, ast.Attribute):
            return self._method(node)
        return node

    def _split_texts(self, node: ast.Call):
        """Text([...]).split(): a list of texts."""
        f = node.func
        if isinstance(f, ast.Attribute) and f.attr == "split" and not node.args and isinstance(f.value, ast.Call) and _name(f.value.func) in ("OldTexText", "TextMobject", "Text"):
            parts = _strings(f.value.args[0]) if f.value.args else None
            if parts:
                return self._new("split", ast.List([ast.Call(ast.Name("Text", ast.Load()), [ast.Constant(p)], []) for p in parts], ast.Load()), node)
        return None

    def _constructor(self, node: ast.Call, old: str):
        self._keywords(node, old)
        name = _name(node.func)
        first = node.args[0] if node.args else None
        if name in _TEXTS and first is not None:
            parts = _strings(first)
            if parts:
                node.args[0] = self._new("list_argument", ast.Constant(" ".join(parts)), first)
            elif isinstance(first, ast.Call) and _name(first.func) == "list" and len(first.args) == 1:
                node.args[0] = self._new("list_argument", first.args[0], first)
            elif _name(first) in D.LIST_CONSTANTS:
                node.args[0] = self._new("list_constant", ast.Call(_expr("' '.join"), [first], []), first)
            if name == "Tex" and self._mathematical(node.args[0]):
                node.func = self._new("math", ast.Name("MathTex", ast.Load()), node.func)
        elif name == "VGroup" and len(node.args) == 1 and isinstance(first, ast.List):
            node.args = first.elts
            self.did["list_argument"] += 1
        elif name == "Mobject" and len(node.args) > 1:
            node.func = self._new("group", ast.Name("VGroup", ast.Load()), node.func)
        elif name == "Arrow" and len(node.args) == 2 and not node.keywords:
            node.keywords, node.args = [ast.keyword("start", node.args[0]), ast.keyword("end", node.args[1])], []
            self.did["arrow"] += 1
        elif name == "Vector" and len(node.args) == 2:
            start, way = node.args
            node = self._new("vector", ast.Call(ast.Name("Arrow", ast.Load()), [], [ast.keyword("start", start), ast.keyword("end", ast.BinOp(copy.deepcopy(start), ast.Add(), way)), *node.keywords]), node)
        elif name == "ApplyMethod" and isinstance(first, ast.Attribute):
            animated = ast.Attribute(ast.Attribute(first.value, "animate", ast.Load()), first.attr, ast.Load())
            node = self._new("apply_method", ast.Call(animated, node.args[1:], node.keywords), node)
        elif name == "Transform" and len(node.args) >= 2 and _name(node.args[0]) and _name(node.args[1]) and _name(node.args[0]) != _name(node.args[1]):
            node.func = self._new("transform", ast.Name("ReplacementTransform", ast.Load()), node.func)
        elif old == "DelayByOrder" and node.args:
            lag = [ast.keyword("lag_ratio", ast.Constant(0.1)), *node.keywords]
            node = self._new("delay", ast.Call(ast.Name("LaggedStart", ast.Load()), node.args, lag), node)
        return node

    @staticmethod
    def _mathematical(x: ast.AST) -> bool:
        if isinstance(x, ast.BinOp) and isinstance(x.op, ast.Mod):
            x = x.left
        return isinstance(x, ast.Constant) and isinstance(x.value, str) and any(m in x.value for m in D.MATH)

    def _keywords(self, node: ast.Call, old: str) -> None:
        """Parameters that have another form are converted, then those that are gone go."""
        name, given = _name(node.func), {k.arg: k.value for k in node.keywords}

        def swap(drop: tuple[str, ...], **new: ast.expr) -> None:
            node.keywords = [k for k in node.keywords if k.arg not in drop] + [ast.keyword(n, v) for n, v in new.items()]
            self.did["parameter"] += 1

        if name in ("Axes", "NumberPlane"):
            for c in "xy":
                if {f"{c}_min", f"{c}_max"} <= given.keys():
                    swap((f"{c}_min", f"{c}_max"), **{f"{c}_range": ast.List([given[f"{c}_min"], given[f"{c}_max"]], ast.Load())})
        elif name == "Circle" and "x_radius" in given:
            swap(("x_radius", "y_radius"), radius=given["x_radius"])
        elif name == "Ellipse" and {"x_radius", "y_radius"} <= given.keys():
            double = lambda v: ast.BinOp(ast.Constant(2), ast.Mult(), v)
            swap(("x_radius", "y_radius"), width=double(given["x_radius"]), height=double(given["y_radius"]))
        elif name == "Arrow":
            for a, b in (("tail", "start"), ("tip", "end")):
                for k in node.keywords:
                    if k.arg == a:
                        k.arg = b
                        self.did["parameter"] += 1
        gone = set(D.REMOVED_PARAMETERS.get(name, [])) | set(D.REMOVED_PARAMETERS.get(old, []))
        kept = [k for k in node.keywords if k.arg not in gone]
        self.did["parameter"] += len(node.keywords) - len(kept)
        node.keywords = kept

    def _method(self, node: ast.Call):
        f = node.func
        if f.attr in D.TREE_PROPERTIES and not node.args and not node.keywords:
            return self._new("property", ast.Attribute(f.value, D.TREE_PROPERTIES[f.attr], ast.Load()), node)
        if f.attr == "get_num_points" and not node.args:
            return self._new("points", ast.Call(ast.Name("len", ast.Load()), [ast.Attribute(f.value, "points", ast.Load())], []), node)
        if f.attr == "get_corner":
            f.attr = "get_critical_point"
            self.did["method"] += 1
        elif f.attr == "repeat" and node.args:
            many = ast.ListComp(ast.Call(ast.Attribute(f.value, "copy", ast.Load()), [], []), [ast.comprehension(ast.Name("_", ast.Store()), ast.Call(ast.Name("range", ast.Load()), node.args[:1], []), [], 0)])
            return self._new("method", ast.Call(ast.Name("VGroup", ast.Load()), [ast.Starred(many, ast.Load())], []), node)
        elif f.attr in ("scale_to_fit_width", "scale_to_fit_height") and any(k.arg == "maintain_aspect_ratio" for k in node.keywords):
            node.keywords = [k for k in node.keywords if k.arg != "maintain_aspect_ratio"]
            self.did["parameter"] += 1
        elif f.attr == "rotate" and len(node.args) == 2:
            node.keywords.insert(0, ast.keyword("axis", node.args.pop()))
            self.did["parameter"] += 1
        elif f.attr == "range_to" and isinstance(f.value, ast.Call) and _name(f.value.func) == "Color":
            return self._new("color", _expr("[RED, YELLOW, GREEN, BLUE]"), node)
        elif f.attr in D.REMOVED_METHODS:
            # In a chain what it was called on stays; alone it is taken out with its statement.
            return self._new("removed_method", f.value, node)
        return node

    # Statements

    def visit_Expr(self, node: ast.Expr):
        was = isinstance(node.value, ast.Call) and isinstance(node.value.func, ast.Attribute) and node.value.func.attr in D.REMOVED_METHODS
        self.generic_visit(node)
        return ast.copy_location(ast.Pass(), node) if was and not isinstance(node.value, ast.Call) else node

    def visit_Assign(self, node: ast.Assign):
        self.generic_visit(node)
        target, value = node.targets[0], node.value
        if len(node.targets) != 1:
            return node
        texts = value.elts if isinstance(value, ast.List) and value.elts and all(isinstance(e, ast.Call) and _name(e.func) in _TEXTS for e in value.elts) else None
        if texts and len(texts) == 1 and isinstance(target, ast.Name):
            node.value = self._new("wrapped_text", texts[0], value)
        elif isinstance(target, ast.Tuple) and isinstance(value, ast.List) and not any(isinstance(e, ast.Starred) for e in [*target.elts, *value.elts]):
            short = len(target.elts) - len(value.elts)
            one = texts[0].args[0].value.split("  ") if texts and len(texts) == 1 and texts[0].args and isinstance(texts[0].args[0], ast.Constant) and isinstance(texts[0].args[0].value, str) else []
            if short > 0 and len(one) == len(target.elts):
                parts = [ast.Call(copy.deepcopy(texts[0].func), [ast.Constant(p)], []) for p in one]
                node.value = self._new("list_unpack", ast.Tuple(parts, ast.Load()), value)
            elif short > 0:
                value.elts += [ast.Constant(None) for _ in range(short)]
                self.did["list_unpack"] += 1
            elif short == 0 and texts:
                node.value = self._new("wrapped_text", ast.Tuple(texts, ast.Load()), value)
        return node

    def visit_Import(self, node: ast.Import):
        return self._new("import", _star("manim"), node) if any(a.name.split(".")[0] == "manimlib" for a in node.names) else node

    def visit_ImportFrom(self, node: ast.ImportFrom):
        return self._new("import", _star("manim"), node) if (node.module or "").split(".")[0] in ("manimlib", "manim_imports_ext", "big_ol_pile_of_manim_imports") else node

    def visit_FunctionDef(self, node: ast.FunctionDef):
        self.generic_visit(node)
        if node.name == "draw_you":
            bubble = any(a.arg == "with_bubble" for a in node.args.args)
            text = "result = Circle(radius=0.5, color=GREY)\nresult.to_corner(LEFT + DOWN)\n"
            if bubble:
                text += "if with_bubble:\n    bubble = RoundedRectangle(width=3, height=2, corner_radius=0.3)\n    bubble.next_to(result, UP)\n    return (result, bubble)\n"
            node.body = ast.parse(text).body + [ast.Return(ast.Name("result", ast.Load()))]
            self.did["placeholder"] += 1
        return node

    def visit_ClassDef(self, node: ast.ClassDef):
        self.generic_visit(node)
        for k, b in enumerate(node.bases):
            if _name(b) in D.TREE_BASES and _name(b) not in self.defined:
                node.bases[k] = self._new("base", ast.Name("Scene", ast.Load()), b)
        self._config(node)
        if any("Scene" in (_name(b) or getattr(b, "attr", "")) for b in node.bases):
            self._scene(node)
        return node

    def _config(self, node: ast.ClassDef) -> None:
        """CONFIG becomes assignments in __init__; what digested it goes."""
        found = next((m for m in node.body if isinstance(m, ast.Assign) and [_name(t) for t in m.targets] == ["CONFIG"] and isinstance(m.value, ast.Dict)), None)
        for m in node.body:
            if isinstance(m, ast.FunctionDef):
                kept = [s for s in m.body if "digest_config(self" not in ast.unparse(s) or isinstance(s, ast.FunctionDef | ast.If | ast.For | ast.While | ast.With)]
                self.did["config"] += len(m.body) - len(kept)
                m.body = kept or [ast.Pass()]
        if found is None or not all(isinstance(k, ast.Constant) and str(k.value).isidentifier() for k in found.value.keys):
            return
        self.did["config"] += 1
        node.body.remove(found)
        sets = [ast.Assign([ast.Attribute(ast.Name("self", ast.Load()), k.value, ast.Store())], v) for k, v in zip(found.value.keys, found.value.values, strict=True)]
        init = next((m for m in node.body if isinstance(m, ast.FunctionDef) and m.name == "__init__"), None)
        if init is None:
            init = ast.parse("def __init__(self, **kwargs):\n    super().__init__(**kwargs)").body[0]
            node.body.insert(0, init)
        at = next((k + 1 for k, s in enumerate(init.body) if "super()" in ast.unparse(s)), 0)
        init.body[at:at] = sets

    def _scene(self, node: ast.ClassDef) -> None:
        """A scene has a construct of its own, without arguments, with what it uses defined and time to be seen."""
        methods = {m.name: m for m in node.body if isinstance(m, ast.FunctionDef)}
        construct = methods.get("construct")
        inside = list(ast.walk(node))
        used = {n.attr for n in inside if isinstance(n, ast.Attribute) and _name(n.value) == "self"}
        if used & set(D.STUBBED_METHODS) - methods.keys() and "Scene" in map(_name, node.bases):
            at = 1 + node.body.index(methods["__init__"]) if "__init__" in methods else 0
            node.body[at:at] = [ast.parse(f"def {n}(self, *args, **kwargs):\n    pass").body[0] for n in D.STUBBED_METHODS if n not in methods]
            self.did["stub"] += 1
        if construct is None:
            if "_construct_with_args" not in methods:
                node.body.append(ast.parse("def construct(self):\n    pass").body[0])
                self.did["construct"] += 1
            return
        given = next((m.value for m in node.body if isinstance(m, ast.Assign) and [_name(t) for t in m.targets] == ["args_list"] and isinstance(m.value, ast.List)), None)
        if given is not None and len(construct.args.args) > 1:
            first = given.elts[0] if given.elts else ast.Constant("default")
            first = first.elts[0] if isinstance(first, ast.Tuple) and first.elts else first
            construct.name = "_construct_with_args"
            call = ast.parse("def construct(self):\n    self._construct_with_args()").body[0]
            call.body[0].value.args = [copy.deepcopy(first)]
            node.body.insert(node.body.index(construct) + 1, call)
            self.did["args_list"] += 1
            return
        names = [n for n in inside if isinstance(n, ast.Name)]
        stored = {n.id for n in names if isinstance(n.ctx, ast.Store)} | {a.arg for a in inside if isinstance(a, ast.arg)}
        if "you" in {n.id for n in names} - stored - self.defined:
            construct.body.insert(0, ast.parse("you = draw_you()").body[0])
            self.did["undefined"] += 1
        timed: list[ast.stmt] = []
        for k, s in enumerate(construct.body):
            timed.append(s)
            after = construct.body[k + 1] if k + 1 < len(construct.body) else None
            if after is not None and _is_self_call(s, "add") and not _is_self_call(after, "wait"):
                timed.append(ast.parse("self.wait(0.5)").body[0])
                self.did["timing"] += 1
        if timed and (_is_self_call(timed[-1], "add") or _is_self_call(timed[-1], "play")):
            timed.append(ast.parse("self.wait(1)").body[0])
            self.did["timing"] += 1
        construct.body = timed


def _star(module: str) -> ast.ImportFrom:
    return ast.ImportFrom(module, [ast.alias("*")], 0)


def _module(tree: ast.Module, did: Counter) -> None:
    """Imports once each, those that are missing, and the helper that some sources call."""
    seen, body = set(), []
    for s in tree.body:
        text = ast.unparse(s) if isinstance(s, ast.Import | ast.ImportFrom) else None
        if text is None or text not in seen:
            body.append(s)
        seen.add(text)
    nodes = list(ast.walk(tree))
    called = {_name(c.func) for c in nodes if isinstance(c, ast.Call)}
    bound = {n.name for n in nodes if isinstance(n, ast.FunctionDef | ast.ClassDef)} | {a.asname or a.name for n in nodes if isinstance(n, ast.Import | ast.ImportFrom) for a in n.names}
    last = max((k + 1 for k, s in enumerate(body) if isinstance(s, ast.Import | ast.ImportFrom)), default=0)
    add = []
    if "deepcopy" in called - bound:
        add += ast.parse("from copy import deepcopy").body
    if "initials" in called - bound:
        add += ast.parse("def initials(chars):\n    return ''.join((c for c in chars if c.isupper()))").body
    did["missing"] += len(add)
    body[last:last] = add
    tree.body = body


def after(code: str) -> tuple[str, int]:
    """What is left for the text: names doubled by earlier conversions."""
    return re.subn(r"\b(?:Math){2,}Tex\b", "MathTex", code)


def convert(code: str | None) -> dict:
    """The converted source, how many changes of each kind were made, nodes, and whether the result parses."""
    code = code or ""
    try:
        tree = ast.parse(code)
        found = list(ast.walk(tree))
        nodes = len(found)
        defined = {n.name for n in found if isinstance(n, ast.FunctionDef | ast.AsyncFunctionDef | ast.ClassDef)}
        defined |= {n.id for n in found if isinstance(n, ast.Name) and isinstance(n.ctx, ast.Store) and not n.id.isupper()}
        r = _Rewriter(defined)
        tree = r.visit(tree)
        _module(tree, r.did)
        out, doubled = after(ast.unparse(ast.fix_missing_locations(tree)))
        r.did["doubled"] += doubled
        changes = {k: n for k, n in r.did.items() if n}
        try:
            ast.parse(out)
            return {"code": out, "changes": changes, "valid": True, "error": None, "nodes": nodes, "way": "tree"}
        except SyntaxError as e:
            return {"code": out, "changes": changes, "valid": False, "error": str(e), "nodes": nodes, "way": "tree"}
    except (SyntaxError, ValueError, RecursionError, MemoryError) as e:
        out, changes = text_convert(code)
        return {"code": out, "changes": changes, "valid": False, "error": str(e), "nodes": 0, "way": "text"}


_TEXT_NAMES = {**D.TREE_CLASSES, **D.TREE_COLORS, "OldTex": "Tex", "SimpleTex": "Tex"}
_WORDS = re.compile(r"\b(?:" + "|".join(map(re.escape, _TEXT_NAMES)) + r")\b")
#: Text rules, in order: (kind, pattern, replacement).
TEXT_RULES = [
    ("tex_paren", r'((?:Old)?Tex\("[()]"\))\)', r"\1"),
    ("import", r"(?m)^from (?:manimlib[\w.]*|manim_imports_ext|big_ol_pile_of_manim_imports) import .*$", "from manim import *"),
    ("import", r"(?m)^import manimlib\b.*$", "from manim import *"),
    ("property", r"\.(get_width|get_height|get_color|get_fill_color|get_stroke_color|get_fill_opacity|get_stroke_opacity|get_stroke_width)\(\)", lambda m: "." + m[1][4:]),
    ("animation", r"ApplyMethod\(\s*([\w.]+)\.(\w+)\s*,\s*([^()]*)\)", r"\1.animate.\2(\3)"),
    ("constant", r"\bFRAME_WIDTH\b", "config.frame_width"),
    ("constant", r"\bFRAME_HEIGHT\b", "config.frame_height"),
    ("constant", r"\bFRAME_X_RADIUS\b", "config.frame_width / 2"),
    ("constant", r"\bFRAME_Y_RADIUS\b", "config.frame_height / 2"),
    ("arrow", r"\b(Arrow\([^()]*)\btail\s*=", r"\1start="),
    ("arrow", r"\b(Arrow\([^()]*)\btip\s*=", r"\1end="),
    ("updater", r"(?m)^(\s*)self\.add\(ContinualAnimation\((\w+)\)\)", r"\1\2.add_updater(lambda m, dt: None)"),
    ("parameterized", r"(?m)^(\s*)def construct\(self,\s*([^)]*)\):", r"\1def _construct_with_args(self, \2):"),
    ("three_d", r"\bset_camera_position\(", "set_camera_orientation("),
    ("pi_creature", r"(?m)^(\s*)(?!#|pass)(.*\b(?:PiCreature|Randolph|Mortimer|ThoughtBubble|SpeechBubble)\(.*)$", r"\1pass  # \2"),
]


def text_convert(code: str) -> tuple[str, dict[str, int]]:
    """The text converter: rules over the text of a source that does not parse; its names, then the rules in order."""
    did: Counter = Counter()
    code, n = _WORDS.subn(lambda m: _TEXT_NAMES[m[0]], code)
    did["rename"] += n
    for kind, pattern, new in TEXT_RULES:
        code, n = re.subn(pattern, new, code)
        did[kind] += n
    return code, {k: n for k, n in did.items() if n}


SCHEMA = "code string, changes map<string,int>, valid boolean, error string, nodes int, way string"


def with_converted(df: DataFrame, code: str, out: str = "converted") -> DataFrame:
    """df with struct<code, changes, valid, error, nodes, way>."""
    return df.withColumn(out, each(convert, SCHEMA)(F.col(code)))
