"""Sources in the old dialect, one for each part, made of the part's own key and size, with what they must become.

The specification is a table of statements: as written, as the systematic fixer must leave them, and as the tree
converter must. A part's source holds an import block, a constant, a helper, a scene class over one of five bases, at
times a CONFIG, at times a construct with arguments, three statements, and in one of eleven parts a broken last line. Both
engines build the texts from the same SQL, so an expectation is the same source made of other columns of the table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from siltstone.session import evenly, table
from siltstone.sources.samples import quoted

#: As written; as fixed; as converted. {k}: the part's key, {n}: its size.
STATEMENTS = [
    ("t = TextMobject('w{n}')", "t = Text('w{n}')", "t = Text('w{n}')"),
    ("self.play(ShowCreation(Circle(color=BLUE_C)))", "self.play(Create(Circle(color=BLUE)))", "self.play(Create(Circle(color=BLUE)))"),
    ("w = VGroup([Dot(), Dot()]).get_width()", "w = VGroup([Dot(), Dot()]).width", "w = VGroup(Dot(), Dot()).width"),
    ("m = TexMobject('x^{n}')", "m = MathTex('x^{n}')", "m = MathTex('x^{n}')"),
    ("v = RED_D", "v = DARK_RED", "v = DARK_RED"),
    ("a = Arrow(LEFT, RIGHT)", "a = Arrow(LEFT, RIGHT)", "a = Arrow(start=LEFT, end=RIGHT)"),
    ("p, q, r = [Text('a'), Text('b')]", "p, q, r = [Text('a'), Text('b')]", "p, q, r = [Text('a'), Text('b'), None]"),
    ("h = 7 / 2", "h = 7 / 2", "h = 7 // 2"),
    ("self.play(ApplyMethod(obj.shift, UP))", "self.play(ApplyMethod(obj.shift, UP))", "self.play(obj.animate.shift(UP))"),
    ("c = FRAME_WIDTH", "c = config.frame_width", "c = config['frame_width']"),
    ("d = DL", "d = DL", "d = DOWN + LEFT"),
    ("s = string.letters", "s = string.letters", "s = string.ascii_letters"),
    ("g = obj.get_num_points()", "g = len(obj.points)", "g = len(obj.points)"),
    ("self.add(helper_{k}(2))\n        y = {n}", "self.add(helper_{k}(2))\n        y = {n}", "self.add(helper_{k}(2))\n        self.wait(0.5)\n        y = {n}"),
    ("obj.pin_to(other)", "obj.pin_to(other)", "pass"),
    ("im = ImageMobject('f', invert=False)", "im = ImageMobject('f')", "im = ImageMobject('f')"),
    ("ax = Axes(x_min=0, x_max={n})", "ax = Axes(x_min=0, x_max={n})", "ax = Axes(x_range=[0, {n}])"),
    ("rate = smooth", "rate = rate_functions.smooth", "rate = smooth"),
    ("tx = Tex(['a', 'b'])", "tx = Tex(['a', 'b'])", "tx = Tex('a b')"),
    ("e = obj.get_center()[1]", "e = obj.get_center()[1]", "e = obj.center[1]"),
]
_OLD = "# {0}  # Converted: manimlib import"
IMPORTS = [
    ("from manimlib.imports import *", "from manim import *\n" + _OLD.format("from manimlib.imports import *"), "from manim import *"),
    ("from manim_imports_ext import *", "from manim import *", "from manim import *"),
    ("import numpy as np\nfrom manimlib import *", "import numpy as np\nfrom manim import *\n" + _OLD.format("from manimlib import *"), "import numpy as np\nfrom manim import *"),
    ("import cv2\nfrom manimlib.imports import *", "# import cv2  # Removed: ManimGL-specific import\nfrom manim import *\n" + _OLD.format("from manimlib.imports import *"), "import cv2\nfrom manim import *"),
]
BASES = [("Scene", "Scene", "Scene"), ("CycloidScene", "Scene", "Scene"), ("GraphScene", "Scene", "GraphScene"), ("InteractiveScene", "InteractiveScene", "Scene"), ("ThreeDScene", "ThreeDScene", "ThreeDScene")]
_CONFIG = "    CONFIG = {'run_time': {n}, 'stroke': GRAY}\n"
CONFIG = (_CONFIG, _CONFIG.replace("GRAY", "GREY"), "\n    def __init__(self, **kwargs):\n        super().__init__(**kwargs)\n        self.run_time = {n}\n        self.stroke = GREY\n")
#: What the text converter, which looks at no tree, must make of statements, imports and the CONFIG; all others stay as written.
AS_TEXT = {
    "t = TextMobject('w{n}')": "t = Text('w{n}')",
    "self.play(ShowCreation(Circle(color=BLUE_C)))": "self.play(Create(Circle(color=BLUE)))",
    "w = VGroup([Dot(), Dot()]).get_width()": "w = VGroup([Dot(), Dot()]).width",
    "m = TexMobject('x^{n}')": "m = MathTex('x^{n}')",
    "v = RED_D": "v = DARK_RED",
    "self.play(ApplyMethod(obj.shift, UP))": "self.play(obj.animate.shift(UP))",
    "c = FRAME_WIDTH": "c = config.frame_width",
    "from manimlib.imports import *": "from manim import *",
    "from manim_imports_ext import *": "from manim import *",
    "import numpy as np\nfrom manimlib import *": "import numpy as np\nfrom manim import *",
    "import cv2\nfrom manimlib.imports import *": "import cv2\nfrom manim import *",
    _CONFIG: _CONFIG.replace("GRAY", "GREY"),
}
STATEMENTS, IMPORTS, BASES = ([(*r, AS_TEXT.get(r[0], r[0])) for r in rows] for rows in (STATEMENTS, IMPORTS, BASES))
CONFIG = (*CONFIG, AS_TEXT[_CONFIG])
#: Steps from one statement of a source to the next in the table.
SLOTS = (0, 7, 13)
BROKEN = "\n        self.add(Tex('a'"


def _text(template: str) -> str:
    """A template as SQL."""
    parts = re.split(r"(\{[kn]\}|\n)", template)
    made = ["chr(10)" if p == "\n" else "p_partkey" if p == "{k}" else "p_size" if p == "{n}" else quoted(p) for p in parts if p]
    return f"concat({', '.join([*made, quoted('')])})"


def _choice(number: str, rows: list[tuple[str, str, str]], form: int) -> str:
    return f"CASE {number} " + " ".join(f"WHEN {i} THEN {_text(r[form])}" for i, r in enumerate(rows)) + " END"


def _source(form: int) -> str:
    """A whole source in one of the four forms: as written, fixed, converted, converted as text."""
    gap = chr(10) if form == 2 else ""
    slots = [f"concat('        ', {_choice(f'(p_partkey + {s}) % {len(STATEMENTS)}', STATEMENTS, form)}, chr(10))" for s in SLOTS]
    # The converter prints trees: one blank line before each def and class.
    helper = "def helper_{k}(x):\n    return x * SIZE\n"
    pieces = [
        _choice("p_partkey % 4", IMPORTS, form),
        _text("\nSIZE = {n}\n\n" + helper + "\nclass Part{k}("),
        _choice("p_size % 5", BASES, form),
        _text("):\n"),
        f"CASE WHEN p_size % 3 = 0 THEN {_text(CONFIG[form])} ELSE '' END",
        _text(gap + "    def "),
        f"CASE WHEN p_partkey % 7 = 3 THEN '{'_construct_with_args' if form == 3 else 'construct'}(self, rows, cols=2' ELSE 'construct(self' END",
        _text("):\n"),
        *slots,
        _text("        self.wait()"),
    ]
    if form != 2:
        pieces.append(f"CASE WHEN p_partkey % 11 = 5 THEN {_text(BROKEN)} ELSE '' END")
    return f"concat({', '.join(pieces)})"


def _moved() -> str:
    """A source whose construct takes arguments, printed from its tree with the arguments moved into __init__."""
    slots = [f"concat('        ', {_choice(f'(p_partkey + {s}) % {len(STATEMENTS)}', STATEMENTS, 0)}, chr(10))" for s in SLOTS]
    init = "\n    def __init__(self, rows, cols=2, **kwargs):\n        super().__init__(**kwargs)\n        self.rows = rows\n        self.cols = cols\n\n    def construct(self):\n"
    pieces = [
        _choice("p_partkey % 4", IMPORTS, 0),
        _text("\nSIZE = {n}\n\ndef helper_{k}(x):\n    return x * SIZE\n\nclass Part{k}("),
        _choice("p_size % 5", BASES, 0),
        _text("):\n"),
        f"CASE WHEN p_size % 3 = 0 THEN {_text(CONFIG[0])} ELSE '' END",
        _text(init),
        *slots,
        _text("        self.wait()"),
    ]
    return f"CASE WHEN p_partkey % 7 = 3 AND p_partkey % 11 <> 5 THEN concat({', '.join(pieces)}) END"


IMPORT_BLOCK = _choice("p_partkey % 4", IMPORTS, 0)
#: part with code (as written), fixed, converted and moved (null where it does not apply) and as_text, for FROM.
SQL = f"(SELECT p_partkey, p_size, {_source(0)} AS code, {_source(1)} AS fixed, CASE WHEN p_partkey % 11 <> 5 THEN {_source(2)} END AS converted, {_moved()} AS moved, {_source(3)} AS as_text, {IMPORT_BLOCK} AS imports FROM part)"


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, code): a source for each part."""
    return evenly(table(spark, sf_dir, "part").select("p_partkey", "p_size")).selectExpr("p_partkey", f"{_source(0)} AS code")


#: A module for each part, with every kind of scope; {j}: the next part's key.
MODULE = """import os, math as m
from pkg{n} import alpha, beta as b{n}
from star import *

LIMIT = {n}
RATE = LIMIT * 2 + 1
TOTAL = RATE - LIMIT

class Base{k}:
    width = LIMIT

    def grow(self, by):
        return by + width

def helper_{k}(x, y=LIMIT):
    def inner(z):
        nonlocal x
        x = z
        return x + TOTAL
    return [inner(q) + q for q in range(y)]

class Part{k}(Base{k}):
    def construct(self):
        global TOTAL
        TOTAL = helper_{k}(3)
        a = helper_{j}(alpha)
        b = [len(a), m.pi, os.sep, ring, missing_{k}]
        return (lambda c: c + a)(b{n})
"""
#: What some modules hold beside: two constants that need each other, and one made of a function's value.
CYCLE = "\nLEFT = RIGHT + 1\nRIGHT = LEFT - 1\nCALLED = len('abc') + LIMIT\n"
#: Names read in a module: line, name, where they are found. cross_file stands for unresolved where there is no next part.
USES = [
    (6, "LIMIT", "constant"), (7, "RATE", "constant"), (7, "LIMIT", "constant"), (10, "LIMIT", "constant"), (13, "by", "local"), (13, "width", "unresolved"),
    (15, "LIMIT", "constant"), (18, "z", "local"), (19, "x", "local"), (19, "TOTAL", "constant"), (20, "inner", "function"), (20, "q", "local"), (20, "range", "builtin"),
    (20, "y", "local"), (22, "Base{k}", "class"), (25, "helper_{k}", "function"), (26, "helper_{j}", "cross_file"), (26, "alpha", "import"), (27, "len", "builtin"),
    (27, "a", "local"), (27, "m", "import"), (27, "os", "import"), (27, "ring", "star"), (27, "missing_{k}", "unresolved"), (28, "c", "local"), (28, "a", "local"), (28, "b{n}", "import"),
]
CYCLE_USES = [(30, "RIGHT", "constant"), (31, "LEFT", "constant"), (32, "len", "builtin"), (32, "LIMIT", "constant")]
_HAS_CYCLE = "p_partkey % 5 = 2"


def module_text(template: str) -> str:
    """A template of a module as SQL."""
    parts = re.split(r"(\{[knj]\}|\n)", template)
    names = {"\n": "chr(10)", "{k}": "p_partkey", "{n}": "p_size", "{j}": "(p_partkey + 1)"}
    return f"concat({', '.join([*(names.get(p) or quoted(p) for p in parts if p), quoted('')])})"


MODULE_TEXT = f"concat({module_text(MODULE)}, CASE WHEN {_HAS_CYCLE} THEN {module_text(CYCLE)} ELSE '' END)"


def modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, code): a module for each part."""
    return evenly(table(spark, sf_dir, "part").select("p_partkey", "p_size")).selectExpr("p_partkey", f"{MODULE_TEXT} AS code")


def uses_sql() -> str:
    """(p_partkey, line, name, level) of all names read, for FROM."""
    row = lambda line, name, level, when: f"SELECT p_partkey, p_size, {line} AS line, {module_text(name)} AS name, '{level}' AS level FROM part WHERE {when}"
    rows = [row(*u, "true") for u in USES] + [row(*u, _HAS_CYCLE) for u in CYCLE_USES]
    return "(" + " UNION ALL ".join(rows) + ")"


#: Damage at the end of a scene's construct, and what repair must make of it; None: nothing.
DAMAGE = [
    ("self.wait(2)", "self.wait(2)"),
    ("self.add(Tex('a'", "self.add(Tex('a'))"),
    ('v = " "SIZE', "v = SIZE"),
    ("out = for i in y:\n            pass", 'out = ""\n        for i in y:\n            pass'),
    ("x = f()\n            a, b)", "x = f(a, b)"),
    ('if a and" "b:\n            pass', "if a and b:\n            pass"),
    ("if a\n            pass", "if a:\n            pass"),
    ("s = [1, (2, {3", "s = [1, (2, {3})]"),
    ("no python here at all", None),
]
_KIND = f"p_partkey % {len(DAMAGE) + 1}"
_LOST = "no python (( here\n"


def _damaged(form: int) -> str:
    """Sources with damage (0), and as repaired (1); the last kind is no source at all."""
    undamaged = _source(0).replace("WHEN p_partkey % 11 = 5 THEN", "WHEN false THEN")
    last = " ".join(f"WHEN {i} THEN {_text(chr(10) + '        ' + (d[form] or d[0]))}" for i, d in enumerate(DAMAGE))
    return f"CASE WHEN {_KIND} = {len(DAMAGE)} THEN {_text(_LOST)} ELSE concat({undamaged}, CASE {_KIND} {last} END) END"


#: part with code (as damaged), repaired, and whether each parses, for FROM.
DAMAGED_SQL = f"(SELECT p_partkey, p_size, {_damaged(0)} AS code, {_damaged(1)} AS repaired, {_KIND} = 0 AS valid, {_KIND} < {len(DAMAGE) - 1} AS mended, {_KIND} = {len(DAMAGE)} AS lost FROM part)"


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, code): a source for each part, most of them damaged."""
    return evenly(table(spark, sf_dir, "part").select("p_partkey", "p_size")).selectExpr("p_partkey", f"{_damaged(0)} AS code")


#: Statements of the names and calls that the table above leaves out: as written, as fixed, as converted.
MORE_STATEMENTS = [
    ('a = WiggleOutThenIn(m)', 'a = Wiggle(m)', 'a = Wiggle(m)'),
    ('a = CircleIndicate(m)', 'a = Indicate(m)', 'a = Indicate(m)'),
    ('a = GrowFromCenter(m, run_time={k})', 'a = FadeIn(m, run_time={k})', 'a = FadeIn(m, run_time={k})'),
    ('a = ShowCreationThenDestruction(m)', 'a = ShowPassingFlash(m)', 'a = ShowPassingFlash(m)'),
    ("t = OldTexText('w{k}')", "t = Tex('w{k}')", "t = Text('w{k}')"),
    ("t = OldTex('x')", "t = Tex('x')", "t = Tex('x')"),
    ('p = Point(LEFT)', 'p = Dot(LEFT)', 'p = Point(LEFT)'),
    ('w = m.get_height() + {k}', 'w = m.height + {k}', 'w = m.height + {k}'),
    ('w = m.get_fill_color()', 'w = m.fill_color', 'w = m.fill_color'),
    ('c = GRAY', 'c = GREY', 'c = GREY'),
    ('c = LIGHT_GRAY', 'c = LIGHT_GREY', 'c = LIGHT_GREY'),
    ('c = MAROON_D', 'c = DARK_MAROON', 'c = DARK_MAROON'),
    ('c = GREEN_B', 'c = GREEN', 'c = LIGHT_GREEN'),
    ('c = YELLOW_E', 'c = GOLD_E', 'c = YELLOW'),
    ('f = FRAME_HEIGHT', 'f = config.frame_height', "f = config['frame_height']"),
    ('f = FRAME_X_RADIUS + {k}', 'f = config.frame_width / 2 + {k}', "f = config['frame_width'] / 2 + {k}"),
    ('d = UP+LEFT', 'd = UL', 'd = UP + LEFT'),
    ('d = DOWN+RIGHT', 'd = DR', 'd = DOWN + RIGHT'),
    ('m.nudge({k})', 'm.shift({k})', 'm.nudge({k})'),
    ('m.add_to_back(n)', 'm.add(n)', 'm.add_to_back(n)'),
    ('r = there_and_back', 'r = rate_functions.there_and_back', 'r = there_and_back'),
    ('m.center_of_mass()', 'm.get_center_of_mass()', 'm.center_of_mass()'),
    ('q = ApplyFunction(f, m)', 'q = Transform(f, m)', 'q = ApplyFunction(f, m)'),
    ('self.play(FlipThroughNumbers({k}))', 'pass  # self.play(FlipThroughNumbers({k}))  # NEEDS MANUAL CONVERSION', 'self.play(FlipThroughNumbers({k}))'),
    ('randy = Randolph()', 'pass  # randy = Randolph()  # No ManimCE equivalent', 'randy = Randolph()'),
    ('n = get_norm(v)', 'n = get_norm(v)', 'n = np.linalg.norm(v)'),
    ('r = rush_into', 'r = rush_into', 'r = smooth'),
    ('z = UL', 'z = UL', 'z = UP + LEFT'),
    ('m.elongate_tick_at({k})', 'm.elongate_tick_at({k})', 'pass'),
    ('l = NumberLine(radius={k})', 'l = NumberLine(radius={k})', 'l = NumberLine()'),
    ('v = Vector(UP, preserve_tip_size_when_scaling=False)', 'v = Vector(UP, preserve_tip_size_when_scaling=False)', 'v = Vector(UP)'),
    ('s = ShimmerIn(m)', 's = ShimmerIn(m)', 's = FadeIn(m)'),
    ('p = ParametricCurve(f)', 'p = ParametricCurve(f)', 'p = ParametricFunction(f)'),
    ("x = Texs('a')", "x = Texs('a')", "x = VGroup('a')"),
    ('y = FRAME_Y_RADIUS', 'y = config.frame_height / 2', "y = config['frame_height'] / 2"),
    ('k = m.get_stroke_width()', 'k = m.stroke_width', 'k = m.stroke_width'),
]
_AROUND = "from manim import *\n\nclass Part{k}(Scene):\n\n    def construct(self):\n        "


def one_statement(form: int) -> str:
    """A source of one of MORE_STATEMENTS in one of the three forms, as SQL."""
    cases = " ".join(f"WHEN {i} THEN {module_text(_AROUND + r[form] + chr(10) + '        self.wait()')}" for i, r in enumerate(MORE_STATEMENTS))
    return f"CASE p_partkey % {len(MORE_STATEMENTS)} {cases} END"
