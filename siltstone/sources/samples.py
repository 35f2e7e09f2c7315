"""Small pieces of source code, put in front of texts to give rules over code something to find."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CODE = [
    "from lib import *\n\nclass Opening(Scene):\n    CONFIG = {'run_time': 3, 'color': GRAY}\n    def construct(self):\n        title = TextMobject('Hello')\n        self.play(ShowCreation(title))\n        self.wait()\n",
    "import os\nimport numpy as np\nfrom helpers import grid\n\nN = 4\nSIZE = N * 2\n\ndef helper(x):\n    return scale(x) + SIZE\n\ndef scale(x):\n    return x * N\n\nclass Grid(Scene):\n    def construct(self, rows, cols=2):\n        for i in range(rows):\n            for j in range(cols):\n                self.add(grid(helper(i), j))\n",
    "import cv2\nframe = cv2.imread('a.png')\nprint(frame[0])\n",
    "class Face2(Scene):\n    def construct(self):\n        randy = Randolph()\n        randy.look(DL)\n        if randy:\n            if randy.mode:\n                self.add(randy, DL, DR, UL)\n",
    "class Broken(Scene):\n    def construct(self:\n        self.add(Tex(['a', 'b'])\n",
    "a, b, c = [Text('x'), Text('y'), Text('z')]\ngroup = VGroup([a, b, c])\nleft = a.points[0] - b.points[-1]\nmid = a.get_center() + b.get_center()\nw = group.get_width() / 2\n",
    "class Move(ContinualAnimation):\n    CONFIG = {'rate': lambda t: t}\n    def update(self, dt):\n        self.mobject.shift(dt * RIGHT)\n",
    "from math import sin\n\ndef curve(t):\n    return sin(t) + undefined_thing\n\nsquares = [[x * y for x in range(3)] for y in range(3)]\nlines = MathMathTex(r'\\frac{1}{2}')\n",
]

def dealt(values: list[str], number: Column) -> Column:
    """One of the values by a number."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def sql_dealt(values: list[str], number: str) -> str:
    """The same for DuckDB."""
    return "CASE " + " ".join(f"WHEN {number} % {len(values)} = {k} THEN {quoted(v)}" for k, v in enumerate(values)) + " END"


def quoted(v: str) -> str:
    """A DuckDB string literal."""
    return "'" + v.replace("'", "''") + "'"
