"""Repair of source texts that do not parse.

Damage is found where the tokens cannot stand side by side, or where the parser stops, and undone there: a pass returns edits
(from, to, new text) of the places it found. Nothing is searched for by the look of whole lines.
"""

from __future__ import annotations

import ast
import keyword
import re
from collections.abc import Iterator
from typing import NamedTuple


class Token(NamedTuple):
    """A piece of source: string, name, comment, line (its end), space or op; an unclosed quote is an op."""

    kind: str
    text: str
    start: int
    end: int


_LEX = re.compile(
    r"""(?P<string>[rRbBuUfF]{0,2}(?:\"{3}(?:\\.|[^\\])*?\"{3}|'{3}(?:\\.|[^\\])*?'{3}|"(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*'))
    |(?P<name>\w+)|(?P<comment>\#[^\n]*)|(?P<line>\n)|(?P<space>[^\S\n]+)|(?P<op>.)""",
    re.S | re.X,
)
_CLOSERS = {"(": ")", "[": "]", "{": "}"}
Edit = tuple[int, int, str]


def tokens(code: str) -> list[Token]:
    """The pieces of a source; together they are the source, whether it parses or not."""
    return [Token(m.lastgroup, m[0], m.start(), m.end()) for m in _LEX.finditer(code)]


def _quote(text: str) -> tuple[str, str, str]:
    """Prefix, quote and body of a string."""
    at = min(k for k in (text.find("'"), text.find('"')) if k >= 0)
    q = text[at] * (3 if text[at : at + 3] == text[at] * 3 and len(text) >= at + 6 else 1)
    return text[:at], q, text[at + len(q) : len(text) - len(q)]


def _glued(ts: list[Token]) -> Iterator[Edit]:
    """An empty string that touches another one is what is left of quotes that were changed on one side."""
    for a, b in zip(ts, ts[1:], strict=False):
        if a.kind == b.kind == "string":
            left, right = (_quote(t.text)[2] == "" for t in (a, b))
            if left or right:
                cut = a if left else b
                yield cut.start, cut.end, ""


def _stray(ts: list[Token]) -> Iterator[Edit]:
    """A blank string before a name, which no string can stand before, and after an assignment or a word of the language."""
    some = [t for t in ts if t.kind != "space"]
    for a, s, b in zip(some, some[1:], some[2:], strict=False):
        opens = a.text == "=" or (keyword.iskeyword(a.text) and a.text not in ("None", "True", "False"))
        if opens and s.kind == "string" and not _quote(s.text)[2].strip() and b.kind == "name" and not keyword.iskeyword(b.text):
            yield a.end, b.start, " "


def _continued(ts: list[Token]) -> Iterator[Edit]:
    """A string that goes on after a backslash at the line's end becomes strings side by side."""
    for t in ts:
        if t.kind == "string" and "\\\n" in t.text:
            prefix, q, body = _quote(t.text)
            if len(q) == 1:
                yield t.start, t.end, " ".join(f"{prefix}{q}{part.strip(' ' + chr(9))}{q}" for part in body.split("\\\n"))


def _escapes(ts: list[Token]) -> Iterator[Edit]:
    """A string none of whose backslashes is an escape of the language is meant raw."""
    for t in ts:
        if t.kind == "string" and "\\" in t.text:
            prefix, q, body = _quote(t.text)
            after = re.findall(r"\\(.)", body, re.S)
            if not prefix and len(q) == 1 and after and all(c in "spdw" for c in after):
                yield t.start, t.start, "r"


def _lines(ts: list[Token]) -> list[list[Token]]:
    out: list[list[Token]] = [[]]
    for t in ts:
        if t.kind == "line":
            out.append([])
        elif t.kind != "comment":
            out[-1].append(t)
    return out


def _loops(ts: list[Token]) -> Iterator[Edit]:
    """An assignment whose value is the head of a loop: the value is lost, the loop begins a line of its own."""
    for line in _lines(ts):
        some = [t for t in line if t.kind != "space"]
        if [t.text for t in some[1:3]] == ["=", "for"] and some[0].kind == "name" and some[-1].text == ":":
            pad = line[0].text if line[0].kind == "space" else ""
            yield some[1].end, some[2].start, f' ""\n{pad}'


def _balance(line: list[Token]) -> tuple[int, list[str]]:
    """How many brackets a line closes that it has not opened, and those it leaves open."""
    lost, open_ = 0, []
    for t in line:
        if t.text in _CLOSERS:
            open_.append(t.text)
        elif t.kind == "op" and t.text in ")]}":
            if open_:
                open_.pop()
            else:
                lost += 1
    return lost, open_


def _arguments(ts: list[Token]) -> Iterator[Edit]:
    """Arguments on the line after an empty pair of brackets, with the bracket that closes them once more."""
    lines = _lines(ts)
    for a, b in zip(lines, lines[1:], strict=False):
        left, right = ([t for t in x if t.kind != "space"] for x in (a, b))
        if [t.text for t in left[-2:]] == ["(", ")"] and right and right[-1].text == ")" and _balance(b) == (1, []) and b[0].kind == "space":
            yield left[-1].start, right[0].start, ""


def _opened(ts: list[Token]) -> Iterator[Edit]:
    """A string of several lines begun with one quote and ended with three is begun with three."""
    for k, t in enumerate(ts):
        if t.kind == "op" and t.text in "\"'":
            end = next((x for x in ts[k + 1 :] if x.kind in ("op", "string") and x.text.startswith(t.text)), None)
            if end is not None and end.kind == "string" and _quote(end.text)[2] == "" and any(x.kind == "line" for x in ts[k : ts.index(end)]):
                yield t.start, t.end, t.text * 3
                return


PASSES = [_continued, _glued, _stray, _loops, _arguments, _opened, _escapes]


def edited(code: str, edits: list[Edit]) -> str:
    """The text after edits that do not overlap."""
    out, at = [], 0
    for a, b, new in sorted(edits):
        if a >= at:
            out += [code[at:a], new]
            at = b
    return "".join([*out, code[at:]])


def _at_error(code: str) -> str | None:
    """The source mended on the line where the parser stops, if it says what is missing there."""
    try:
        ast.parse(code)
        return None
    except SyntaxError as e:
        said, at = e.msg or "", (e.lineno or 0) - 1
    except (ValueError, RecursionError, MemoryError):
        return None
    lines = code.split("\n")
    if not 0 <= at < len(lines):
        return None
    ts = [t for t in tokens(lines[at]) if t.kind not in ("space", "comment")]
    if not ts:
        return None
    if said == "expected ':'":
        lines[at] = edited(lines[at], [(ts[-1].end, ts[-1].end, ":")])
    elif said.endswith("was never closed"):
        where = ts[-1].start if ts[-1].text == ":" else ts[-1].end
        lines[at] = edited(lines[at], [(where, where, "".join(_CLOSERS[b] for b in reversed(_balance(ts)[1])))])
    else:
        return None
    return "\n".join(lines)


def rules(code: str) -> str:
    """All passes over the tokens one after another, then what the parser misses, line by line, while its error moves on."""
    for find in PASSES:
        code = edited(code, list(find(tokens(code))))
    seen = {code}
    while (mended := _at_error(code)) is not None and mended not in seen:
        seen.add(mended)
        code = mended
    return code


# Commands of formulas whose backslash a plain string would take for an escape.
_LATEX = re.compile(r"(?<!\\)\\(?=c[a-z]|p[a-z]|U[0-9A-Fa-f]|_|s[a-z]|d[a-z]|l[a-z]|q[a-z]|w[a-z])")


def latex_escapes(code: str) -> str:
    """Single backslashes of formulas in plain strings doubled; raw strings stay."""

    def double(m: re.Match) -> str:
        return m[0] if m[1] else m[1] + m[2] + _LATEX.sub(r"\\\\", m[3]) + m[2]

    return re.sub(r"""([rR]?)(["'])((?:(?!\2)[^\\\n]|\\[^\n])*)\2""", double, code)


#: Families of fixes for snippets that were validated and fail when run: (name, rules).
SNIPPET_FAMILIES: dict[str, list[tuple[str, str]]] = {
    "tex": [(r"\b(Tex|MathTex|Text)\(\[([^\]]*)\]\)", r"\1(' '.join([\2]))"), (r"\bMathMathTex\b", "MathTex")],
    "property": [(r"\.center\b(?!\s*\()", ".get_center()"), (r"\.(get_width|get_height)\(\)", lambda m: "." + m[1][4:])],
    "direction": [(rf"\b{a}\b", f"({b})") for a, b in (("DL", "DOWN + LEFT"), ("DR", "DOWN + RIGHT"), ("UL", "UP + LEFT"), ("UR", "UP + RIGHT"))],
    "animation": [(r"\bShowCreation\b", "Create"), (r"\bFadeInFromDown\b", "FadeIn"), (r"\bFadeOutAndShift\b", "FadeOut")],
    "points": [(r"(\w+)\.points\[0\]", r"\1.get_start()"), (r"(\w+)\.points\[-1\]", r"\1.get_end()")],
    "group": [(r"\bVGroup\(\[([^\[\]]*)\]\)", r"VGroup(\1)")],
}


def fix_snippet(code: str, families: list[str] | None = None) -> tuple[str, list[str]]:
    """The snippet after the families' rules and the escapes of formulas, and which families changed it."""
    changed = []
    for name in families if families is not None else SNIPPET_FAMILIES:
        before = code
        for pattern, new in SNIPPET_FAMILIES[name]:
            code = re.sub(pattern, new, code)
        changed += [name] * (code != before)
    fixed = latex_escapes(code)
    return fixed, changed + ["latex"] * (fixed != code)
