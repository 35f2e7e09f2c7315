"""Constants of modules: what each is made of, and their values in the order of their needs.

A constant is a name that a module binds once, at its top, to an expression. Its needs are the names the expression reads. Values are
worked out from what needs nothing upwards; constants that need each other, and all that need one of those, have none and say which
names are to blame.
"""

from __future__ import annotations

import ast
import operator
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.batches import each
from siltstone.operators.trees import nodes

SCHEMA = "array<struct<name: string, needs: array<string>, layer: int, state: string, value: string, cycle: string>>"
_BINARY = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.FloorDiv: operator.floordiv, ast.Mod: operator.mod, ast.Pow: operator.pow}
_UNARY = {ast.USub: operator.neg, ast.UAdd: operator.pos, ast.Not: operator.not_, ast.Invert: operator.invert}
#: Digits or characters beyond which a value is not worked out.
LARGEST = 4096


class NotConstant(Exception):
    """An expression that only running it would tell."""


def _bounded(value):
    if isinstance(value, int) and abs(value).bit_length() > 4 * LARGEST or isinstance(value, str | tuple | list) and len(value) > LARGEST:
        raise NotConstant
    return value


def value_of(x: ast.expr, known: dict):
    """The value of an expression of literals, operators and known names."""
    match x:
        case ast.Constant(value=v):
            return v
        case ast.Name(id=n) if n in known:
            return known[n]
        case ast.Tuple(elts=parts) | ast.List(elts=parts):
            made = [value_of(p, known) for p in parts]
            return _bounded(tuple(made) if isinstance(x, ast.Tuple) else made)
        case ast.UnaryOp(op=op, operand=a):
            return _UNARY[type(op)](value_of(a, known))
        case ast.BinOp(left=a, op=op, right=b) if type(op) in _BINARY:
            left, right = value_of(a, known), value_of(b, known)
            if isinstance(op, ast.Pow) and not (isinstance(right, int | float) and abs(right) <= 64):
                raise NotConstant
            if isinstance(op, ast.Mult) and any(isinstance(v, str | tuple | list) for v in (left, right)) and not all(isinstance(v, str | tuple | list) or 0 <= v <= 64 for v in (left, right)):
                raise NotConstant
            return _bounded(_BINARY[type(op)](left, right))
    raise NotConstant


def definitions(tree: ast.Module) -> dict[str, ast.expr]:
    """Expressions of the names bound once in the whole module, at its top."""
    found = nodes(tree)
    bound = Counter(n.id for n in found if isinstance(n, ast.Name) and not isinstance(n.ctx, ast.Load))
    bound.update(g for n in found if isinstance(n, ast.Global) for g in n.names)
    out = {}
    for s in tree.body:
        target = s.targets[0] if isinstance(s, ast.Assign) and len(s.targets) == 1 else s.target if isinstance(s, ast.AnnAssign) and s.value else None
        if isinstance(target, ast.Name) and bound[target.id] == 1:
            out[target.id] = s.value
    return out


def _around(name: str, needs: dict[str, list[str]]) -> set[str]:
    seen, todo = set(), [name]
    while todo:
        for n in needs.get(todo.pop(), []):
            if n not in seen:
                seen.add(n)
                todo.append(n)
    return seen


def constants(code: str | None) -> list[dict]:
    """(name, needs, layer, state, value, cycle) of a module's constants; state: value, computed (only running tells), or cycle."""
    try:
        found = definitions(ast.parse(code or ""))
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return []
    needs = {n: sorted({x.id for x in nodes(e) if isinstance(x, ast.Name) and x.id in found}) for n, e in found.items()}
    known, state, layer, value = {}, {}, {}, {}
    left = list(found)
    while left:
        ready = [n for n in left if all(d in state for d in needs[n])]
        if not ready:
            break
        for n in ready:
            layer[n] = 1 + max((layer[d] for d in needs[n]), default=-1)
            try:
                known[n] = value_of(found[n], known)
                state[n], value[n] = "value", repr(known[n])
            except (NotConstant, ArithmeticError, TypeError, ValueError, KeyError):
                state[n] = "computed"
        left = [n for n in left if n not in state]
    reach = {n: _around(n, needs) for n in left}
    blame = {n: sorted(m for m in {n, *reach[n]} if m in reach and m in reach[m]) for n in left}
    return [{"name": n, "needs": needs[n], "layer": layer.get(n), "state": state.get(n, "cycle"), "value": value.get(n), "cycle": ",".join(blame[n]) if n in blame else None} for n in found]


def with_constants(df: DataFrame, code: str, out: str = "constants") -> DataFrame:
    """df with the array of constants of a code column."""
    return df.withColumn(out, each(constants, SCHEMA, once=True)(F.col(code)))
