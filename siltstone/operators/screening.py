"""Which rules are worth trying on a text: one pass of an automaton over the literals that the rules cannot match without.

From a pattern's own syntax follow sets of strings one of which lies in every match; the best such set (its shortest string the longest) is the
rule's. All rules' strings go into one Aho-Corasick automaton, whose pass over a text costs the same however many rules there are. Rules of
which no string occurs are not tried; a rule without such a set is always tried. What a match is is left to the rules' own patterns.
"""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from re import _constants as C
from re import _parser

from siltstone.operators.rules import Rule, hits

#: Strings that a set may hold, and how long they may grow.
MOST_STRINGS, LONGEST = 64, 40


def _better(a: frozenset[str] | None, b: frozenset[str] | None) -> frozenset[str] | None:
    worth = lambda s: (min(map(len, s)), -len(s)) if s else (0, 0)
    return a if worth(a) >= worth(b) else b


def _exact(node) -> frozenset[str] | None:
    """All strings that a part of a pattern can stand for, if they are few."""
    op, av = node
    if op is C.LITERAL:
        return frozenset([chr(av)])
    if op is C.IN and all(o is C.LITERAL for o, _ in av):
        return frozenset(chr(v) for _, v in av)
    if op is C.SUBPATTERN:
        return _sequence(av[3])[0]
    if op is C.BRANCH:
        parts = [_sequence(b)[0] for b in av[1]]
        return frozenset().union(*parts) if all(p is not None for p in parts) else None
    if op is C.AT or op in (C.ASSERT, C.ASSERT_NOT):
        return frozenset([""])
    return None


def _inside(node) -> frozenset[str] | None:
    """Strings one of which lies in whatever the part matches."""
    op, av = node
    if op is C.SUBPATTERN:
        return _sequence(av[3])[1]
    if op is C.BRANCH:
        parts = [_sequence(b)[1] for b in av[1]]
        return frozenset().union(*parts) if all(parts) and sum(map(len, parts)) <= MOST_STRINGS else None
    if op in (C.MAX_REPEAT, C.MIN_REPEAT) and av[0] > 0:
        return _sequence(av[2])[1]
    return None


def _sequence(nodes) -> tuple[frozenset[str] | None, frozenset[str] | None]:
    """(all strings it stands for, strings one of which it needs) of parts one after another."""
    run, whole, best = frozenset([""]), True, None
    for node in nodes:
        exact = _exact(node)
        if exact is not None and len(run) * len(exact) <= MOST_STRINGS and max(map(len, run)) + max(map(len, exact)) <= LONGEST:
            run = frozenset(a + b for a in run for b in exact)
            continue
        best, whole = _better(best, run if all(run) else None), False
        best = _better(best, _inside(node))
        run = exact if exact is not None and len(exact) <= MOST_STRINGS else frozenset([""])
    best = _better(best, run if all(run) else None)
    return (run if whole else None), best


@cache
def required(pattern: str) -> frozenset[str] | None:
    """Strings one of which lies in every match of the pattern; None where that cannot be told. Case counts."""
    try:
        parsed = _parser.parse(pattern)
    except (re.error, OverflowError):
        return None
    if parsed.state.flags & (re.I | re.X):
        return None
    return _sequence(parsed)[1]


def worth_trying(text: Column, rules: list[Rule]) -> Column:
    """array<int>: numbers of the rules that may occur in a text."""
    needs = [frozenset([r.pattern]) if r.literal else required(r.pattern) for r in rules]
    always = [k for k, s in enumerate(needs) if not s]
    of: dict[str, set[int]] = {}
    for k, strings in enumerate(needs):
        for s in strings or ():
            of.setdefault(s, set()).add(k)

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        automaton = ahocorasick.Automaton()
        for s, numbers in of.items():
            automaton.add_word(s, s)
        if of:
            automaton.make_automaton()
        out = []
        for t in texts:
            found = {s for _, s in automaton.iter(t)} if of and t else set()
            out.append(sorted({*always, *(k for s in found for k in of[s])}) if t is not None else [])
        return pd.Series(out)

    return run(text)


def matched_if_worth(df: DataFrame, text: str, rules: list[Rule], out: str, flags: str = "m") -> DataFrame:
    """df with array<string>: names of the rules that occur, in the order of the list; see rules.matched."""
    d = df.withColumn("_try", worth_trying(F.col(text), rules))
    each = [F.when(F.array_contains("_try", k), F.when(hits(F.col(text), r, flags), r.name)) for k, r in enumerate(rules)]
    return d.withColumn(out, F.array_compact(F.array(*each))).drop("_try")
