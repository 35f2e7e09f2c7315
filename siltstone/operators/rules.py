"""Data-driven rule engine: rules are lists, matching is unrolled into one projection.

A rule's pattern becomes one rlike over the text, so a rule table of any length is a single scan without a join;
results are arrays, worst levels and products of factors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named pattern; level, weight and impact are used by the operator that asks for them.

    fast: a pattern that occurs in the same texts, under the flags ms, without trying again what cannot match.
    linear: a pattern that occurs as often in each text, under the flag m, likewise.
    needs: a string that lies in each text in which the pattern occurs.
    """

    name: str
    pattern: str
    level: str = ""
    weight: float = 1.0
    literal: bool = False
    category: str = ""
    explanation: str = ""
    fast: str = ""
    linear: str = ""
    needs: str = ""


def _pattern(rule: Rule, flags: str) -> str:
    return f"(?{flags})" + ({"ms": rule.fast, "m": rule.linear}.get(flags) or rule.pattern)


def hits(text: Column, rule: Rule, flags: str = "m") -> Column:
    """Whether the rule's pattern (or, for a literal rule, the pattern's own text) occurs."""
    return F.contains(text, F.lit(rule.pattern)) if rule.literal else text.rlike(_pattern(rule, flags))


def count(text: Column, rule: Rule, flags: str = "m") -> Column:
    """How often the rule's pattern occurs."""
    n = F.regexp_count(text, F.lit(_pattern(rule, flags)))
    return F.when(~F.contains(text, F.lit(rule.needs)), 0).otherwise(n) if rule.needs else n


def matched(text: Column, rules: list[Rule], flags: str = "m") -> Column:
    """array<string>: names of the rules that occur, in the order of the list."""
    return F.array_compact(F.array(*[F.when(hits(text, r, flags), r.name) for r in rules]))


def worst_level(text: Column, rules: list[Rule], levels: list[str], flags: str = "m") -> Column:
    """The highest of levels (given from mild to grave) among the rules that occur; the first where none does."""
    rank = F.greatest(F.lit(0), *[F.when(hits(text, r, flags), levels.index(r.level)).otherwise(0) for r in rules])
    return F.element_at(F.array(*map(F.lit, levels)), rank + 1)


def occurrences(text: Column, rules: list[Rule], flags: str = "m") -> Column:
    """Sum of weight x number of occurrences over the rules."""
    total = F.lit(0).cast("long")
    for r in rules:
        total = total + count(text, r, flags) * int(r.weight)
    return total


def damped(start: Column, text: Column, rules: list[Rule], flags: str = "m") -> Column:
    """start times (1 - weight) of every rule that occurs, in the order of the list."""
    for r in rules:
        start = start * F.when(hits(text, r, flags), 1.0 - r.weight).otherwise(1.0)
    return start


def first_category(text: Column, categories: list[tuple[str, list[str]]], default: str) -> tuple[Column, Column]:
    """(category, key): the first category one of whose patterns occurs, case ignored, and its first group."""
    category, key = F.lit(default), F.lit(None).cast("string")
    for name, patterns in reversed(categories):
        for p in reversed(patterns):
            found = text.rlike(f"(?i){p.removeprefix('.*')}")  # what follows .* occurs in the same texts, and is sought once instead of from every place
            group = F.regexp_extract(text, f"(?i){p}", 1) if "(" in p.replace("\\(", "") else F.lit(None).cast("string")
            category = F.when(found, name).otherwise(category)
            key = F.when(found, group).otherwise(key)
    return category, key


def exploded(df: DataFrame, key: str, text: Column, rules: list[Rule], flags: str = "m") -> DataFrame:
    """(key, rule, level): a row for each rule that occurs in each text."""
    found = F.array_compact(F.array(*[F.when(hits(text, r, flags), F.struct(F.lit(r.name).alias("rule"), F.lit(r.level).alias("level"))) for r in rules]))
    return df.select(key, F.explode(found).alias("x")).select(key, "x.rule", "x.level")


def explained(text: Column, rules: list[Rule], flags: str = "m") -> Column:
    """array<string>: "category: explanation" of the rules that occur."""
    return F.array_compact(F.array(*[F.when(hits(text, r, flags), f"{r.category}: {r.explanation}") for r in rules]))


def corrupted(text: Column) -> Column:
    """Two of four signs: odd bytes, few letters, hardly any text, no keyword."""
    signs = [
        text.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\xFF]"),
        F.regexp_count(text, F.lit("[a-zA-Z_]")) < F.length(text) * 0.3,
        F.length(F.trim(text)).between(1, 9),
        ~text.rlike("def|class|import|from|if|for|while|return"),
    ]
    return sum(s.cast("int") for s in signs) >= 2


def confidence_before(df: DataFrame, code: str, valid: str, name: str, problems: list[Rule], complexity: list[Rule]) -> DataFrame:
    """df with confidence, is_valid and use_fallback of a source before conversion.

    Factors: 0.3 without syntax; 0.9 for missing imports; 1 - 0.1 a damaged place, 0.2 at least; 0.8 over a complexity of 10 and
    0.9 over 5; 0.95 where the named scene class or its construct is not found.
    """
    c = F.col(code)
    has = lambda w: F.contains(c, F.lit(w))
    counts = [count(c, r) for r in problems]
    lines = F.floor(F.size(F.split(c, "\n")) / 50)
    d = df.withColumns({"_p": sum(counts), "_kinds": sum((n > 0).cast("int") for n in counts), "_x": occurrences(c, complexity) + lines})
    imports = (~has("from manim") & ~has("import manim") & (has("Scene") | has("Mobject"))) | (c.rlike(r"\bnp\.") & ~has("numpy"))
    scene = F.regexp_like(c, F.concat(F.lit(r"class\s+"), F.col(name), F.lit(r"\s*\([^)]*Scene[^)]*\):")))
    construct = has("def construct(self)") | has("def _construct_with_args")
    score = (
        F.when(F.col(valid), 1.0).otherwise(0.3)
        * F.when(imports, 0.9).otherwise(1.0)
        * F.when(F.col("_p") > 0, F.greatest(F.lit(0.2), 1.0 - F.lit(0.1) * F.col("_p"))).otherwise(1.0)
        * F.when(F.col("_x") > 10, 0.8).when(F.col("_x") > 5, 0.9).otherwise(1.0)
        * F.when(scene & construct, 1.0).otherwise(0.95)
    )
    issues = (~F.col(valid)).cast("int") + F.col("_kinds")
    d = d.withColumns({"confidence": score, "_issues": issues})
    use = (F.col("confidence") < 0.6) | ((F.col("_x") > 8) & (F.col("_issues") > 0)) | ((F.col("_issues") > 0) & (F.col("confidence") < 0.8))
    return d.withColumns({"is_valid": F.col("_issues") == 0, "use_fallback": use}).drop("_p", "_kinds", "_x", "_issues")


def confidence_after(df: DataFrame, code: str, valid: str, name: str, runtime: list[Rule]) -> DataFrame:
    """df with confidence and use_fallback of a converted source.

    0 without syntax, else the factors: 1 - 0.2 an occurrence of what fails at run time, 0.1 at least; 0.9 without the main
    import; 0.8 where the named class has not one of the three bases. A source that parses compiles.
    """
    c = F.col(code)
    errors = occurrences(c, runtime)
    base = F.regexp_like(c, F.concat(F.lit(r"class\s+"), F.col(name), F.lit(r"\s*\(\s*(Scene|ThreeDScene|MovingCameraScene)\s*\):")))
    score = (
        F.when(errors > 0, F.greatest(F.lit(0.1), 1.0 - F.lit(0.2) * errors)).otherwise(1.0)
        * F.when(F.contains(c, F.lit("from manim import *")) | F.contains(c, F.lit("import manim")), 1.0).otherwise(0.9)
        * F.when(base, 1.0).otherwise(0.8)
    )
    d = df.withColumns({"confidence": F.when(F.col(valid), score).otherwise(0.0), "_r": errors})
    return d.withColumn("use_fallback", ~F.col(valid) | (F.col("confidence") < 0.6) | (F.col("_r") > 3)).drop("_r")


def fallback(df: DataFrame, code: str, valid: str, fixes: str, start: str, rules: list[Rule]) -> DataFrame:
    """df with adjusted (confidence) and triggered: many fixes, a syntax error, risky patterns, several grave risks together.

    fixes: how many were made; start: the confidence so far. Factors: 0.6 from 35 fixes, 0.8 from 30; 0.5 without syntax;
    1 - weight for each pattern that occurs; 0.7 for two grave risks or more, which is one more.
    """
    c, n = F.col(code), F.col(fixes)
    found = [(r, hits(c, r, "ms")) for r in rules]
    score = F.col(start) * F.when(n >= 35, 0.6).when(n >= 30, 0.8).otherwise(1.0) * F.when(F.col(valid), 1.0).otherwise(0.5)
    for r, hit in found:
        score = score * F.when(hit, 1.0 - r.weight).otherwise(1.0)
    count = lambda level: sum((hit.cast("int") for r, hit in found if r.level == level), F.lit(0))
    high = count("high") + (n >= 35).cast("int") + (~F.col(valid)).cast("int")
    medium = count("medium") + ((n >= 30) & (n < 35)).cast("int")
    d = df.withColumns({"_h": high, "_m": medium, "_s": score})
    d = d.withColumn("adjusted", F.col("_s") * F.when(F.col("_h") >= 2, 0.7).otherwise(1.0))
    return d.withColumn("triggered", (F.col("_h") > 0) | (F.col("adjusted") < 0.7) | (F.col("_m") >= 2)).drop("_h", "_m", "_s")
