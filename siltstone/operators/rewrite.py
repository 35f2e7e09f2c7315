"""Ordered rewriting of text by rule lists, and what it changed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(text: Column, rules: list[tuple[str, str]]) -> Column:
    """All rules one after another as one expression."""
    return reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), rules, text)


def fold_counted(text: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rewritten text, array of how often each rule applied to what the rules before it left)."""
    counts = []
    for pattern, replacement in rules:
        counts.append(F.regexp_count(text, F.lit(pattern)))
        text = F.regexp_replace(text, pattern, replacement)
    return text, F.array(*counts)


def with_folded(df: DataFrame, text: str, rules: list[tuple[str, str]], out: str = "folded", counts: str = "counts") -> DataFrame:
    """df with the rewritten text, and how often each rule applied; one projection a rule, so that a rule runs once."""
    kept = df.columns
    d = df.withColumn("_t", F.col(text))
    for k, (pattern, replacement) in enumerate(rules):
        seen = [f"_n{i}" for i in range(k)]
        d = d.select(*kept, *seen, F.regexp_count("_t", F.lit(pattern)).alias(f"_n{k}"), F.regexp_replace("_t", pattern, replacement).alias("_t"))
    return d.select(*kept, F.col("_t").alias(out), F.array(*[F.col(f"_n{k}") for k in range(len(rules))]).alias(counts))


def diff_stats(a: Column, b: Column) -> list[Column]:
    """added, removed (distinct lines) and functions (difference in number)."""
    x, y = F.split(a, "\n"), F.split(b, "\n")
    n = lambda c: F.regexp_count(c, F.lit("def "))
    return [
        F.size(F.array_except(y, x)).cast("long").alias("added"),
        F.size(F.array_except(x, y)).cast("long").alias("removed"),
        F.abs(n(b) - n(a)).cast("long").alias("functions"),
    ]


# Pairs of names whose replacement is told.
REPLACED = [("ShowCreation", "Create"), ("TextMobject", "Text"), ("TexMobject", "MathTex"), ("get_width()", ".width"), ("get_height()", ".height")]


def change_summary(a: Column, b: Column) -> Column:
    """array<string>: what became of text a in b: an added import, another number of lines, names replaced altogether."""
    has = lambda c, w: F.contains(c, F.lit(w))
    n = lambda c: F.size(F.split(c, "\n"))
    lines = F.concat(F.lit("Changed line count: "), n(a).cast("string"), F.lit(" -> "), n(b).cast("string"))
    told = [
        F.when(has(b, "from manim import") & ~has(a, "from manim import"), "Added missing imports"),
        F.when(n(a) != n(b), lines),
        *[F.when(has(a, old) & has(b, new) & ~has(b, old), f"Replaced {old} with {new}") for old, new in REPLACED],
    ]
    found = F.array_compact(F.array(*told))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("Made subtle modifications")))


def fix_confidence(fixes: Column, syntax: Column, other: Column, boosts: list[tuple[str, float]]) -> Column:
    """0.5, plus each kind's boost once, plus 0.1 for two critical kinds, minus the issues left; a fix counts for the first kind it names."""
    score, critical = F.lit(0.5), F.lit(0)
    for k, (word, boost) in enumerate(boosts):
        names = _names(word, [earlier for earlier, _ in boosts[:k]])
        has = F.exists(fixes, names)
        score = score + F.when(has, boost).otherwise(0.0)
        if word in ("import", "CONFIG", "animation", "class"):
            critical = critical + has.cast("int")
    score = score + F.when(critical >= 2, 0.1).otherwise(0.0) - F.lit(0.4) * syntax - F.lit(0.05) * other
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def _names(word: str, before: list[str]):
    """A condition on a fix: it names the word and none of those before."""

    def test(f: Column) -> Column:
        found = F.contains(F.lower(f), F.lit(word.lower()))
        for earlier in before:
            found = found & ~F.contains(F.lower(f), F.lit(earlier.lower()))
        return found

    return test


def diff_details(a: Column, b: Column) -> list[Column]:
    """lines_added, lines_removed (distinct), imports_changed, methods_changed, classes_changed."""
    n = lambda c, w: F.regexp_count(c, F.lit(rf"{w} \w+"))
    has = lambda c: F.contains(c, F.lit("from manim import"))
    added, removed, _ = diff_stats(a, b)
    return [
        added.alias("lines_added"),
        removed.alias("lines_removed"),
        (has(a) != has(b)).alias("imports_changed"),
        F.abs(n(b, "def") - n(a, "def")).cast("long").alias("methods_changed"),
        F.abs(n(b, "class") - n(a, "class")).cast("long").alias("classes_changed"),
    ]


#: Words on a line that make a variable in Tex look like a formula. Fixed values.
_INDICATORS = ["frac", "zip", "for", "in"]


def tex_advice(df: DataFrame, code: str, marks: list[str]) -> DataFrame:
    """df without code, with line, kind and content of calls of Tex that a person should look at: nothing is rewritten.

    math_in_tex: a string with one of the marks of mathematics; variable_in_tex: a variable on a line that looks like a formula's. Lines count
    from 1.
    """
    kept = [c for c in df.columns if c not in (code, "line", "kind", "content")]
    lines = df.select(*kept, F.posexplode(F.split(code, "\n")).alias("line", "_text")).withColumn("line", F.col("line") + 1)
    text = F.col("_text")
    string, name = F.regexp_extract(text, r"""\bTex\s*\(\s*r?(['"])([^'"]*)\1\s*\)""", 2), F.regexp_extract(text, r"\bTex\s*\(\s*([A-Za-z_]\w*)\s*\)", 1)
    some = lambda c, words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(c, w))
    kind = F.when((string != "") & some(string, marks), "math_in_tex").when((name != "") & some(text, _INDICATORS), "variable_in_tex")
    return lines.select(*kept, "line", kind.alias("kind"), F.when(kind == "math_in_tex", string).otherwise(name).alias("content")).where("kind IS NOT NULL")
