"""Scalar functions over text columns, all of them built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.rules import STDLIB, THIRD_PARTY


def title(slug: Column) -> Column:
    """Words of a slug with capitals; hyphens become spaces first."""
    return F.initcap(F.replace(slug, F.lit("-"), F.lit(" ")))


def file_name(text: Column, most: int = 50) -> Column:
    """Letters, digits, _ and -, runs of space and - as one _, none at the ends, lower case, cut to most characters."""
    kept = F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\p{N}_\s-]", ""), r"[-\s]+", "_")
    return F.lower(F.regexp_replace(F.left(F.regexp_replace(kept, "^_+|_+$", ""), F.lit(most)), "_+$", ""))


def terms(text: Column, words: list[str]) -> Column:
    """array<string> of distinct lower-cased CamelCase words and words of the list."""
    camel = F.regexp_extract_all(text, F.lit(r"\b[A-Z][a-z]+(?:[A-Z][a-z]+)+\b"), F.lit(0))
    known = F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w.isin(words))
    return F.array_distinct(F.concat(F.transform(camel, F.lower), known))


def line_issues(df: DataFrame, key: str = "doc_id", text: str = "text", most: int = 120) -> DataFrame:
    """(key, line, kind): long lines, comments and blank lines, numbered from 0."""
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("line", "s"))
    kinds = F.array_compact(
        F.array(
            F.when(F.length("s") > most, "long"),
            F.when(F.contains("s", F.lit("#")), "comment"),
            F.when(F.col("s") == "", "blank"),
        )
    )
    return lines.select(key, F.col("line").cast("long").alias("line"), F.explode(kinds).alias("kind"))


def import_kind(line: Column) -> tuple[Column, Column]:
    """(priority, category) of an import line."""
    module = F.split_part(F.split_part(F.trim(line), F.lit(" "), F.lit(2)), F.lit("."), F.lit(1))
    third = F.lit(False)
    for m in THIRD_PARTY:
        third = third | F.contains(line, F.lit(m))
    kinds = [(module.isin(STDLIB), 0, "stdlib"), (third, 1, "third_party"), (F.contains(line, F.lit("manim")), 2, "manim")]
    priority, category = F.lit(3), F.lit("local")
    for condition, p, c in reversed(kinds):
        priority, category = F.when(condition, p).otherwise(priority), F.when(condition, c).otherwise(category)
    return priority, category


def without_imports(text: Column) -> Column:
    """The lines that are no imports."""
    imports = lambda l: F.startswith(F.ltrim(l), F.lit("import ")) | F.startswith(F.ltrim(l), F.lit("from "))
    return F.array_join(F.filter(F.split(text, "\n"), lambda l: ~imports(l)), "\n")


def text_metrics(text: Column) -> dict[str, Column]:
    """Lines, size, and how often a source animates, writes formulas, makes objects; complexity by lines."""
    n = lambda p: F.regexp_count(text, F.lit(p)).cast("long")
    lines = F.size(F.split(text, "\n"))
    return {
        "lines": lines.cast("long"),
        "size_kb": F.round(F.length(text).cast("double") / 1024, 2),
        "animations": n(r"\.animate\(|\.play\(|self\.play\("),
        "tex_objects": n(r"(?:Tex|MathTex|Text)\s*\("),
        "mobjects": n(r"(?:Circle|Square|Dot|Arrow|Line|Rectangle|Polygon)\s*\("),
        "complexity": F.when(lines < 50, "simple").when(lines < 150, "medium").otherwise("complex"),
    }
