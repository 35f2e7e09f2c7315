"""Prompts: templates filled from columns, and made better by what has worked before.

What has worked is a table of counts (terms, solutions), joined to the rows that ask; nothing is learned row by row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What is said in front of what was learned.
_INSIGHTS = "\n\nLEARNED INSIGHTS:\n"
_PRIORITIZE = "Prioritize searching for these terms that have worked well: "
_WARNINGS = "\n\nIMPORTANT WARNINGS:\n"
_MANY_FILES = "Multiple files detected. Pay special attention to import resolution."
_LARGE_FILE = "Large file detected. Consider breaking into logical chunks."
_SOLUTIONS = "\n\nLEARNED SOLUTIONS:\n"
#: Terms that are kept, and those of them that a prompt names.
TERMS, NAMED = 5, 3


def filled(template: str, **values: Column) -> Column:
    """The template with each {name} replaced by a column's value, in one pass from left to right; null counts as unknown."""
    parts, at = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m[1] in values:
            parts += [F.lit(template[at : m.start()]), F.coalesce(values[m[1]].cast("string"), F.lit("unknown"))]
            at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def ranked_terms(asked: DataFrame, history: DataFrame) -> DataFrame:
    """(key, terms): the terms of each key that worked best, best first.

    asked: (key, term), each pair once. history: (term, ok, bad), each term once. A term works as often as its share of ok, an unknown one
    half the time; ties go by the term.
    """
    total = F.coalesce("ok", F.lit(0)) + F.coalesce("bad", F.lit(0))
    rate = F.when(total > 0, F.col("ok") / total).otherwise(0.5)
    scored = asked.join(history.where("ok + bad > 0"), "term", "left").select("key", "term", rate.alias("rate"))
    best = Window.partitionBy("key").orderBy(F.desc("rate"), "term")
    top = scored.withColumn("r", F.row_number().over(best)).where(F.col("r") <= TERMS)
    return top.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "term"))), lambda x: x["term"]).alias("terms"))


def matching_prompt(base: Column, terms: Column) -> Column:
    """The base with the terms that worked best, if there are any."""
    named = F.array_join(F.slice(terms, 1, NAMED), ", ")
    return F.when(F.size(F.coalesce(terms, F.array().cast("array<string>"))) > 0, F.concat(base, F.lit(_INSIGHTS + _PRIORITIZE), named)).otherwise(base)


def cleaning_prompt(base: Column, files: Column, largest: Column) -> Column:
    """The base with warnings of many or large files."""
    warnings = F.array_compact(F.array(F.when(files > 10, _MANY_FILES), F.when(largest > 10_000, _LARGE_FILE)))
    return F.when(F.size(warnings) > 0, F.concat(base, F.lit(_WARNINGS), F.array_join(warnings, "\n"))).otherwise(base)


def timeout_class(size: Column) -> Column:
    """small, medium or large, by which time limits are stretched."""
    return F.when(size < 5000, "small").when(size < 20_000, "medium").otherwise("large")


def best_solutions(solutions: DataFrame) -> DataFrame:
    """(category, solution, worked): of (category, solution, worked) the one that worked most often; ties go by the text."""
    best = F.max_by(F.struct("solution", "worked"), F.struct("worked", "solution"))
    return solutions.groupBy("category").agg(best.alias("s")).select("category", "s.solution", "s.worked")


def fixing_prompt(base: Column, attempt: Column, solution: Column, worked: Column) -> Column:
    """The base with the known solution of the error's category, at the first attempt."""
    known = F.concat(F.lit(_SOLUTIONS + "KNOWN SOLUTION (worked "), worked.cast("string"), F.lit(" times):\n"), solution)
    return F.when((attempt == 1) & solution.isNotNull(), F.concat(base, known)).otherwise(base)
