"""The registry of queries: name -> (Spark callable, DuckDB SQL)."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.session import TABLES, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function over (spark, sf_dir) under a name, with its oracle SQL if there is one."""

    def add(f):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def sql_query(name: str, text: str, duck: str | None = None) -> None:
    """Register a query written in SQL over tables in braces, as {documents}.

    The oracle is duck, else the same text: there R'...' literals lose their prefix and /*g*/ becomes the flag that
    makes DuckDB's regexp_replace replace all.
    """
    used = [t for t in TABLES if "{" + t + "}" in text]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})

    other = duck or re.sub(r"(?<=[\s,(])R'", "'", text).replace("/*g*/", ", 'g'")
    for t in TABLES:
        other = other.replace("{" + t + "}", t)
    query(name, other)(run)


def load() -> None:
    """Import every module of plans, which registers its queries."""
    from siltstone.plans import (  # noqa: F401
        audit,
        catalogue,
        code,
        dedup,
        history,
        metrics,
        more,
        relational,
        rules,
        sources,
        text,
    )


load()
