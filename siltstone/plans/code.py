"""Queries on source code: parsing, scenes, dependencies, validation, conversion, repair and routing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from siltstone.operators import converter, graph, syntax
from siltstone.plans.registry import query
from siltstone.sources import generated as G

_LINES = f"(SELECT *, string_split(code, chr(10)) AS l, ends_with(code, 'Tex(''a''') AS broken FROM {G.SQL})"
_NO_STAR = "regexp_replace(code, 'from star import [*]', 'import nothing')"


def _closed(spark, sf):
    """Modules without their star import, so that what they lack can be told."""
    return G.modules(spark, sf).selectExpr("p_partkey", f"{_NO_STAR} AS code")


@query("syntax_valid", f"SELECT p_partkey, valid FROM {G.DAMAGED_SQL}")
def syntax_valid(spark, sf):
    """Does each source parse?"""
    return syntax.with_facts(G.damaged(spark, sf), "code").select("p_partkey", "facts.valid")


@query(
    "scene_extract",
    f"""
    SELECT p_partkey, 'Part' || p_partkey AS name, contains(code, 'CONFIG = ') AS config, md5(substr(code, strpos(code, 'class Part'))) AS code_md5 FROM {_LINES} WHERE NOT broken
    """,
)
def scene_extract(spark, sf):
    """Scene classes with their code, and whether they have a CONFIG."""
    s = syntax.with_facts(G.sources(spark, sf), "code").select("p_partkey", F.explode("facts.scenes").alias("s"))
    return s.select("p_partkey", "s.name", "s.config", F.md5("s.code").alias("code_md5"))


_NEEDS = [
    ("RATE", "LIMIT"), ("TOTAL", "RATE"), ("TOTAL", "LIMIT"), ("Base{k}", "LIMIT"), ("helper_{k}", "LIMIT"), ("helper_{k}", "TOTAL"), ("helper_{k}", "RATE"),
    ("Part{k}", "Base{k}"), ("Part{k}", "helper_{k}"), ("Part{k}", "LIMIT"), ("Part{k}", "TOTAL"), ("Part{k}", "RATE"),
]
_MORE_NEEDS = [("LEFT", "RIGHT"), ("LEFT", "LEFT"), ("RIGHT", "LEFT"), ("RIGHT", "RIGHT"), ("CALLED", "LIMIT")]


def _needs_sql() -> str:
    row = lambda a, b, when: f"SELECT p_partkey || ':' || {G.module_text(a)} AS src, p_partkey || ':' || {G.module_text(b)} AS dst FROM part WHERE {when}"
    return " UNION ALL ".join([row(*n, "true") for n in _NEEDS] + [row(*n, "p_partkey % 5 = 2") for n in _MORE_NEEDS])


@query("dependency_closure", _needs_sql())
def dependency_closure(spark, sf):
    """What each definition of a module needs, directly or not; some need each other."""
    return graph.closure(syntax.dependency_edges(syntax.with_facts(G.modules(spark, sf), "code"), "p_partkey"))


@query("self_containment", "SELECT p_partkey, 'helper_' || (p_partkey + 1) || ',missing_' || p_partkey || ',ring' AS missing FROM part")
def self_containment(spark, sf):
    """Names that a module uses and nothing in it defines."""
    f = syntax.with_facts(_closed(spark, sf), "code").where("facts.valid and size(facts.undefined) > 0")
    return f.select("p_partkey", F.array_join("facts.undefined", ",").alias("missing"))


@query(
    "code_issues",
    f"""
    WITH v AS (SELECT * FROM {_LINES}), c AS (
        SELECT 'error' AS severity, 'syntax_error' AS type, count(*) FILTER (broken) AS n FROM v
        UNION ALL SELECT 'error', 'invalid_construct', count(*) FILTER (NOT broken AND contains(code, 'construct(self, ')) FROM v
        UNION ALL SELECT 'warning', 'deprecated_config', count(*) FILTER (NOT broken AND contains(code, 'CONFIG = ')) FROM v
        UNION ALL SELECT 'warning', 'undefined_name', 3 * count(*) FROM part)
    SELECT severity, type, n FROM c WHERE n > 0
    """,
)
def code_issues(spark, sf):
    """Issues of all sources and modules by severity and type."""
    code = G.sources(spark, sf).select("code").unionByName(_closed(spark, sf).select("code"))
    i = syntax.with_facts(code, "code").select(F.explode(syntax.issues()).alias("i"))
    return i.groupBy("i.severity", "i.type").agg(F.count("*").alias("n"))


@query(
    "code_convert",
    f"""
    SELECT p_partkey, NOT ends_with(code, 'Tex(''a''') AS valid, CASE WHEN NOT ends_with(code, 'Tex(''a''') THEN len(regexp_extract_all(code, '\\b(TextMobject|TexMobject|ShowCreation)\\b')) END::INTEGER AS renames,
           md5(converted) AS code_md5 FROM {G.SQL}
    """,
)
def code_convert(spark, sf):
    """Sources in the new dialect, with the number of names that changed."""
    c = converter.with_converted(G.sources(spark, sf), "code")
    tree = F.col("converted.way") == "tree"
    return c.select("p_partkey", "converted.valid", F.when(tree, F.coalesce(F.col("converted.changes")["rename"], F.lit(0))).alias("renames"), F.when(tree, F.md5("converted.code")).alias("code_md5"))


@query("code_repair", f"SELECT p_partkey, valid AS valid_before, md5(repaired) AS repaired_md5, mended AS valid_after FROM {G.DAMAGED_SQL}")
def code_repair(spark, sf):
    """Repair of sources that do not parse: the digest of the repaired source, and whether it parses."""
    d = syntax.with_repaired(syntax.with_facts(G.damaged(spark, sf), "code"), "code").withColumnRenamed("facts", "before")
    d = syntax.with_facts(d, "repaired")
    return d.select("p_partkey", F.col("before.valid").alias("valid_before"), F.md5("repaired").alias("repaired_md5"), F.col("facts.valid").alias("valid_after"))


@query(
    "conversion_routing",
    f"SELECT CASE WHEN valid THEN 'systematic_only' WHEN mended THEN 'repaired' WHEN NOT lost THEN 'text_only' ELSE 'failed' END AS method, count(*) AS n FROM {G.DAMAGED_SQL} GROUP BY 1",
)
def conversion_routing(spark, sf):
    """Each source takes the first way that works: its tree, its tree after repair, its text; else it fails."""
    d = converter.with_converted(syntax.with_repaired(G.damaged(spark, sf), "code"), "code")
    d = syntax.with_facts(d, "repaired", "after")
    changed = F.size(F.map_keys("converted.changes")) > 0
    method = F.when(F.col("converted.valid"), "systematic_only").when(F.col("after.valid"), "repaired").when(changed, "text_only").otherwise("failed")
    return d.select(method.alias("method")).groupBy("method").agg(F.count("*").alias("n"))


@query(
    "parameter_scenes",
    f"SELECT p_partkey, 'Part' || p_partkey AS scene, len(string_split(moved, chr(10)))::INTEGER AS lines, true AS valid FROM {G.SQL} WHERE moved IS NOT NULL",
)
def parameter_scenes(spark, sf):
    """Scenes whose construct takes arguments, moved into __init__: the lines of the result, and whether it parses."""

    @F.pandas_udf("string")
    def moved(code: pd.Series, scene: pd.Series) -> pd.Series:
        return pd.Series([syntax.parameterless(c, s) for c, s in zip(code, scene, strict=True)])

    d = syntax.with_facts(G.sources(spark, sf), "code").select("p_partkey", "code", F.explode("facts.scenes").alias("s")).where("s.parameters > 0")
    d = syntax.with_facts(d.select("p_partkey", F.col("s.name").alias("scene"), moved("code", F.col("s.name")).alias("code")), "code")
    return d.select("p_partkey", "scene", F.size(F.split("code", "\n")).alias("lines"), "facts.valid")
