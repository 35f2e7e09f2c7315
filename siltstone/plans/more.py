"""Smaller operators of the inventory: lookups, normalisers, labels, samples, merges, helpers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from siltstone.plans.dedup import _DUCK_HASH
from siltstone.plans.metrics import _DKEY, _KEY
from siltstone.plans.registry import query, sql_query
from siltstone.plans.rules import _CODE, code_of
from siltstone.session import table
from siltstone.sources.messages import message_sql

sql_query(
    "path_resolution",
    """
    SELECT page_id, CASE WHEN left(p, 1) = '/' THEN p WHEN left(p, 13) = 'data/videos/_' THEN p WHEN left(p, 12) = 'data/videos/' THEN replace(p, 'data/videos/', 'data/videos/_')
        WHEN left(p, 1) = '_' THEN concat('data/videos/', p) ELSE concat('data/videos/_2015/', p) END AS resolved
    FROM (SELECT page_id, concat(CASE page_id % 5 WHEN 0 THEN '/' WHEN 1 THEN 'data/videos/_2016/' WHEN 2 THEN 'data/videos/2016/' WHEN 3 THEN '_2017/' ELSE '' END, 'f', CAST(page_id AS STRING), '.py') AS p FROM {pages})
    """,
)
sql_query(
    "renderable_coalesce",
    """
    SELECT d.doc_id, coalesce(CASE WHEN l.quality = 1 THEN 'snippets' END, CASE WHEN d.n_chars > 1000 THEN 'monolith_new' END, CASE WHEN b.item_id IS NOT NULL THEN 'monolith_old' END, 'none') AS source_kind
    FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id LEFT JOIN {benchmark} b ON d.doc_id = b.item_id
    """,
)
sql_query(
    "binomials",
    """
    SELECT r_regionkey AS k, CAST(CASE r_regionkey WHEN 0 THEN 1 ELSE factorial(10) / (factorial(r_regionkey) * factorial(10 - r_regionkey)) END AS BIGINT) AS choose_10_k,
           round(pow(0.5E0, r_regionkey), 6) AS power FROM {region}
    """,
    "SELECT r_regionkey AS k, (factorial(10) // (factorial(r_regionkey) * factorial(10 - r_regionkey)))::BIGINT AS choose_10_k, round(pow(0.5::DOUBLE, r_regionkey), 6) AS power FROM region",
)


@query(
    "manual_fix_lookup",
    """
    SELECT d.doc_id, coalesce(m.fix, 'none') AS fix FROM documents d LEFT JOIN (SELECT item_id, text AS fix FROM benchmark) m ON d.doc_id = m.item_id
    """,
)
def manual_fix_lookup(spark, sf):
    """The whole fix of each document."""
    fixes = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("fix"))
    return table(spark, sf, "documents").select("doc_id").join(fixes, "doc_id", "left").select("doc_id", F.coalesce("fix", F.lit("none")).alias("fix"))




@query(
    "union_all_sources",
    """
    SELECT kind, count(*) AS n FROM (SELECT 'primary' AS kind, doc_id FROM documents WHERE lang = 'en'
        UNION ALL SELECT 'supporting', doc_id FROM documents WHERE lang IS DISTINCT FROM 'en') GROUP BY kind
    """,
)
def union_all_sources(spark, sf):
    """Documents in English are primary, all others supporting."""
    d = table(spark, sf, "documents")
    side = lambda kind, which: d.where(which).select(F.lit(kind).alias("kind"), "doc_id")
    both = side("primary", "lang <=> 'en'").unionByName(side("supporting", "NOT lang <=> 'en'"))
    return both.groupBy("kind").agg(F.count("*").alias("n"))


sql_query(
    "checkpoint_resume",
    """
    SELECT d.doc_id FROM {documents} d LEFT ANTI JOIN (SELECT doc_id FROM {labels} WHERE quality = 1) done ON d.doc_id = done.doc_id
    """,
    "SELECT d.doc_id FROM documents d ANTI JOIN (SELECT doc_id FROM labels WHERE quality = 1) done ON d.doc_id = done.doc_id",
)
sql_query(
    "issue_severity_counts",
    """
    SELECT concat(severity, ':', kind) AS issue, count(*) AS n FROM (
        SELECT CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'signup' THEN 'warning' ELSE 'info' END AS severity, event_type AS kind FROM {events}) GROUP BY 1
    """,
)


@query(
    "bracket_balance",
    f"SELECT doc_id, (length(code) - length(replace(code, '(', '')) - length(code) + length(replace(code, ')', '')))::BIGINT AS round_open, (length(code) - length(replace(code, '[', '')) - length(code) + length(replace(code, ']', '')))::BIGINT AS square_open FROM {_CODE}",
)
def bracket_balance(spark, sf):
    """Opening less closing brackets."""
    n = lambda c: F.length("code") - F.length(F.replace("code", F.lit(c), F.lit("")))
    return code_of(spark, sf).select("doc_id", (n("(") - n(")")).cast("long").alias("round_open"), (n("[") - n("]")).cast("long").alias("square_open"))


@query(
    "change_labels",
    f"SELECT doc_id, array_to_string([x FOR x IN [CASE WHEN contains(code, 'ShowCreation') THEN 'creation' END, CASE WHEN contains(code, 'TextMobject') THEN 'text' END, CASE WHEN contains(code, 'CONFIG') THEN 'config' END, CASE WHEN contains(code, '.get_') THEN 'getter' END] IF x IS NOT NULL], ',') AS labels FROM {_CODE}",
)
def change_labels(spark, sf):
    """Labels of what a conversion would change."""
    code = F.col("code")
    kinds = (("creation", "ShowCreation"), ("text", "TextMobject"), ("config", "CONFIG"), ("getter", ".get_"))
    return code_of(spark, sf).select("doc_id", F.array_join(F.array_compact(F.array(*[F.when(F.contains(code, F.lit(w)), n) for n, w in kinds])), ",").alias("labels"))


@query(
    "math_content",
    f"SELECT doc_id, contains(code, '$') OR contains(code, '\\frac') OR contains(code, '\\sum') OR contains(code, '^') AS has_math FROM {_CODE} WHERE NOT contains(code, 'http')",
)
def math_content(spark, sf):
    """Literal markers of mathematics, unless the text holds an address."""
    code = F.col("code")
    any_of = F.lit(False)
    for w in ("$", "\\frac", "\\sum", "^"):
        any_of = any_of | F.contains(code, F.lit(w))
    return code_of(spark, sf).where(~F.contains(code, F.lit("http"))).select("doc_id", any_of.alias("has_math"))


@query(
    "dependency_merge",
    "SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_shipmode))), ',') AS modes, count(*) AS n FROM (SELECT l_orderkey, l_returnflag || l_linestatus AS l_shipmode FROM lineitem) GROUP BY l_orderkey",
)
def dependency_merge(spark, sf):
    """Set union of each group's names."""
    d = table(spark, sf, "lineitem").select("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("m"))
    return d.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("m")), ",").alias("modes"), F.count("*").alias("n"))


@query(
    "monolith_assembly",
    "SELECT conv_id, md5(string_agg('# ' || role || chr(10) || text, chr(10) || chr(10) ORDER BY turn)) AS monolith, sum(length(text))::BIGINT AS size FROM conversations GROUP BY conv_id",
)
def monolith_assembly(spark, sf):
    """Snippets of a video in order, joined into one file."""
    from siltstone.sources.sinks import monolith

    c = table(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.lit("# "), "role", F.lit("\n"), "text").alias("text"), F.length("text").alias("size"))
    return monolith(c, "conv_id", "turn", "text", size=F.sum("size")).select("conv_id", F.md5("text").alias("monolith"), "size")


@query(
    "shared_code_factoring",
    "SELECT conv_id, turn, count(*) OVER (PARTITION BY role, text) > 1 AS shared FROM conversations",
)
def shared_code_factoring(spark, sf):
    """Is a whole text also in another place? Counted before the shuffle and joined back, so that hot texts stay spread."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.coalesce(F.md5("text"), F.lit("")).alias("part"))
    n = c.groupBy("role", "part").agg(F.count("*").alias("n"))
    return c.join(n, ["role", "part"]).select("conv_id", "turn", (F.col("n") > 1).alias("shared"))


@query(
    "recovery_fold",
    f"""SELECT event_id, hit AS recovered, md5(CASE WHEN hit THEN 'from manim import *' || chr(10) || code ELSE code END) AS fixed
        FROM (SELECT event_id, 'self.play(Write(x' || event_id || '))' AS code, regexp_matches(m, 'name ''.*'' is not defined') OR regexp_matches(m, 'ImportError.*manim') AS hit
              FROM (SELECT event_id, {message_sql(_DKEY)} AS m FROM events))""",
)
def recovery_fold(spark, sf):
    """A line of code for each event, recovered from the event's message: what the message asks for is done to it."""
    from siltstone.operators import recovery

    e = table(spark, sf, "events").select("event_id", F.expr(message_sql(_KEY)).alias("m"), F.concat(F.lit("self.play(Write(x"), F.col("event_id").cast("string"), F.lit("))")).alias("code"))
    return recovery.with_recovered(e, "code", "m").select("event_id", "recovery.recovered", F.md5("recovery.code").alias("fixed"))


sql_query(
    "term_success_rank",
    """
    SELECT term, ok, bad, round(rate, 6) AS rate, CAST(row_number() OVER (ORDER BY rate DESC, term) AS BIGINT) AS rank FROM (
        SELECT term, ok, bad, CASE WHEN ok + bad = 0 THEN 0.5E0 ELSE CAST(ok AS DOUBLE) / (ok + bad) END AS rate FROM (
            SELECT lower(p_type) AS term, CAST(count_if(p_size > 25) AS BIGINT) AS ok, CAST(count_if(p_size < 10) AS BIGINT) AS bad FROM {part} GROUP BY 1)
        ORDER BY rate DESC, term LIMIT 5)
    """,
)
sql_query(
    "fix_rollup",
    """
    SELECT source, lang, count(*) AS files, CAST(count_if(n_chars > 1000) AS BIGINT) AS fixed, CAST(sum(n_chars) AS BIGINT) AS size
    FROM {documents} GROUP BY ROLLUP (source, lang)
    """,
)
sql_query(
    "comparison_issues",
    """
    SELECT o_orderkey, concat(CASE WHEN n IS NULL THEN 'missing_render;' ELSE '' END, CASE WHEN coalesce(n, 0) < 2 THEN 'few_scenes;' ELSE '' END,
                              CASE WHEN coalesce(late, 0) > 0 THEN 'late_scenes;' ELSE '' END) AS issues
    FROM {orders} LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(CASE WHEN l_discount > 0.08 THEN 1 END) AS late FROM {lineitem} GROUP BY l_orderkey) r
    ON o_orderkey = l_orderkey
    """,
)


def _runtime_counts() -> str:
    from siltstone import rules as R
    from siltstone.plans.rules import _count

    return " + ".join(map(_count, R.RUNTIME))


@query("post_conversion_quality", f"SELECT doc_id, ({_runtime_counts()})::BIGINT AS issues, ({_runtime_counts()}) = 0 AS clean FROM {_CODE}")
def post_conversion_quality(spark, sf):
    """Occurrences of what fails when converted code runs."""
    from siltstone import rules as R
    from siltstone.operators import rules as ops

    return code_of(spark, sf).select("doc_id", ops.occurrences(F.col("code"), R.RUNTIME).alias("issues")).withColumn("clean", F.col("issues") == 0)


@query(
    "simple_include",
    f"""
    SELECT source, video, md5(string_agg(text, chr(10) ORDER BY doc_id)) AS content, count(*) AS files FROM (
        SELECT source, doc_id // 1000 AS video, doc_id, text FROM documents QUALIFY row_number() OVER (PARTITION BY source, doc_id // 1000, {_DUCK_HASH} ORDER BY doc_id) = 1)
    GROUP BY source, video
    """,
)
def simple_include(spark, sf):
    """Whole files of each video (a thousand ids of a source), in order, without those of equal normalised content, as one text."""
    from siltstone.operators.dedup import content_hash, keep_first

    d = table(spark, sf, "documents").select("source", F.expr("doc_id div 1000").alias("video"), "doc_id", F.col("text").alias("part"))
    first = keep_first(d.withColumn("hash", content_hash(F.col("part"))), ["source", "video", "hash"], ["doc_id"])
    parts = F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "part"))), lambda p: p["part"])
    return first.groupBy("source", "video").agg(F.md5(F.array_join(parts, "\n")).alias("content"), F.count("*").alias("files"))
