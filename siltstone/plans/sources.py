"""Queries over the sources that the parts make: each operator on code, against SQL that follows the specification."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from siltstone import rules as R
from siltstone.operators import converter, fixer, graph, recovery, snippets, syntax, validators
from siltstone.operators import rules as ops
from siltstone.plans.registry import query
from siltstone.plans.rules import _count, _hit
from siltstone.rules import dialect as D
from siltstone.session import table
from siltstone.sources import generated as G
from siltstone.sources.generated import SQL, sources
from siltstone.sources.samples import quoted

_LINES = f"(SELECT *, string_split(code, chr(10)) AS l FROM {SQL})"
_SCENE_AT = "list_position(list_transform(l, lambda x: starts_with(x, 'class ')), true)"


@query("source_syntax", f"SELECT p_partkey, NOT ends_with(code, 'Tex(''a''') AS valid, CASE WHEN ends_with(code, 'Tex(''a''') THEN false ELSE true END AS converts FROM {SQL}")
def source_syntax(spark, sf):
    """Which sources parse, and which does the tree converter take?"""
    d = converter.with_converted(syntax.with_facts(sources(spark, sf), "code"), "code")
    return d.select("p_partkey", "facts.valid", (F.col("converted.way") == "tree").alias("converts"))


@query("syntax_counts", f"SELECT count(*) FILTER (NOT ends_with(code, 'Tex(''a''')) AS valid, count(*) FILTER (ends_with(code, 'Tex(''a''')) AS invalid FROM {SQL}")
def syntax_counts(spark, sf):
    """How many sources parse."""
    v = syntax.with_facts(sources(spark, sf), "code").select("facts.valid")
    return v.agg(F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("invalid"))


@query(
    "source_scenes",
    f"""SELECT p_partkey, 'Part' || p_partkey AS name, {_SCENE_AT}::INTEGER AS start, len(l)::INTEGER AS "end",
        CASE WHEN contains(code, '(self, rows, cols=2)') THEN 2 ELSE 0 END AS parameters FROM {_LINES} WHERE NOT ends_with(code, 'Tex(''a''')""",
)
def source_scenes(spark, sf):
    """Scene classes, their lines and parameters."""
    s = syntax.with_facts(sources(spark, sf), "code").select("p_partkey", F.explode("facts.scenes").alias("s"))
    return s.select("p_partkey", "s.name", "s.start", "s.end", "s.parameters")


@query(
    "scene_predicates",
    f"""SELECT p_partkey, 'Part' || p_partkey AS name, CASE WHEN NOT broken THEN contains(base, 'Scene') END AS scene_class,
        CASE WHEN NOT broken THEN ends_with(base, 'Scene') END AS inherits, contains(base, 'Scene') AS renderable
        FROM (SELECT *, regexp_extract(code, 'class \\w+\\((\\w+)\\)', 1) AS base, ends_with(code, 'Tex(''a''') AS broken FROM {SQL})""",
)
def scene_predicates(spark, sf):
    """Three notions of a scene class; by text where the source does not parse."""
    return syntax.with_scene_predicates(sources(spark, sf), "code").select("p_partkey", F.inline("predicates"))


@query(
    "source_imports",
    f"""SELECT p_partkey, array_to_string(list_sort(regexp_extract_all(imports, 'from ([\\w.]+) import', 1)), ',') AS star,
        array_to_string(list_sort(list_transform(regexp_extract_all(imports, '(?m)^import (.*)$', 1), lambda x: regexp_replace(x, '.* as ', ''))), ',') AS modules
        FROM {SQL} WHERE NOT ends_with(code, 'Tex(''a''')""",
)
def source_imports(spark, sf):
    """Star imports and bound modules of each source."""
    d = syntax.with_imports(syntax.with_facts(sources(spark, sf), "code").where("facts.valid"), "code")
    return d.select("p_partkey", F.array_join("imported.star", ",").alias("star"), F.array_join("imported.modules", ",").alias("modules"))


@query(
    "star_symbols",
    f"""SELECT p_partkey, count(*) AS symbols, min(symbol) AS first FROM (SELECT p_partkey, unnest(regexp_extract_all(imports, 'from ([\\w.]+) import', 1)) AS module FROM {SQL} WHERE NOT ends_with(code, 'Tex(''a'''))
        JOIN (SELECT DISTINCT 'manimlib' || CASE WHEN p_size % 2 = 0 THEN '' ELSE '.imports' END AS path, p_brand AS symbol FROM part UNION SELECT 'manim_imports_ext', p_type FROM part) i ON i.path = module GROUP BY p_partkey""",
)
def star_symbols(spark, sf):
    """Star imports resolved by a symbol index, which is counted by module before modules are joined by name."""
    from siltstone.session import table

    p = table(spark, sf, "part")
    index = p.select(F.when(F.col("p_size") % 2 == 0, "manimlib").otherwise("manimlib.imports").alias("path"), F.col("p_brand").alias("symbol"))
    index = index.unionByName(p.select(F.lit("manim_imports_ext").alias("path"), F.col("p_type").alias("symbol"))).distinct()
    index = index.groupBy("path").agg(F.count("*").alias("n"), F.min("symbol").alias("least"))
    d = syntax.with_imports(sources(spark, sf), "code").select("p_partkey", F.explode("imported.star").alias("path"))  # none where it does not parse
    return d.join(index, "path").groupBy("p_partkey").agg(F.sum("n").alias("symbols"), F.min("least").alias("first"))


@query(
    "source_closure",
    f"""WITH v AS (SELECT *, contains(code, 'self.add(helper_') AS calls FROM {SQL} WHERE NOT ends_with(code, 'Tex(''a'''))
        SELECT p_partkey || ':helper_' || p_partkey AS src, p_partkey || ':SIZE' AS dst FROM v
        UNION ALL SELECT p_partkey || ':Part' || p_partkey, p_partkey || ':helper_' || p_partkey FROM v WHERE calls
        UNION ALL SELECT p_partkey || ':Part' || p_partkey, p_partkey || ':SIZE' FROM v WHERE calls""",
)
def source_closure(spark, sf):
    """What each definition needs, directly or not."""
    return graph.closure(syntax.dependency_edges(syntax.with_facts(sources(spark, sf), "code"), "p_partkey"))


# Names that the statements use and no source binds; a name counts as a whole word that is neither an attribute nor in a string.
_FREE = ["ApplyMethod", "Axes", "CycloidScene", "Dot", "FRAME_WIDTH", "GRAY", "GraphScene", "ImageMobject", "InteractiveScene", "ShowCreation", "Tex", "obj", "other", "smooth", "string"]


@query(
    "source_undefined",
    f"SELECT p_partkey, array_to_string(list_filter([{', '.join(map(quoted, _FREE))}], lambda w: regexp_matches(code, '(^|[^\\w.])' || w || '\\b')), ',') AS missing FROM {SQL} WHERE NOT ends_with(code, 'Tex(''a''')",
)
def source_undefined(spark, sf):
    """Names that a scene uses and nothing provides."""
    i = validators.with_issues(sources(spark, sf), "code", "scene", once=True).where(~F.exists("issues", lambda x: x["type"] == "syntax_error"))
    found = F.filter("issues", lambda x: x["type"] == "undefined_names")
    names = F.coalesce(F.get(found, F.lit(0))["message"], F.lit(""))
    return i.select("p_partkey", F.replace(F.regexp_replace(names, "^[^:]*: ", ""), F.lit(", "), F.lit(",")).alias("missing"))


def _n(pattern: str) -> str:
    return f"len(regexp_extract_all(code, {quoted(pattern)}))"


_RENDER = {
    ("error", "invalid_import"): _n("from manimlib"),
    ("error", "deprecated_api"): _n(r"\b(TextMobject|TexMobject|ShowCreation)\("),
    ("error", "deprecated_animation"): _n(r"\bShowCreation\("),
    ("warning", "deprecated_method"): _n(r"\.get_width\(\)"),
    ("warning", "deprecated_config"): _n(r"CONFIG = "),
    ("error", "invalid_construct"): _n(r"construct\(self, "),
}
_CONVERT = {("warning", "method_to_property"): _n(r"\.get_width\(\)"), ("warning", "changed_base_class"): _n(r"\((GraphScene|ThreeDScene)\)")}


def _issue_sql(counts: dict[tuple[str, str], str]) -> str:
    each = " UNION ALL ".join(f"SELECT '{s}' AS severity, '{t}' AS type, sum({e})::BIGINT AS n FROM v WHERE NOT broken" for (s, t), e in counts.items())
    return f"WITH v AS (SELECT *, ends_with(code, 'Tex(''a''') AS broken FROM {SQL}), c AS ({each} UNION ALL SELECT 'error', 'syntax_error', count(*) FROM v WHERE broken) SELECT severity, type, n FROM c WHERE n > 0"


def _issue_counts(spark, sf, validator: str):
    i = validators.with_issues(sources(spark, sf), "code", validator, once=True).select(F.explode("issues").alias("i"))
    return i.groupBy("i.severity", "i.type").agg(F.count("*").alias("n"))


@query("render_issues", _issue_sql(_RENDER))
def render_issues(spark, sf):
    """Issues before rendering, by severity and type."""
    return _issue_counts(spark, sf, "before_render")


@query("conversion_issues", _issue_sql(_CONVERT))
def conversion_issues(spark, sf):
    """Issues before conversion, by severity and type."""
    return _issue_counts(spark, sf, "before_conversion")


@query(
    "conversion_confidence",
    f"""SELECT p_partkey, round(CASE WHEN ends_with(code, 'Tex(''a''') THEN 0.25 WHEN w > 0 THEN 0.8 - 0.02 * w ELSE 0.95 END, 6)::DOUBLE AS confidence
        FROM (SELECT *, {' + '.join(_CONVERT.values())} AS w FROM {SQL})""",
)
def conversion_confidence(spark, sf):
    """How sure the conversion of each source is."""
    d = validators.with_issues(sources(spark, sf), "code", "before_conversion")
    return d.select("p_partkey", F.round(validators.confidence(F.col("issues")), 6).alias("confidence"))


@query(
    "directory_validation",
    f"""WITH v AS (SELECT *, ends_with(code, 'Tex(''a''') AS broken FROM {SQL}),
        c AS (SELECT p_partkey, CASE WHEN broken THEN 1 ELSE {' + '.join(e for (s, _), e in _RENDER.items() if s == 'error')} END AS errors,
                     CASE WHEN broken THEN 0 ELSE {' + '.join(e for (s, _), e in _RENDER.items() if s == 'warning')} END AS warnings FROM v)
        SELECT count(*) AS total_files, count(*) FILTER (errors = 0) AS valid_files, count(*) FILTER (errors > 0) AS files_with_errors, count(*) FILTER (warnings > 0) AS files_with_warnings,
               sum(errors)::BIGINT AS total_errors, sum(warnings)::BIGINT AS total_warnings FROM c""",
)
def directory_validation(spark, sf):
    """Six counters over the reports of all sources."""
    n = lambda s: F.size(F.filter("issues", lambda i: i["severity"] == s)).cast("long")
    d = validators.with_issues(sources(spark, sf), "code", "before_render").select(n("error").alias("e"), n("warning").alias("w"))
    return d.agg(
        F.count("*").alias("total_files"),
        F.count_if(F.col("e") == 0).alias("valid_files"),
        F.count_if(F.col("e") > 0).alias("files_with_errors"),
        F.count_if(F.col("w") > 0).alias("files_with_warnings"),
        F.sum("e").alias("total_errors"),
        F.sum("w").alias("total_warnings"),
    )


@query(
    "source_statistics",
    f"""SELECT p_partkey, len(l)::BIGINT AS total_lines, len(list_filter(l, lambda x: trim(x) <> ''))::BIGINT AS non_empty_lines, len(list_filter(l, lambda x: starts_with(trim(x), '#')))::BIGINT AS comment_lines,
        {_n('(?m)^class\\s+\\w+')}::BIGINT AS class_count, {_n('(?m)^def\\s+\\w+')}::BIGINT AS function_count, {_n('class\\s+\\w+\\([^)]*Scene[^)]*\\)')}::BIGINT AS scene_count,
        {_n('self\\.play\\(')}::BIGINT AS animation_count, {_n('\\b(?:' + '|'.join(D.MOBJECTS) + ')\\s*\\(')}::BIGINT AS mobject_count FROM {_LINES}""",
)
def source_statistics(spark, sf):
    """Eight counts of each source."""
    return sources(spark, sf).select("p_partkey", *[c.alias(n) for n, c in validators.statistics(F.col("code")).items()])


@query("source_fixed", f"SELECT p_partkey, md5(fixed) AS fixed, ends_with(code, 'Tex(''a''') AS broken FROM {SQL}")
def source_fixed(spark, sf):
    """Sources after the systematic fixer, and whether a syntax error is left."""
    d = fixer.with_fixed(sources(spark, sf), "code")
    return d.select("p_partkey", F.md5("fixed.code").alias("fixed"), (F.size("fixed.issues") > 0).alias("broken"))


@query("source_converted", f"SELECT p_partkey, md5(converted) AS converted, NOT ends_with(code, 'Tex(''a''') AS valid FROM {SQL}")
def source_converted(spark, sf):
    """Sources after the tree converter; those that do not parse go another way."""
    d = converter.with_converted(sources(spark, sf), "code")
    return d.select("p_partkey", F.when(F.col("converted.way") == "tree", F.md5("converted.code")).alias("converted"), "converted.valid")


@query("text_converted", f"SELECT p_partkey, md5(as_text) AS converted FROM {SQL}")
def text_converted(spark, sf):
    """Sources after the text converter, which needs no tree."""
    @F.pandas_udf("string")
    def run(codes: pd.Series) -> pd.Series:
        return pd.Series([converter.text_convert(c)[0] for c in codes])

    return sources(spark, sf).select("p_partkey", F.md5(run("code")).alias("converted"))


@query(
    "conversion_report",
    f"""SELECT count(*) FILTER (valid) AS ast_parse_successes, count(*) FILTER (NOT valid) AS ast_parse_failures, count(*) AS total_attempts,
        round(count(*) FILTER (valid)::DOUBLE / greatest(count(*), 1), 6) AS success_rate, sum(CASE WHEN valid THEN {_n('\\b(TextMobject|TexMobject|ShowCreation)\\b')} END)::BIGINT AS renames
        FROM (SELECT *, NOT ends_with(code, 'Tex(''a''') AS valid FROM {SQL})""",
)
def conversion_report(spark, sf):
    """Parse statistics and the number of renames of the tree converter."""
    d = converter.with_converted(sources(spark, sf), "code").select((F.col("converted.way") == "tree").alias("ok"), F.col("converted.changes")["rename"].alias("n"))
    rate = F.round(F.count_if("ok").cast("double") / F.greatest(F.count("*"), F.lit(1)), 6)
    return d.agg(
        F.count_if("ok").alias("ast_parse_successes"),
        F.count_if(~F.col("ok")).alias("ast_parse_failures"),
        F.count("*").alias("total_attempts"),
        rate.alias("success_rate"),
        F.sum(F.when(F.col("ok"), F.coalesce("n", F.lit(0)))).alias("renames"),
    )


# Messages that fail with a source, by its key.
FAILURES = [
    "NameError: name 'ShowCreation' is not defined",
    "TypeError: ImageMobject() got an unexpected keyword argument 'invert'",
    "NameError: name 'RED_D' is not defined",
    "AttributeError: module 'string' has no attribute 'letters'",
    "",
]
_MESSAGE = f"CASE p_partkey % {len(FAILURES)} " + " ".join(f"WHEN {n} THEN {quoted(m)}" for n, m in enumerate(FAILURES)) + " END"
_IMPORTED = "imports || chr(10) || 'from manim import *' || substr(code, length(imports) + 1)"
_SHADED = "regexp_replace(regexp_replace(" + _IMPORTED + r", '\bRED_D\b', 'DARK_RED', 'g'), '\bBLUE_C\b', 'BLUE', 'g')"
_RECOVERED = f"""CASE p_partkey % {len(FAILURES)} WHEN 0 THEN regexp_replace({_IMPORTED}, '\\bShowCreation\\b', 'Create', 'g') WHEN 1 THEN replace(code, ', invert=False', '')
    WHEN 2 THEN {_SHADED} WHEN 3 THEN replace(code, 'string.letters', 'string.ascii_letters') ELSE code END"""


@query("source_recovered", f"SELECT p_partkey, md5(fixed_code) AS fixed, fixed_code <> code AS recovered FROM (SELECT p_partkey, code, {_RECOVERED} AS fixed_code FROM {SQL})")
def source_recovered(spark, sf):
    """Sources after recovery from the message that each fails with."""
    d = recovery.with_recovered(sources(spark, sf).withColumn("message", F.expr(_MESSAGE)), "code", "message")
    return d.select("p_partkey", F.md5("recovery.code").alias("fixed"), "recovery.recovered")


@query(
    "recovery_usage",
    f"""WITH r AS (SELECT p_partkey % {len(FAILURES)} AS f, code FROM {SQL}), u AS (
        SELECT 'Missing Manim Import' AS pattern FROM r WHERE f IN (0, 2) UNION ALL SELECT 'ShowCreation deprecated' FROM r WHERE f = 0 AND contains(code, 'ShowCreation')
        UNION ALL SELECT 'Invalid ImageMobject invert' FROM r WHERE f = 1 AND contains(code, 'invert=') UNION ALL SELECT 'Color variants' FROM r WHERE f = 2 AND (contains(code, 'RED_D') OR contains(code, 'BLUE_C'))
        UNION ALL SELECT 'Python 2 string.letters' FROM r WHERE f = 3 AND contains(code, 'string.letters'))
        SELECT pattern, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, pattern) AS rank FROM u GROUP BY pattern QUALIFY rank <= 5""",
)
def recovery_usage(spark, sf):
    """The five patterns that changed most sources."""
    from pyspark.sql import Window

    d = recovery.with_recovered(sources(spark, sf).withColumn("message", F.expr(_MESSAGE)), "code", "message")
    n = d.select(F.explode("recovery.changes").alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n"))  # a row a pattern
    return n.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "pattern")).cast("long")).where("rank <= 5")


@query(
    "auto_fixed",
    f"""SELECT p_partkey, md5(c) AS fixed FROM (SELECT p_partkey, CASE WHEN ends_with(code, 'Tex(''a''') THEN grey ELSE regexp_replace(regexp_replace(regexp_replace(regexp_replace(grey,
            '\\bShowCreation\\b', 'Create', 'g'), '\\bTextMobject\\b', 'Text', 'g'), '\\bTexMobject\\b', 'MathTex', 'g'), '(?m)^from manimlib[\\w.]* import .*$', 'from manim import *', 'g') END AS c
        FROM (SELECT p_partkey, code, replace(replace(replace(code, 'from manim_imports_ext import', 'from manim import'), '(CycloidScene):', '(Scene):'), 'GRAY', 'GREY') AS grey FROM {SQL}))""",
)
def auto_fixed(spark, sf):
    """Sources after the fixes that the issues before rendering allow."""
    return validators.with_auto_fix(sources(spark, sf), "code").select("p_partkey", F.md5("auto.code").alias("fixed"))


_WORST = "greatest(0, " + ", ".join(f"CASE WHEN {_hit(r)} THEN {R.LEVELS.index(r.level)} ELSE 0 END" for r in R.UNFIXABLE) + ")"
_FOUND = "array_to_string([x FOR x IN [" + ", ".join(f"CASE WHEN {_hit(r)} THEN {quoted(r.category + ': ' + r.explanation)} END" for r in R.UNFIXABLE)
_FOUND += ", CASE WHEN ends_with(code, 'Tex(''a''') THEN 'syntax_error: Code has syntax errors but may be fixable' END] IF x IS NOT NULL], '; ')"


@query("unfixable_report", f"SELECT p_partkey, CASE {_WORST} WHEN 2 THEN 'definitely_unfixable' WHEN 1 THEN 'likely_unfixable' ELSE 'fixable' END AS level, {_FOUND} AS issues FROM {SQL}")
def unfixable_report(spark, sf):
    """The worst level and the explained issues of each source: patterns, CONFIG in the tree, corruption where there is no tree."""
    d = syntax.with_facts(sources(spark, sf), "code")
    code = F.col("code")
    corrupt = ops.corrupted(code) & ~F.col("facts.valid")
    explained = ops.explained(code, R.UNFIXABLE)
    tree = F.transform(F.filter("facts.scenes", lambda s: s["complex_config"]), lambda s: F.lit("complex_config: CONFIG contains complex initialization requiring manual conversion"))
    last = F.when(corrupt, F.array(F.lit("syntax_corruption: Code appears to be corrupted beyond repair"))).when(
        ~F.col("facts.valid"), F.array(F.lit("syntax_error: Code has syntax errors but may be fixable"))
    )
    all_issues = F.concat(explained, tree, F.coalesce(last, F.array().cast("array<string>")))
    level = F.when(corrupt, R.LEVELS[2]).otherwise(ops.worst_level(code, R.UNFIXABLE, R.LEVELS))
    return d.select("p_partkey", level.alias("level"), F.array_join(all_issues, "; ").alias("issues"))


_CATEGORY = " UNION ALL ".join(f"SELECT '{r.category}' AS category FROM {SQL} WHERE {_hit(r)}" for r in R.UNFIXABLE)


@query("unfixable_categories", f"SELECT category, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, category) AS rank FROM ({_CATEGORY}) GROUP BY category QUALIFY rank <= 5")
def unfixable_categories(spark, sf):
    """The five categories that most patterns were found of."""
    from pyspark.sql import Window

    names = {r.name: r.category for r in R.UNFIXABLE}
    e = ops.exploded(sources(spark, sf), "p_partkey", F.col("code"), R.UNFIXABLE)
    n = e.groupBy("rule").agg(F.count("*").alias("n"))  # a row a rule
    n = n.replace(names, subset=["rule"]).groupBy(F.col("rule").alias("category")).agg(F.sum("n").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "category")).cast("long")).where("rank <= 5")


_COMPLEX = " + ".join(f"{_count(r)} * {int(r.weight)}" for r in R.COMPLEXITY) + " + len(string_split(code, chr(10))) // 50"
_PROBLEMS = " + ".join(_count(r) for r in R.PROBLEMATIC)
_KINDS = " + ".join(f"CASE WHEN {_count(r)} > 0 THEN 1 ELSE 0 END" for r in R.PROBLEMATIC)


@query(
    "validation_before",
    f"""SELECT p_partkey, round(c, 6)::DOUBLE AS confidence, issues = 0 AS is_valid, c < 0.6 OR (x > 8 AND issues > 0) OR (issues > 0 AND c < 0.8) AS use_fallback FROM (
        SELECT p_partkey, x, broken + kinds AS issues, CASE WHEN broken = 1 THEN 0.3 ELSE 1.0 END * CASE WHEN p > 0 THEN greatest(0.2, 1.0 - 0.1 * p) ELSE 1.0 END
               * CASE WHEN x > 10 THEN 0.8 WHEN x > 5 THEN 0.9 ELSE 1.0 END * CASE WHEN contains(code, 'def construct(self)') THEN 1.0 ELSE 0.95 END AS c
        FROM (SELECT *, CASE WHEN ends_with(code, 'Tex(''a''') THEN 1 ELSE 0 END AS broken, {_PROBLEMS} AS p, {_KINDS} AS kinds, {_COMPLEX} AS x FROM {SQL}))""",
)
def validation_before(spark, sf):
    """Confidence in a source before conversion from five factors: syntax, imports, damage, complexity, structure."""
    d = syntax.with_facts(sources(spark, sf), "code").withColumn("name", F.concat(F.lit("Part"), F.col("p_partkey").cast("string")))
    return ops.confidence_before(d, "code", "facts.valid", "name", R.PROBLEMATIC, R.COMPLEXITY).select("p_partkey", F.round("confidence", 6).alias("confidence"), "is_valid", "use_fallback")


_AFTER_RUNTIME = " + ".join(_count(r) for r in R.RUNTIME)


@query(
    "validation_after",
    f"""SELECT p_partkey, round(c, 6)::DOUBLE AS confidence, c < 0.6 OR r > 3 AS use_fallback FROM (
        SELECT p_partkey, r, CASE WHEN r > 0 THEN greatest(0.1, 1.0 - 0.2 * r) ELSE 1.0 END * CASE WHEN regexp_matches(code, '\\((Scene|ThreeDScene|MovingCameraScene)\\):') THEN 1.0 ELSE 0.8 END AS c
        FROM (SELECT p_partkey, code, {_AFTER_RUNTIME} AS r FROM (SELECT p_partkey, converted AS code FROM {SQL} WHERE converted IS NOT NULL)))
        UNION ALL SELECT p_partkey, 0.0::DOUBLE, true FROM {SQL} WHERE converted IS NULL""",
)
def validation_after(spark, sf):
    """Confidence in converted sources from five factors: syntax, what fails at run time, compilation, imports, the scene's base."""
    d = converter.with_converted(sources(spark, sf), "code").withColumn("name", F.concat(F.lit("Part"), F.col("p_partkey").cast("string")))
    d = d.select("p_partkey", "name", F.col("converted.code").alias("code"), F.col("converted.valid").alias("valid"))
    return ops.confidence_after(d, "code", "valid", "name", R.RUNTIME).select("p_partkey", F.round("confidence", 6).alias("confidence"), "use_fallback")


@query(
    "scene_states",
    f"""SELECT state, count(*) AS n FROM (SELECT CASE WHEN ends_with(code, 'Tex(''a''') THEN 'skipped_low_confidence' WHEN contains(code, '(self, rows, cols=2)') THEN 'failed'
        ELSE 'systematic_only' END AS state FROM {SQL}) GROUP BY state""",
)
def scene_states(spark, sf):
    """Where each source ends: too large, too unsure, converted and ready to render, recovered, or failed."""
    d = validators.with_issues(sources(spark, sf), "code", "before_conversion", "before")
    d = converter.with_converted(d, "code")
    d = validators.with_issues(d.withColumn("after", F.col("converted.code")), "after", "before_render", "rest")
    d = validators.with_auto_fix(d, "after")
    d = validators.with_issues(d.withColumn("again", F.col("auto.code")), "again", "before_render", "rest_again")
    errors = lambda c: F.size(F.filter(c, lambda i: i["severity"] == "error"))
    state = (
        F.when(F.size(F.split("code", "\n")) > 1000, "skipped_too_large")
        .when(validators.confidence(F.col("before")) < 0.4, "skipped_low_confidence")
        .when(errors("rest") == 0, "systematic_only")
        .when(errors("rest_again") == 0, "recovered")
        .otherwise("failed")
    )
    return d.select(state.alias("state")).groupBy("state").agg(F.count("*").alias("n"))


@query(
    "scene_files",
    f"""SELECT p_partkey, md5(replace(imports, chr(10), chr(10) || chr(10)) || chr(10) || chr(10) || CASE WHEN contains(code, 'self.add(helper_') THEN 'SIZE = ' || p_size || chr(10) || chr(10) || 'def helper_' || p_partkey
        || '(x):' || chr(10) || '    return x * SIZE' || chr(10) || chr(10) ELSE '' END || substr(code, position('class Part' IN code))) AS file FROM {SQL} WHERE NOT ends_with(code, 'Tex(''a''')""",
)
def scene_files(spark, sf):
    """Each scene as a file of its own, with what it needs."""
    d = snippets.with_scene_files(sources(spark, sf), "code").select("p_partkey", F.explode("files").alias("f"))
    return d.select("p_partkey", F.md5("f.file").alias("file"))


_VIDEO = "p_partkey // 10 AS video"


@query(
    "snippet_combine",
    f"""WITH s AS (SELECT {_VIDEO}, * FROM {SQL}),
        i AS (SELECT video, string_agg(line, chr(10) || chr(10) ORDER BY line) AS t FROM (SELECT DISTINCT video, unnest(regexp_extract_all(imports, '(?m)^import .*$')) AS line FROM s) GROUP BY video),
        c AS (SELECT video, 'SIZE = ' || min_by(p_size, p_partkey) AS t, string_agg('def helper_' || p_partkey || '(x):' || chr(10) || '    return x * SIZE', chr(10) || chr(10) ORDER BY p_partkey) AS f,
                     string_agg(substr(code, position('class Part' IN code)), chr(10) || chr(10) ORDER BY 'Part' || p_partkey) AS x, count(*) AS scenes FROM s GROUP BY video)
        SELECT video, md5('from manim import *' || chr(10) || chr(10) || coalesce(i.t || chr(10) || chr(10), '') || c.t || chr(10) || chr(10) || f || chr(10) || chr(10) || x) AS text, scenes
        FROM c LEFT JOIN i USING (video)""",
)
def snippet_combine(spark, sf):
    """The sources of ten parts as one, without repeated imports and constants."""
    d = sources(spark, sf).withColumn("video", F.expr("p_partkey div 10"))
    return snippets.combine(d, "video", "p_partkey", "code").select("video", F.md5("text").alias("text"), "scenes")


@query(
    "fix_details",
    f"""SELECT p_partkey, contains(code, 'GRAY') OR contains(code, 'BLUE_C') OR contains(code, 'RED_D') AS colors, contains(code, 'cv2') AS removed_import, contains(code, '(CycloidScene)') AS new_base FROM {SQL}""",
)
def fix_details(spark, sf):
    """Which kinds of fixes each source needed."""
    f = F.col("fixed.fixes")
    some = lambda w: F.exists(f, lambda x: F.startswith(x, F.lit(w)))
    d = fixer.with_fixed(sources(spark, sf), "code")
    return d.select("p_partkey", some("Converted color").alias("colors"), some("Removed problematic import").alias("removed_import"), some("Changed Part").alias("new_base"))


@query(
    "change_summary",
    f"""SELECT p_partkey, array_to_string([x FOR x IN [CASE WHEN NOT contains(code, 'from manim import') THEN 'Added missing imports' END,
        CASE WHEN len(string_split(fixed, chr(10))) <> len(string_split(code, chr(10))) THEN 'Changed line count: ' || len(string_split(code, chr(10))) || ' -> ' || len(string_split(fixed, chr(10))) END,
        CASE WHEN contains(code, 'ShowCreation') THEN 'Replaced ShowCreation with Create' END, CASE WHEN contains(code, 'TextMobject') THEN 'Replaced TextMobject with Text' END,
        CASE WHEN contains(code, 'TexMobject') THEN 'Replaced TexMobject with MathTex' END, CASE WHEN contains(code, 'get_width()') THEN 'Replaced get_width() with .width' END] IF x IS NOT NULL], '; ') AS changes FROM {SQL}""",
)
def change_summary(spark, sf):
    """What the fixer changed, told from the text before and after."""
    from siltstone.operators import rewrite

    d = fixer.with_fixed(sources(spark, sf), "code")
    return d.select("p_partkey", F.array_join(rewrite.change_summary(F.col("code"), F.col("fixed.code")), "; ").alias("changes"))


_RISK = " * ".join(f"CASE WHEN {_hit(r, 'ms')} THEN {1.0 - r.weight!r} ELSE 1.0 END" for r in R.HIGH_RISK)
_AT = {p: " + ".join(f"CASE WHEN {_hit(r, 'ms')} THEN 1 ELSE 0 END" for r in R.HIGH_RISK if r.level == p) for p in ("high", "medium")}
_BROKEN = "ends_with(code, 'Tex(''a''')"


@query(
    "fallback_analysis",
    f"""SELECT p_partkey, round(c * CASE WHEN high >= 2 THEN 0.7 ELSE 1.0 END, 6)::DOUBLE AS adjusted, high > 0 OR c * CASE WHEN high >= 2 THEN 0.7 ELSE 1.0 END < 0.7 OR medium >= 2 AS triggered
        FROM (SELECT p_partkey, 0.9::DOUBLE * CASE WHEN broken = 1 THEN 0.5 ELSE 1.0 END * {_RISK} AS c, {_AT['high']} + broken AS high, {_AT['medium']} AS medium
              FROM (SELECT *, CASE WHEN {_BROKEN} THEN 1 ELSE 0 END AS broken FROM {SQL}))""",
)
def fallback_analysis(spark, sf):
    """Whether a source should go to the fallback: the fixes it needed, its syntax, risky patterns."""
    d = fixer.with_fixed(syntax.with_facts(sources(spark, sf), "code"), "code")
    d = d.select("p_partkey", "code", F.col("facts.valid").alias("valid"), F.size("fixed.fixes").alias("n"), F.lit(0.9).alias("start"))
    return ops.fallback(d, "code", "valid", "n", "start", R.HIGH_RISK).select("p_partkey", F.round("adjusted", 6).alias("adjusted"), "triggered")


# What converted code that parses still fails for.
QUALITY = {
    "mathtex_list_args": r"MathTex\(\s*\[.*\]\s*\)", "tex_list_args": r"Tex\(\s*\[.*\]\s*\)", "missing_constants": r"\b(DL|DR|UL|UR)\b", "points_access_error": r"\.points\[0\]",
    "old_animation_methods": r"\.(get_center|get_width|get_height)\(\)", "vgroup_construction_error": r"VGroup\([^)]*\[.*\][^)]*\)",
}
_QUALITY = ", ".join(f"CASE WHEN {_n(p)} > 0 THEN '{n}: ' || {_n(p)} || ' instances found' END" for n, p in QUALITY.items())


@query(
    "quality_after",
    f"""SELECT p_partkey, array_to_string([x FOR x IN [{_QUALITY}, CASE WHEN {_BROKEN} THEN 'Compilation error' END] IF x IS NOT NULL], '; ') AS issues
        FROM (SELECT p_partkey, fixed AS code FROM {SQL})""",
)
def quality_after(spark, sf):
    """What is left in fixed sources that fails when they run, and whether they compile."""
    d = fixer.with_fixed(sources(spark, sf), "code").select("p_partkey", F.col("fixed.code").alias("code"))
    d = syntax.with_facts(d, "code")
    n = lambda p: F.regexp_count("code", F.lit(p))
    told = [F.when(n(p) > 0, F.concat(F.lit(f"{name}: "), n(p).cast("string"), F.lit(" instances found"))) for name, p in QUALITY.items()]
    return d.select("p_partkey", F.array_join(F.array_compact(F.array(*told, F.when(~F.col("facts.valid"), "Compilation error"))), "; ").alias("issues"))


_REMOVED = [*D.REMOVED_CLASSES, *D.REMOVED_API_METHODS, *D.REMOVED_METHODS]


def _among(names: list[str]) -> str:
    found = "list_distinct(regexp_extract_all(code, '[A-Za-z_][A-Za-z_0-9]*'))"
    return f"array_to_string(list_sort(list_filter({found}, lambda x: x IN ({', '.join(map(quoted, names))}))), ',')"


@query("api_names", f"SELECT p_partkey, {_among(_REMOVED)} AS removed, {_among(D.NOW_PROPERTIES)} AS properties, {_among(list(D.DEPRECATED))} AS deprecated FROM {SQL}")
def api_names(spark, sf):
    """Names of a source that are gone, properties now, or deprecated, by the tables of the library."""
    names = F.array_distinct(F.regexp_extract_all("code", F.lit("[A-Za-z_][A-Za-z_0-9]*"), F.lit(0)))
    among = lambda known: F.array_join(F.array_sort(F.filter(names, lambda x: x.isin(known))), ",")
    return sources(spark, sf).select("p_partkey", among(_REMOVED).alias("removed"), among(D.NOW_PROPERTIES).alias("properties"), among(list(D.DEPRECATED)).alias("deprecated"))


@query(
    "text_metrics",
    rf"""SELECT p_partkey, len(l)::BIGINT AS lines, round(length(code)::DOUBLE / 1024, 2) AS size_kb, {_n(r'\.animate\(|\.play\(|self\.play\(')}::BIGINT AS animations, {_n(r'(?:Tex|MathTex|Text)\s*\(')}::BIGINT AS tex_objects,
        {_n(r'(?:Circle|Square|Dot|Arrow|Line|Rectangle|Polygon)\s*\(')}::BIGINT AS mobjects, CASE WHEN len(l) < 50 THEN 'simple' WHEN len(l) < 150 THEN 'medium' ELSE 'complex' END AS complexity FROM {_LINES}""",
)
def text_metrics(spark, sf):
    """Lines, size, animations, formulas and objects of each source."""
    from siltstone.functions import text as fn

    return sources(spark, sf).select("p_partkey", *[c.alias(n) for n, c in fn.text_metrics(F.col("code")).items()])


@query(
    "import_remainder",
    f"""SELECT p_partkey, array_to_string(list_filter(l, lambda x: regexp_matches(x, '^ *(import|from) ')), ';') AS imports,
        md5(array_to_string(list_filter(l, lambda x: NOT regexp_matches(x, '^ *(import|from) ')), chr(10))) AS remainder FROM {_LINES}""",
)
def import_remainder(spark, sf):
    """Import statements of each source, and the rest of its text."""
    from siltstone.functions import text as fn

    d = snippets.with_blocks(sources(spark, sf), "code")
    imports = F.transform(F.filter("blocks", lambda b: b["kind"] == "import"), lambda b: b["text"])
    return d.select("p_partkey", F.array_join(imports, ";").alias("imports"), F.md5(fn.without_imports(F.col("code"))).alias("remainder"))


_SET = "list_distinct(string_split({}, chr(10)))"


@query(
    "diff_details",
    rf"""SELECT p_partkey, len(list_filter({_SET.format('fixed')}, lambda x: NOT list_contains(string_split(code, chr(10)), x)))::BIGINT AS lines_added,
        len(list_filter({_SET.format('code')}, lambda x: NOT list_contains(string_split(fixed, chr(10)), x)))::BIGINT AS lines_removed, contains(code, 'from manim import') <> contains(fixed, 'from manim import') AS imports_changed,
        abs(len(regexp_extract_all(fixed, 'def \w+')) - len(regexp_extract_all(code, 'def \w+')))::BIGINT AS methods_changed,
        abs(len(regexp_extract_all(fixed, 'class \w+')) - len(regexp_extract_all(code, 'class \w+')))::BIGINT AS classes_changed FROM {SQL}""",
)
def diff_details(spark, sf):
    """What differs between a source and its fixed form."""
    from siltstone.operators import rewrite

    d = fixer.with_fixed(sources(spark, sf), "code")
    return d.select("p_partkey", *rewrite.diff_details(F.col("code"), F.col("fixed.code")))


@query(
    "snippet_fixes",
    rf"""SELECT p_partkey, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(code, '\bDL\b', '(DOWN + LEFT)', 'g'), '\bShowCreation\b', 'Create', 'g'), '(\w+)\.points\[0\]', '\1.get_start()', 'g'),
        '\bVGroup\(\[([^\[\]]*)\]\)', 'VGroup(\1)', 'g')) AS fixed FROM {SQL}""",
)
def snippet_fixes(spark, sf):
    """Sources after four families of fixes for snippets that fail when run."""
    from siltstone.operators.repair import fix_snippet

    @F.pandas_udf("string")
    def run(codes: pd.Series) -> pd.Series:
        return pd.Series([fix_snippet(c, ["direction", "animation", "points", "group"])[0] for c in codes])

    return sources(spark, sf).select("p_partkey", F.md5(run("code")).alias("fixed"))


@query(
    "shared_blocks",
    f"""WITH b AS (SELECT {_VIDEO}, unnest(['constant:SIZE', 'function:helper_' || p_partkey, 'scene:Part' || p_partkey]) AS block, contains(code, 'Circle(') AS round FROM {SQL}),
        n AS (SELECT video, block, count(*) AS n FROM b GROUP BY video, block), u AS (SELECT video, bool_or(round) AS uses_circle FROM b GROUP BY video)
        SELECT video, count(*) FILTER (n > 1) AS shared, count(*) FILTER (n = 1) AS single, any_value(uses_circle) AS uses_circle FROM n JOIN u USING (video) GROUP BY video""",
)
def shared_blocks(spark, sf):
    """How many definitions the sources of a video share, and what any of them needs imported, by substrings."""
    d = snippets.with_blocks(sources(spark, sf).withColumn("video", F.expr("p_partkey div 10")), "code")
    named = F.filter("blocks", lambda x: x["kind"].isin("constant", "function", "class", "scene"))
    b = d.select("video", F.contains("code", F.lit("Circle(")).alias("round"), F.explode(named).alias("b"))
    n = b.groupBy("video", "b.kind", "b.name").agg(F.count("*").alias("n"), F.bool_or("round").alias("round"))
    return n.groupBy("video").agg(F.count_if(F.col("n") > 1).alias("shared"), F.count_if(F.col("n") == 1).alias("single"), F.bool_or("round").alias("uses_circle"))


@query(
    "scene_routes",
    f"""SELECT route, count(*) AS n FROM (SELECT CASE WHEN item_id IS NOT NULL THEN 'manual_fix' WHEN {_BROKEN} THEN 'skipped_low_confidence' WHEN contains(code, '(self, rows, cols=2)') THEN 'failed'
        ELSE 'systematic_only' END AS route FROM {SQL} LEFT JOIN (SELECT DISTINCT item_id FROM benchmark) ON item_id = p_partkey) GROUP BY route""",
)
def scene_routes(spark, sf):
    """The way each source takes: a manual fix where a table has one, else skipped, converted or failed."""
    from siltstone.session import table

    manual = table(spark, sf, "benchmark").select(F.col("item_id").alias("p_partkey"), F.lit(True).alias("manual")).distinct()
    d = converter.with_converted(validators.with_issues(sources(spark, sf), "code", "before_conversion", "before"), "code")
    d = validators.with_issues(d.withColumn("after", F.col("converted.code")), "after", "before_render", "rest").join(manual, "p_partkey", "left")
    errors = F.size(F.filter("rest", lambda i: i["severity"] == "error"))
    route = F.when(F.col("manual"), "manual_fix").when(validators.confidence(F.col("before")) < 0.4, "skipped_low_confidence").when(errors == 0, "systematic_only").otherwise("failed")
    return d.select(route.alias("route")).groupBy("route").agg(F.count("*").alias("n"))


@query(
    "constant_order",
    "WITH RECURSIVE d AS (SELECT 0::BIGINT AS node, 0 AS layer UNION ALL SELECT p_partkey, layer + 1 FROM d JOIN part ON p_partkey // 8 = node AND p_partkey > 0) SELECT node, layer::INTEGER AS layer FROM d",
)
def constant_order(spark, sf):
    """Constants in layers, each above what it is made of."""
    from siltstone.session import table

    p = table(spark, sf, "part").select(F.col("p_partkey").alias("node"))
    edges = p.where("node > 0").select(F.col("node").alias("src"), F.expr("node div 8").alias("dst"))
    return graph.layers(p, edges)


@query(
    "vector_helpers",
    """WITH v AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)
        SELECT vec_id, round(sqrt(x * x + y * y + z * z), 6) AS length, round(-y, 6) + 0.0 AS turned_x, round(x, 6) + 0.0 AS turned_y, round(0.75 * x + 0.25 * y, 6) AS mixed, round(3 * 0.25 * 0.25 - 2 * 0.25 * 0.25 * 0.25, 6)::DOUBLE AS rate FROM v""",
)
def vector_helpers(spark, sf):
    """Length, a quarter turn about the third axis, a mixture, and a rate, of the first three components."""
    from siltstone.functions import vectors as V
    from siltstone.session import table

    v = table(spark, sf, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double")).alias("v"))
    axis = F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0))
    v = v.withColumn("t", V.rotated(F.col("v"), F.lit(3.141592653589793 / 2), axis))
    other = F.array(F.get("v", F.lit(1)), F.get("v", F.lit(2)), F.get("v", F.lit(0)))
    zero = lambda c: F.round(c, 6) + F.lit(0.0)
    return v.select(
        "vec_id",
        F.round(V.norm(F.col("v")), 6).alias("length"),
        zero(F.get("t", F.lit(0))).alias("turned_x"),
        zero(F.get("t", F.lit(1))).alias("turned_y"),
        F.round(F.get(V.interpolated(F.col("v"), other, 0.25), F.lit(0)), 6).alias("mixed"),
        F.round(V.smooth(F.lit(0.25)), 6).alias("rate"),
    )


@query(
    "prompt_terms",
    r"""SELECT lang, 'Match these terms first: ' || string_agg(term, ', ' ORDER BY n DESC, term) AS prompt FROM (SELECT lang, term, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS r FROM (
        SELECT lang, term, count(*) AS n FROM (SELECT lang, unnest(list_distinct(list_filter(string_split_regex(lower(text), '[^\p{L}]+'), lambda w: length(w) > 9))) AS term FROM documents) GROUP BY lang, term)) WHERE r <= 5 GROUP BY lang""",
)
def prompt_terms(spark, sf):
    """A prompt for each language, enriched by the long words that most of its documents have."""
    from pyspark.sql import Window

    from siltstone.session import table

    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.length(w) > 9))
    n = table(spark, sf, "documents").select("lang", F.explode(words).alias("term")).groupBy("lang", "term").agg(F.count("*").alias("n"))
    top = n.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "term"))).where("r <= 5")
    terms = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "term"))), lambda x: x["term"]), ", ")
    return top.groupBy("lang").agg(F.concat(F.lit("Match these terms first: "), terms).alias("prompt"))


def _some(*words: str) -> str:
    return "(" + " OR ".join(f"contains(code, {quoted(w)})" for w in words) + ")"


_KINDS_OF_FIXES = {
    "config": (0.15, _some("FRAME_WIDTH")), "property": (0.08, _some("get_width()", "get_num_points()")), "parameter": (0.08, _some("invert=False")),
    "animation": (0.12, _some("ShowCreation")), "class": (0.12, _some("TextMobject", "TexMobject", "(GraphScene)")), "color": (0.04, _some("BLUE_C", "RED_D", "GRAY")),
}


@query(
    "fixer_confidence",
    f"""SELECT p_partkey, round(greatest(0.0, least(1.0, 0.75 + {' + '.join(f'CASE WHEN {c} THEN {b} ELSE 0 END' for b, c in _KINDS_OF_FIXES.values())}
        + CASE WHEN {' OR '.join(_KINDS_OF_FIXES[k][1] for k in ('config', 'animation', 'class'))} THEN 0.1 ELSE 0 END - CASE WHEN {_BROKEN} THEN 0.4 ELSE 0 END)), 6)::DOUBLE AS confidence FROM {SQL}""",
)
def fixer_confidence(spark, sf):
    """How sure the fixer is of each source, by the kinds of fixes that it made and what is left."""
    d = fixer.with_fixed(sources(spark, sf), "code")
    return d.select("p_partkey", F.round("fixed.confidence", 6).alias("confidence"))


@query("parameter_sources", f"SELECT p_partkey, 'Part' || p_partkey AS scene, md5(moved) AS moved, true AS again_none FROM {SQL} WHERE moved IS NOT NULL")
def parameter_sources(spark, sf):
    """Sources whose scene takes arguments, with these moved into __init__; what comes out has nothing left to move."""

    @F.pandas_udf("string")
    def move(codes: pd.Series, scenes: pd.Series) -> pd.Series:
        return pd.Series([syntax.parameterless(c, s) for c, s in zip(codes, scenes, strict=True)], dtype=object)

    d = syntax.with_facts(sources(spark, sf), "code").select("p_partkey", "code", F.explode("facts.scenes").alias("s")).where("s.parameters > 0")
    d = d.select("p_partkey", F.col("s.name").alias("scene"), move("code", F.col("s.name")).alias("moved"))
    return d.select("p_partkey", "scene", F.md5("moved").alias("moved"), move("moved", "scene").isNull().alias("again_none"))


@query(
    "scope_resolution",
    f"""
    WITH stars AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS symbol FROM part)
    SELECT p_partkey, line, name, CASE WHEN level = 'cross_file' AND p_partkey + 1 NOT IN (SELECT p_partkey FROM part) THEN 'unresolved'
        WHEN level = 'star' AND name NOT IN (SELECT symbol FROM stars) THEN 'unresolved' ELSE level END AS level FROM {G.uses_sql()}
    """,
)
def scope_resolution(spark, sf):
    """Where each name that a module reads is found: its scopes, other modules, imports, star imports by an index, builtins."""
    from siltstone.operators import scopes
    from siltstone.session import materialize, table

    words = table(spark, sf, "part").select(F.lit("star").alias("module"), F.explode(F.split("p_name", " ")).alias("symbol")).distinct()
    s = materialize(scopes.with_scopes(G.modules(spark, sf), "p_partkey", "code"), "scopes")
    return scopes.resolve(s, words).withColumnRenamed("key", "p_partkey")


@query(
    "constant_values",
    """
    SELECT p_partkey, 'LIMIT' AS name, '' AS needs, 0 AS layer, 'value' AS state, p_size::VARCHAR AS value, NULL::VARCHAR AS cycle FROM part
    UNION ALL SELECT p_partkey, 'RATE', 'LIMIT', 1, 'value', (2 * p_size + 1)::VARCHAR, NULL FROM part
    UNION ALL SELECT p_partkey, 'TOTAL', 'LIMIT,RATE', 2, 'value', (p_size + 1)::VARCHAR, NULL FROM part
    UNION ALL SELECT p_partkey, 'LEFT', 'RIGHT', NULL, 'cycle', NULL, 'LEFT,RIGHT' FROM part WHERE p_partkey % 5 = 2
    UNION ALL SELECT p_partkey, 'RIGHT', 'LEFT', NULL, 'cycle', NULL, 'LEFT,RIGHT' FROM part WHERE p_partkey % 5 = 2
    UNION ALL SELECT p_partkey, 'CALLED', 'LIMIT', 1, 'computed', NULL, NULL FROM part WHERE p_partkey % 5 = 2
    """,
)
def constant_values(spark, sf):
    """Constants of modules in the order of their needs, with their values, or the cycle that keeps them from one."""
    from siltstone.operators import constants

    m = G.modules(spark, sf).withColumn("code", F.replace("code", F.lit("global TOTAL\n        TOTAL ="), F.lit("t =")))
    d = constants.with_constants(m, "code").select("p_partkey", F.inline("constants"))
    return d.withColumn("needs", F.array_join("needs", ","))


_OWNER = "min(p_partkey) OVER (PARTITION BY p_size)"
_BLOCK = G.module_text("class Base{k}:\n    width = LIMIT\n\n    def grow(self, by):\n        return by + width\n")
_IMPORT = "'from shared_' || o || '_Base' || o || ' import Base' || o || CASE WHEN o = p_partkey THEN '' ELSE ' as Base' || p_partkey END || chr(10)"
_GROUPED = f"(SELECT p_partkey, p_size, {_OWNER} AS o, count(*) OVER (PARTITION BY p_size) AS users, {G.MODULE_TEXT} AS code FROM part)"


@query(
    "shared_factored",
    f"""
    WITH c AS (SELECT *, CASE WHEN users > 1 THEN replace(code, {_BLOCK}, {_IMPORT}) ELSE code END AS after FROM {_GROUPED})
    SELECT p_partkey, md5(after) AS after, length(code) AS chars_before, length(after) AS chars_after, CASE WHEN users > 1 THEN 1 ELSE 0 END AS moved, true AS valid FROM c
    """,
)
def shared_factored(spark, sf):
    """Modules whose shared classes are imported from one place: the code, its size before and after, and whether it parses."""
    from siltstone.operators import shared

    _, out = shared.share(G.modules(spark, sf), "p_partkey", "code")
    out = syntax.with_facts(out, "after")
    return out.select(F.col("key").alias("p_partkey"), F.md5("after").alias("after"), F.length("before").alias("chars_before"), F.length("after").alias("chars_after"), "moved", "facts.valid")


@query(
    "shared_modules",
    f"""
    SELECT DISTINCT 'shared_' || o || '_Base' || o AS module, users, md5('LIMIT = ' || p_size || chr(10) || replace({_BLOCK}, 'Base' || p_partkey, 'Base' || o)) AS text
    FROM {_GROUPED} WHERE users > 1
    """,
)
def shared_modules(spark, sf):
    """The modules that shared classes went into, with the constants they need, and how many import each."""
    from siltstone.operators import shared

    modules, _ = shared.share(G.modules(spark, sf), "p_partkey", "code")
    return modules.select("module", "users", F.md5("text").alias("text"))


# Statements that fail, and as recovery leaves them: what an attempt fails with, the statement, the statement after its fix (None: none).
_TRIES = [
    (None, "w = Circle()", "w = Circle()"),
    ("NameError: name 'ShowCreation' is not defined", "self.play(ShowCreation(Circle()))", "self.play(Create(Circle()))"),
    ("NameError: name 'RED_D' is not defined", "v = RED_D", "v = DARK_RED"),
    ("TypeError: ImageMobject() got an unexpected keyword argument 'invert'", "im = ImageMobject('f', invert=False)", "im = ImageMobject('f')"),
    ("NameError: name 'unknowable' is not defined", "q = unknowable + {k}", None),
]


def _try_text(first: int, second: int) -> str:
    return "from manim import *\n\nclass Part{k}(Scene):\n    def construct(self):\n        " + f"{_TRIES[first][1]}\n        {_TRIES[second][1]}\n"


_PICKS = [(a, b) for a in range(len(_TRIES)) for b in range(len(_TRIES))]
_PICK = f"(p_partkey * 7 + p_size) % {len(_PICKS)}"
_TRY_CODE = f"CASE {_PICK} " + " ".join(f"WHEN {i} THEN {G.module_text(_try_text(a, b))}" for i, (a, b) in enumerate(_PICKS)) + " END"


def _try_history(a: int, b: int) -> list[tuple[int, str | None]]:
    """(attempt, message) of a source of two statements: each attempt fails with the first statement that is left."""
    left, out = [x for x in dict.fromkeys((a, b)) if _TRIES[x][0]], []
    for k in (1, 2, 3):
        out.append((k, _TRIES[left[0]][0] if left else None))
        if not left or _TRIES[left[0]][2] is None:
            break
        left.pop(0)
    return out


def _try_state(a: int, b: int) -> str:
    rows = _try_history(a, b)
    return "clean" if rows[-1] == (1, None) else "recovered" if rows[-1][1] is None else "gave_up"


@query(
    "attempt_history",
    " UNION ALL ".join(f"SELECT p_partkey, {k} AS attempt, {quoted(m) if m else 'NULL'} AS message FROM part WHERE {_PICK} = {i}" for i, (a, b) in enumerate(_PICKS) for k, m in _try_history(a, b)),
)
def attempt_history(spark, sf):
    """What each attempt at a source failed with."""
    _, history = _attempts(spark, sf)
    return history.select(F.col("key").alias("p_partkey"), "attempt", "message")


@query(
    "attempt_states",
    f"SELECT p_partkey, CASE {_PICK} " + " ".join(f"WHEN {i} THEN {quoted(_try_state(a, b))}" for i, (a, b) in enumerate(_PICKS)) + f" END AS state, CASE {_PICK} "
    + " ".join(f"WHEN {i} THEN {len(_try_history(a, b))}" for i, (a, b) in enumerate(_PICKS)) + " END AS attempts FROM part",
)
def attempt_states(spark, sf):
    """Where each source ends, and after how many attempts; some recover at the second attempt only."""
    states, _ = _attempts(spark, sf)
    return states.select(F.col("key").alias("p_partkey"), "state", "attempts")


def _attempts(spark, sf):
    from siltstone.operators import attempts
    from siltstone.session import evenly, table

    work = evenly(table(spark, sf, "part").select("p_partkey", "p_size")).selectExpr("p_partkey", f"{_TRY_CODE} AS code")
    return attempts.run_attempts(work, "p_partkey", "code")


# For each pattern of recovery a message, a source, and the source that its fix must leave.
_RECOVERIES = [
    ("ModuleNotFoundError: No module named 'manim'", "x = {k}\n", "from manim import *\nx = {k}\n"),
    ("ImportError: cannot import manim_imports_ext", "from manim_imports_ext import *\nx = {k}\n", "from manim import *\nx = {k}\n"),
    ("NameError: name 'reduce' is not defined", "from manim import *\nx = reduce(f, {k})\n", "from manim import *\nfrom functools import reduce\nx = reduce(f, {k})\n"),
    ("TypeError: 'method' object is not subscriptable", "x = a{k}.get_center[0]\n", "x = a{k}.get_center()[0]\n"),
    ("TypeError: got an unexpected keyword argument 'invert'", "x = ImageMobject('{k}', invert=True)\n", "x = ImageMobject('{k}')\n"),
    ("NameError: name 'GrowFromCenter' is not defined", "from manim import *\nx = GrowFromCenter(a{k})\n", "from manim import *\nx = FadeIn(a{k})\n"),
    ("NameError: name 'ShowCreation' is not defined", "from manim import *\nx = ShowCreation(a{k})\n", "from manim import *\nx = Create(a{k})\n"),
    ("NameError: name 'ApplyMethod' is not defined", "from manim import *\nx = ApplyMethod(a{k}.shift, UP)\n", "from manim import *\nx = a{k}.animate.shift(UP)\n"),
    ("NameError: name 'Transform' is not defined", "from manim import *\nx = Transform(a{k}, b)\n", "from manim import *\nx = ReplacementTransform(a{k}, b)\n"),
    ("ModuleNotFoundError: No module named 'cv2'", "import cv2\nx = {k}\n", "# import cv2  # Commented out - ManimGL specific\nx = {k}\n"),
    ("ImportError: cannot find manimlib", "from manim import *\nfrom manimlib.a import b\nx = {k}\n", "from manim import *\nfrom manim import *  # Converted from manimlib import\n# Original: from manimlib.a import b\nx = {k}\n"),
    ("NameError: name 'DelayByOrder' is not defined", "from manim import *\nx = DelayByOrder({k})\n", "from manim import *\nfrom manimce_custom_animations import DelayByOrder\nx = DelayByOrder({k})\n"),
    ("NameError: name 'PiCreatureScene' is not defined", "from manim import *\nclass A{k}(PiCreatureScene):\n    a = 1\n", "from manim import *\nclass A{k}(Scene):\n    a = 1\n"),
    ("NameError: name 'InteractiveScene' is not defined", "from manim import *\nclass A{k}(InteractiveScene):\n    a = 1\n", "from manim import *\nclass A{k}(Scene):\n    a = 1\n"),
    ("NameError: name 'MAROON_B' is not defined", "from manim import *\nx = (MAROON_B, BLUE_E, {k})\n", "from manim import *\nx = (LIGHT_MAROON, BLUE, {k})\n"),
    ("AttributeError: type object 'A' has no attribute 'CONFIG'", "x = A{k}.CONFIG['size']\n", "x = A{k}.size\n"),
    ("TypeError: got an unexpected keyword argument 'tex_template'", "x = Tex('$a_{k}$')\n", "x = MathTex('$a_{k}$')\n"),
    ("NameError: name 'get_norm' is not defined", "from manim import *\nx = get_norm(v{k})\n", "from manim import *\nfrom manimce_constants_helpers import get_norm\nx = get_norm(v{k})\n"),
    ("NameError: name 'FRAME_WIDTH' is not defined", "from manim import *\nx = FRAME_WIDTH * {k}\n", "from manim import *\nfrom manimce_constants_helpers import FRAME_WIDTH\nx = FRAME_WIDTH * {k}\n"),
    ("NameError: name 'rush_into' is not defined", "from manim import *\nself.play(a{k}, rate_func=rush_into)\n", "from manim import *\nfrom manimce_constants_helpers import rush_into\nself.play(a{k}, rate_func=rush_into)\n"),
    ("NameError: name 'deepcopy' is not defined", "from manim import *\nx = deepcopy(a{k})\n", "from manim import *\nfrom copy import deepcopy\nx = deepcopy(a{k})\n"),
    ("NameError: name 'initials' is not defined", "from manim import *\ndef f{k}(x):\n    return initials(x)\n",
     "from manim import *\nimport string\n\ndef initials(chars):\n    \"\"\"Capitals of a list of characters.\"\"\"\n    return ''.join([c for c in chars if c.isupper()])\n\ndef f{k}(x):\n    return initials(x)\n"),
    ("AttributeError: module 'string' has no attribute 'letters'", "x = string.letters[{k}]\n", "x = string.ascii_letters[{k}]\n"),
    ("NameError: name 'you' is not defined", "from manim import *\ndef f{k}(self):\n    self.add(you)\n", "from manim import *\ndef f{k}(self):\n    you = draw_you()\n    self.add(you)\n"),
    ("AttributeError: 'list' object has no attribute 'find'", "x = MathTex(PARTIAL_CONVERGENT_SUMS_TEXT, size={k})\n", "x = MathTex(' '.join(PARTIAL_CONVERGENT_SUMS_TEXT), size={k})\n"),
    ("RuntimeError: nothing known", "x = {k}\n", "x = {k}\n"),
]
_EACH = f"p_partkey % {len(_RECOVERIES)}"


def _recovery_case(column: int) -> str:
    return f"CASE {_EACH} " + " ".join(f"WHEN {i} THEN {G.module_text(r[column])}" for i, r in enumerate(_RECOVERIES)) + " END"


@query("recovered_patterns", f"SELECT p_partkey, md5({_recovery_case(2)}) AS fixed, {_EACH} <> {len(_RECOVERIES) - 1} AS recovered FROM part")
def recovered_patterns(spark, sf):
    """Recovery by each of its patterns, from the message that asks for it."""
    from siltstone.session import evenly, table

    d = evenly(table(spark, sf, "part").select("p_partkey")).selectExpr("p_partkey", f"{_recovery_case(0)} AS message", f"{_recovery_case(1)} AS code")
    return recovery.with_recovered(d, "code", "message").select("p_partkey", F.md5("recovery.code").alias("fixed"), "recovery.recovered")


# Calls of Tex, and what is said of them.
_ADVICE = [
    ("t = Tex('x^{n}')", "math_in_tex", "x^{n}"),
    ("t = [Tex(x) for x in zip(a, b)]", "variable_in_tex", "x"),
    ("t = Tex('plain words')", None, None),
    ("t = Tex(name)", None, None),
    ("t = MathTex('x^2')", None, None),
    ('t = Tex(r"a_{k}")', "math_in_tex", "a_{k}"),
]


@query(
    "runtime_advice",
    " UNION ALL ".join(
        f"SELECT p_partkey, 9 AS line, '{kind}' AS kind, {G.module_text(content)} AS content FROM part WHERE p_partkey % {len(_ADVICE)} = {i}" for i, (_, kind, content) in enumerate(_ADVICE) if kind
    ),
)
def runtime_advice(spark, sf):
    """Calls of Tex that look like mathematics, with their lines."""
    from siltstone.operators import rewrite

    statement = f"CASE p_partkey % {len(_ADVICE)} " + " ".join(f"WHEN {i} THEN {G.module_text(a[0])}" for i, a in enumerate(_ADVICE)) + " END"
    before = G.module_text("LIMIT = {n}\n\n# Tex is not called here\nclass Part{k}(Scene):\n    def construct(self):\n        a = b = 1\n        name = 'x'\n\n        ")
    d = table(spark, sf, "part").selectExpr("p_partkey", f"concat({before}, {statement}) AS code")
    return rewrite.tex_advice(d, "code", D.MATH)


@query(
    "helper_values",
    """
    SELECT p_partkey, round(CASE WHEN p_size = 25 THEN 0.5 ELSE (p_retailprice - p_size) / (25.0 - p_size) END, 6)::DOUBLE AS along,
           list_reduce(list_concat([1::BIGINT], range(1, least(p_size % 9, p_size - p_size % 9) + 1)), lambda a, i: a * (p_size - i + 1) // i) AS chosen,
           round(1 / (1 + exp(-(p_size - 25) / 5.0::DOUBLE)), 6) AS sigmoid, round(sqrt(p_size), 6) AS root,
           round(list_sum(list_transform(range(1, least(p_size, 10) + 1), lambda i: 1.0::DOUBLE / i)), 6) AS powers, (p_partkey * 13) % 256 AS red,
           1 + (p_size * (p_size - 1)) // 2 + (p_size * (p_size - 1) * (p_size - 2) * (p_size - 3)) // 24 AS regions, (p_size // 4) * 4 AS indices,
           round(cos(2 * pi() * ((p_size - 1) / p_size)), 6) AS last_east, round(p_size * 1.5 * 3 / 2, 6)::DOUBLE AS grid_sum
    FROM part
    """,
)
def helper_values(spark, sf):
    """Helpers of the old library over the parts' numbers."""
    from siltstone.functions import vectors as V

    n, price = F.col("p_size").cast("long"), F.col("p_retailprice").cast("double")
    code = F.concat(F.lit("#"), F.lpad(F.hex((F.col("p_partkey") * 13) % 256), 2, "0"), F.lit("0A0b"))
    # The sum of the absolute first coordinates of a grid of n rows, two columns and a width of 2.25.
    east = F.aggregate(V.grid(n, F.lit(2), F.lit(1.0), F.lit(2.25)), F.lit(0.0), lambda a, p: a + F.abs(F.get(p, 0)))
    return table(spark, sf, "part").select(
        "p_partkey",
        F.round(V.inverse_interpolated(n.cast("double"), F.lit(25.0), price), 6).alias("along"),
        V.choose(n, n % 9).cast("long").alias("chosen"),
        F.round(V.sigmoid((n - 25) / 5.0), 6).alias("sigmoid"),
        F.round(V.bisected(lambda x: x * x, n, F.lit(0.0), F.lit(100.0)), 6).alias("root"),
        F.round(F.aggregate(V.inverse_powers(n, 0.1), F.lit(0.0), lambda a, x: a + x), 6).alias("powers"),
        F.get(V.hex_color(code), 0).cast("long").alias("red"),
        V.chord_regions(n).cast("long").alias("regions"),
        F.size(V.path_indices(n, F.lit(4))).cast("long").alias("indices"),
        F.round(F.get(F.element_at(V.compass(n), -1), 0), 6).alias("last_east"),
        F.round(east, 6).alias("grid_sum"),
    )


@query("statement_rewrites", f"SELECT p_partkey, md5({G.one_statement(1)}) AS fixed, md5({G.one_statement(2)}) AS converted FROM part")
def statement_rewrites(spark, sf):
    """Names, calls, parameters and constants of the old dialect one by one, after the fixer and after the tree converter."""
    from siltstone.session import evenly

    d = evenly(table(spark, sf, "part").select("p_partkey")).selectExpr("p_partkey", f"{G.one_statement(0)} AS code")
    d = converter.with_converted(fixer.with_fixed(d, "code"), "code")
    return d.select("p_partkey", F.md5("fixed.code").alias("fixed"), F.md5("converted.code").alias("converted"))


_ASKED = "Match {source} in {lang}: {n_chars} characters."


@query(
    "prompts_learned",
    r"""
    WITH t AS (SELECT doc_id, unnest(list_distinct(list_filter(string_split_regex(lower(text), '[^\p{L}]+'), lambda w: length(w) > 9))) AS term FROM documents),
    h AS (SELECT term, count(*) FILTER (quality = 1) AS ok, count(*) FILTER (quality = 0) AS bad FROM t JOIN labels USING (doc_id) GROUP BY term),
    r AS (SELECT doc_id, term, CASE WHEN coalesce(ok, 0) + coalesce(bad, 0) > 0 THEN ok::DOUBLE / (ok + bad) ELSE 0.5 END AS rate FROM t LEFT JOIN h USING (term)),
    k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY rate DESC, term) AS n FROM r),
    g AS (SELECT doc_id, string_agg(term, ',' ORDER BY n) AS terms, string_agg(term, ', ' ORDER BY n) FILTER (n <= 3) AS named FROM k WHERE n <= 5 GROUP BY doc_id)
    SELECT doc_id, terms, 'Match ' || coalesce(source, 'unknown') || ' in ' || coalesce(lang, 'unknown') || ': ' || coalesce(n_chars::VARCHAR, 'unknown') || ' characters.'
           || CASE WHEN named IS NULL THEN '' ELSE chr(10) || chr(10) || 'LEARNED INSIGHTS:' || chr(10) || 'Prioritize searching for these terms that have worked well: ' || named END
           || CASE WHEN n_chars > 10000 THEN chr(10) || chr(10) || 'IMPORTANT WARNINGS:' || chr(10) || 'Large file detected. Consider breaking into logical chunks.' ELSE '' END AS prompt,
           CASE WHEN n_chars < 5000 THEN 'small' WHEN n_chars < 20000 THEN 'medium' ELSE 'large' END AS timeout
    FROM documents LEFT JOIN g USING (doc_id)
    """,
)
def prompts_learned(spark, sf):
    """A prompt for each document, with the long words of its text that documents of good quality have most often."""
    from siltstone.operators import prompts

    d = table(spark, sf, "documents")
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.length(w) > 9))
    asked = d.select(F.col("doc_id").alias("key"), F.explode(words).alias("term"))
    judged = asked.join(table(spark, sf, "labels").select(F.col("doc_id").alias("key"), "quality"), "key")
    history = judged.groupBy("term").agg(F.count_if(F.col("quality") == 1).alias("ok"), F.count_if(F.col("quality") == 0).alias("bad"))
    out = d.join(prompts.ranked_terms(asked, history).withColumnRenamed("key", "doc_id"), "doc_id", "left")
    base = prompts.filled(_ASKED, source=F.col("source"), lang=F.col("lang"), n_chars=F.col("n_chars"))
    prompt = prompts.cleaning_prompt(prompts.matching_prompt(base, F.col("terms")), F.lit(1), F.col("n_chars"))
    return out.select("doc_id", F.array_join("terms", ",").alias("terms"), prompt.alias("prompt"), prompts.timeout_class(F.col("n_chars")).alias("timeout"))


_M = "from manim import *\n"
_L = "from manimlib import *\n"
_S = "class A{k}(Scene):\n    def construct(self):\n        "
# A source for each kind of issue: validator, source, severities and kinds.
_ISSUE_SOURCES = [
    ("before_render", _M + "from manimlib.a import b\nx = {k}\n", "error:invalid_import"),
    ("before_render", _M + "from custom.x import y\n", "warning:problematic_import"),
    ("before_render", "x = {k}\n", "error:missing_import"),
    ("before_render", _M + "class A(ContinualAnimation):\n    a = {k}\n", "error:continual_animation,error:deprecated_class"),
    ("before_render", _M + "t = OldTex('{k}')\n", "error:deprecated_api"),
    ("before_render", _M + "a = ShowCreation(b)\n", "error:deprecated_animation,error:deprecated_api"),
    ("before_render", _M + "w = a.get_width() + {k}\n", "warning:deprecated_method"),
    ("before_render", _M + "r = Randolph()\n", "error:pi_creature_usage"),
    ("before_render", _M + "class A{k}(Scene):\n    a = 1\n", "error:missing_construct"),
    ("before_render", _M + "class A{k}(Scene):\n    def construct(self, extra):\n        pass\n", "error:invalid_construct"),
    ("before_render", _M + "class A{k}(Scene):\n    CONFIG = {'n': {n}}\n    def construct(self):\n        pass\n", "warning:deprecated_config"),
    ("before_render", "x = ({k}\n", "error:syntax_error"),
    ("before_render", _M + "x = {k}\n", ""),
    ("scene", _S + "pass\n", "error:missing_import"),
    ("scene", _L + "x = 1\n" * 22 + "import os\n" + _S + "pass\n", "warning:import_location"),
    ("scene", _L + "x = {k}\n", "error:no_scene_class"),
    ("scene", _L + "class A{k}(Scene):\n    a = 1\n", "error:missing_construct"),
    ("scene", _L + _S + "self.add(nothing_{k})\n", "warning:undefined_names"),
    ("scene", _L + _S + "print({k})\n", "info:print_statement"),
    ("scene", _L + _S + "x = '" + "long " * 40 + "'\n", "info:long_line"),
    ("before_conversion", "from manimlib.imports import SmallDot\n", "error:removed_import"),
    ("before_conversion", "class A{k}(GraphScene):\n    a = 1\n", "warning:changed_base_class"),
    ("before_conversion", "a = SmallDot()\n", "error:removed_class"),
    ("before_conversion", "a.get_corner(UL)\n", "error:removed_method"),
    ("before_conversion", "t = Tex('x', size='{k}')\n", "error:removed_parameter"),
    ("before_conversion", "a.add_updater(f)\n", "warning:updater_api_change"),
    ("before_conversion", "self.play(a, b, c, d)\n", "info:complex_play_call"),
    ("before_conversion", "w = a.width()\n", "warning:property_as_method"),
    ("before_conversion", "a.coords_to_point({k})\n", "info:coordinate_api"),
    ("before_conversion", "x = {k}\n", ""),
]
# A source for each automatic fix, and what it must become.
_FIX_SOURCES = [
    ("x = {k}\n", _M + "x = {k}\n"),
    ("from manim_imports_ext import *\nx = {k}\n", _M + "x = {k}\n"),
    (_M + "a = ShowCreation(TextMobject('{k}'))\n", _M + "a = Create(Text('{k}'))\n"),
    ("from manimlib.a import *\nx = {k}\n", _M + "x = {k}\n"),
    (_M + "class A{k}(CycloidScene):\n    def construct(self):\n        pass\n", _M + _S + "pass\n"),
    (_M + "class A{k}(Scene):\n    a = 1\n", _M + _S + "pass\n\n    a = 1\n"),
    (_M + "c = (LIGHT_GRAY, GRAY, {k})\n", _M + "c = (LIGHT_GREY, GREY, {k})\n"),
    (_M + 't = Tex("{k}"))\n', _M + 't = Tex("{k}")\n'),
    (_M + "x = {k}\n", _M + "x = {k}\n"),
]


def _pick(rows: list, column: int) -> str:
    return f"CASE p_partkey % {len(rows)} " + " ".join(f"WHEN {i} THEN {G.module_text(r[column])}" for i, r in enumerate(rows)) + " END"


@query("issue_kinds", f"SELECT p_partkey, {_pick(_ISSUE_SOURCES, 0)} AS validator, {_pick(_ISSUE_SOURCES, 2)} AS kinds FROM part")
def issue_kinds(spark, sf):
    """Every kind of issue of the three validators, from a source that has it."""
    from siltstone.session import evenly

    d = evenly(table(spark, sf, "part").select("p_partkey", "p_size")).selectExpr("p_partkey", f"{_pick(_ISSUE_SOURCES, 0)} AS validator", f"{_pick(_ISSUE_SOURCES, 1)} AS code")
    parts = [validators.with_issues(d.where(F.col("validator") == v), "code", v) for v in ("before_render", "scene", "before_conversion")]
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("issues", lambda i: F.concat(i["severity"], F.lit(":"), i["type"])))), ",")
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("p_partkey", "validator", kinds.alias("kinds"))


@query("auto_fix_kinds", f"SELECT p_partkey, md5({_pick(_FIX_SOURCES, 1)}) AS fixed, p_partkey % {len(_FIX_SOURCES)} <> {len(_FIX_SOURCES) - 1} AS changed FROM part")
def auto_fix_kinds(spark, sf):
    """Every automatic fix, on a source that needs it."""
    from siltstone.session import evenly

    d = evenly(table(spark, sf, "part").select("p_partkey")).selectExpr("p_partkey", f"{_pick(_FIX_SOURCES, 0)} AS code")
    d = validators.with_auto_fix(d, "code")
    return d.select("p_partkey", F.md5("auto.code").alias("fixed"), (F.size("auto.fixes") > 0).alias("changed"))
