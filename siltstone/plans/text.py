"""Text queries: statistics, terms, names, line issues, renames and fixes, imports, differences."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone import rules as R
from siltstone.functions import text as fn
from siltstone.operators import rewrite
from siltstone.plans.registry import query, sql_query
from siltstone.plans.rules import _CODE, code_of
from siltstone.session import table
from siltstone.sources.samples import quoted

sql_query(
    "doc_statistics",
    """
    SELECT doc_id, CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) AS lines, round(CAST(length(text) AS DOUBLE) / 1024, 2) AS size_kb,
           CAST(regexp_count(text, R'(?m)^[A-Z]') AS BIGINT) AS capital_lines, CAST(regexp_count(text, R'(?m)^[ \\t]*#') AS BIGINT) AS comment_lines,
           CASE WHEN length(text) - length(replace(text, chr(10), '')) + 1 < 50 THEN 'simple'
                WHEN length(text) - length(replace(text, chr(10), '')) + 1 < 150 THEN 'medium' ELSE 'complex' END AS complexity
    FROM {documents}
    """.replace("\\\\", "\\"),
    """
    SELECT doc_id, (length(text) - length(replace(text, chr(10), '')) + 1)::BIGINT AS lines, round(length(text)::DOUBLE / 1024, 2) AS size_kb,
           len(regexp_extract_all(text, '(?m)^[A-Z]'))::BIGINT AS capital_lines, len(regexp_extract_all(text, '(?m)^[ \\t]*#'))::BIGINT AS comment_lines,
           CASE WHEN length(text) - length(replace(text, chr(10), '')) + 1 < 50 THEN 'simple'
                WHEN length(text) - length(replace(text, chr(10), '')) + 1 < 150 THEN 'medium' ELSE 'complex' END AS complexity
    FROM documents
    """,
)
sql_query(
    "cleaning_rollup",
    """
    SELECT source, count(*) AS scenes, CAST(sum(n_chars) AS BIGINT) AS total_chars, CAST(count_if(n_chars < 500) AS BIGINT) AS simple,
           CAST(count_if(n_chars >= 500 AND n_chars < 5000) AS BIGINT) AS medium, CAST(count_if(n_chars >= 5000) AS BIGINT) AS complex,
           round(CAST(sum(n_chars) AS DOUBLE) / count(*), 2) AS avg_size
    FROM {documents} GROUP BY source
    """,
)


@query(
    "title_from_slug",
    "SELECT page_id, list_aggregate(list_transform(string_split(replace(slug, '-', ' '), ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), 'string_agg', ' ') AS title, replace(slug, '-', '_') AS expected_file "
    "FROM (SELECT page_id, regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[^0-9A-Za-z]+', '-', 'g') AS slug FROM pages)",
)
def title_from_slug(spark, sf):
    """A title and a file name from a slug."""
    slug = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[^0-9A-Za-z]+", "-")
    p = table(spark, sf, "pages").select("page_id", slug.alias("slug"))
    return p.select("page_id", fn.title(F.col("slug")).alias("title"), F.replace("slug", F.lit("-"), F.lit("_")).alias("expected_file"))


@query(
    "filename_sanitize",
    r"""
    SELECT page_id, lower(rtrim(left(trim(regexp_replace(regexp_replace(t, '[^\p{L}\p{N}_\s-]', '', 'g'), '[-\s]+', '_', 'g'), '_'), 50), '_')) AS name
    FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages)
    """,
)
def filename_sanitize(spark, sf):
    """A safe file name from a page's title."""
    p = table(spark, sf, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("t"))
    return p.select("page_id", fn.file_name(F.col("t")).alias("name"))


_TERMS = ["the", "und", "les", "que", *R.MATH_TERMS, *R.TECH_TERMS]


@query(
    "term_extract_rank",
    rf"""
    SELECT lang, term, n, rank FROM (SELECT lang, term, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS rank FROM (
        SELECT lang, term, count(*) AS n FROM (SELECT lang, unnest(list_distinct(list_concat(
            list_transform(regexp_extract_all(text, '\b[A-Z][a-z]+(?:[A-Z][a-z]+)+\b'), lambda x: lower(x)),
            list_filter(string_split_regex(lower(text), '[^\p{{L}}]+'), lambda x: x IN ({", ".join(map(quoted, _TERMS))}))))) AS term FROM documents)
        GROUP BY lang, term)) WHERE rank <= 5
    """,
)
def term_extract_rank(spark, sf):
    """Technical terms of each document, and the five that most documents of a language have."""
    d = table(spark, sf, "documents").select("lang", F.explode(fn.terms(F.col("text"), _TERMS)).alias("term"))
    n = d.groupBy("lang", "term").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    w = Window.partitionBy("lang").orderBy(F.desc("n"), "term")
    return n.withColumn("rank", F.row_number().over(w).cast("long")).where("rank <= 5")


@query(
    "line_issue_scan",
    """
    SELECT doc_id, line, kind FROM (
        SELECT doc_id, generate_subscripts(l, 1) - 1 AS line, unnest(l) AS s FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) x,
        LATERAL (SELECT unnest(['long', 'comment', 'blank']) AS kind)
    WHERE (kind = 'long' AND length(s) > 120) OR (kind = 'comment' AND contains(s, '#')) OR (kind = 'blank' AND s = '')
    """,
)
def line_issue_scan(spark, sf):
    """Issues of single lines, with their numbers."""
    return fn.line_issues(table(spark, sf, "documents").select("doc_id", "text"))


@query(
    "issue_rollup",
    """
    SELECT kind, count(*) AS n, count(DISTINCT doc_id) AS documents FROM (
        SELECT doc_id, unnest(l) AS s FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) x,
        LATERAL (SELECT unnest(['long', 'comment', 'blank']) AS kind)
    WHERE (kind = 'long' AND length(s) > 120) OR (kind = 'comment' AND contains(s, '#')) OR (kind = 'blank' AND s = '') GROUP BY kind
    """,
)
def issue_rollup(spark, sf):
    """Issues by kind."""
    return line_issue_scan(spark, sf).groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("documents"))


def _fold(c: str, rules) -> str:
    for p, r in rules:
        repl = r.replace("$1", "\\1").replace("$2", "\\2")
        c = f"regexp_replace({c}, {quoted(p)}, {quoted(repl)}, 'g')"
    return c


@query("rename_fold", f"SELECT doc_id, md5({_fold('code', R.RENAMES)}) AS renamed, {_fold('code', R.RENAMES)} <> code AS changed FROM {_CODE}")
def rename_fold(spark, sf):
    """All renames in order, as one expression."""
    out = rewrite.fold(F.col("code"), R.RENAMES)
    return code_of(spark, sf).select("doc_id", F.md5(out).alias("renamed"), (out != F.col("code")).alias("changed"))


_STEPS, _C = [], "code"
for _p, _r in R.RUNTIME_FIXES:
    _STEPS.append(f"len(regexp_extract_all({_C}, {quoted(_p)}))")
    _C = _fold(_C, [(_p, _r)])


@query("runtime_regex_fix", f"SELECT doc_id, md5({_C}) AS fixed, array_to_string([{', '.join(_STEPS)}], ',') AS counts FROM {_CODE}")
def runtime_regex_fix(spark, sf):
    """Ordered fixes; each rule's count is taken on the text as the rules before left it."""
    d = rewrite.with_folded(code_of(spark, sf), "code", R.RUNTIME_FIXES)
    return d.select("doc_id", F.md5("folded").alias("fixed"), F.array_join(F.transform("counts", lambda c: c.cast("string")), ",").alias("counts"))


def _module(c: str) -> str:
    return f"split_part(split_part(trim({c}), ' ', 2), '.', 1)"


_STD = ", ".join(f"'{m}'" for m in R.STDLIB)
_THIRD = " OR ".join(f"contains(s, '{m}')" for m in R.THIRD_PARTY)


@query(
    "import_organize",
    f"""
    SELECT doc_id, string_agg(s, chr(10) ORDER BY priority, s) AS imports, count(*) AS n, min(category) AS least_category FROM (
        SELECT DISTINCT doc_id, trim(s) AS s,
               CASE WHEN {_module('s')} IN ({_STD}) THEN 0 WHEN {_THIRD} THEN 1 WHEN contains(s, 'manim') THEN 2 ELSE 3 END AS priority,
               CASE WHEN {_module('s')} IN ({_STD}) THEN 'stdlib' WHEN {_THIRD} THEN 'third_party' WHEN contains(s, 'manim') THEN 'manim' ELSE 'local' END AS category
        FROM (SELECT doc_id, unnest(string_split(code, chr(10))) AS s FROM {_CODE}) WHERE starts_with(trim(s), 'import ') OR starts_with(trim(s), 'from '))
    GROUP BY doc_id
    """,
)
def import_organize(spark, sf):
    """Import lines of each source, distinct, ordered by kind."""
    lines = code_of(spark, sf).select("doc_id", F.explode(F.split("code", "\n")).alias("s")).select("doc_id", F.trim("s").alias("s"))
    lines = lines.where(F.startswith("s", F.lit("import ")) | F.startswith("s", F.lit("from "))).distinct()
    priority, category = fn.import_kind(F.col("s"))
    lines = lines.select("doc_id", "s", priority.alias("priority"), category.alias("category"))
    return lines.groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("priority", "s"))), lambda x: x["s"]), "\n").alias("imports"),
        F.count("*").alias("n"),
        F.min("category").alias("least_category"),
    )


@query(
    "diff_stats",
    f"""
    SELECT doc_id, len(list_filter(list_distinct(string_split(b, chr(10))), lambda x: NOT list_contains(string_split(code, chr(10)), x)))::BIGINT AS added,
           len(list_filter(list_distinct(string_split(code, chr(10))), lambda x: NOT list_contains(string_split(b, chr(10)), x)))::BIGINT AS removed,
           abs(len(regexp_extract_all(b, 'def ')) - len(regexp_extract_all(code, 'def ')))::BIGINT AS functions
    FROM (SELECT doc_id, code, {_fold('code', R.RENAMES)} AS b FROM {_CODE})
    """,
)
def diff_stats(spark, sf):
    """Lines added and removed between a source and its renamed form."""
    d = code_of(spark, sf).withColumn("b", rewrite.fold(F.col("code"), R.RENAMES))
    return d.select("doc_id", *rewrite.diff_stats(F.col("code"), F.col("b")))


@query(
    "fix_confidence",
    f"""
    SELECT doc_id, round(greatest(0.0, least(1.0, 0.5 + {' + '.join(f"CASE WHEN contains(lower(fixes), '{w.lower()}') THEN {b} ELSE 0 END" for w, b in R.BOOSTS if w in ('import', 'animation', 'class', 'color'))}
            + CASE WHEN (CASE WHEN contains(lower(fixes), 'import') THEN 1 ELSE 0 END) + (CASE WHEN contains(lower(fixes), 'animation') THEN 1 ELSE 0 END) + (CASE WHEN contains(lower(fixes), 'class') THEN 1 ELSE 0 END) >= 2 THEN 0.1 ELSE 0 END
            - 0.05 * (doc_id % 3) - CASE WHEN doc_id % 5 = 0 THEN 0.4 ELSE 0 END)), 6)::DOUBLE AS confidence
    FROM (SELECT doc_id, concat(CASE WHEN doc_id % 2 = 0 THEN 'import fixed,' ELSE '' END, CASE WHEN doc_id % 3 = 0 THEN 'animation renamed,' ELSE '' END,
                                CASE WHEN doc_id % 4 = 0 THEN 'class renamed,' ELSE '' END, CASE WHEN doc_id % 7 = 0 THEN 'color mapped,' ELSE '' END) AS fixes FROM documents)
    """,
)
def fix_confidence(spark, sf):
    """Confidence of a fixer from the kinds of fixes it made and the issues left."""
    kinds = ((2, "import fixed"), (3, "animation renamed"), (4, "class renamed"), (7, "color mapped"))
    fixes = F.array_compact(F.array(*[F.when(F.col("doc_id") % k == 0, n) for k, n in kinds]))
    left = F.when(F.col("doc_id") % 5 == 0, F.lit(1)).otherwise(0)
    d = table(spark, sf, "documents").select("doc_id", fixes.alias("fixes"), left.alias("syntax"), (F.col("doc_id") % 3).alias("other"))
    return d.select("doc_id", F.round(rewrite.fix_confidence(F.col("fixes"), F.col("syntax"), F.col("other"), R.BOOSTS), 6).alias("confidence"))


sql_query(
    "math_helpers",
    """
    SELECT event_id, round(1 / (1 + exp(-(value / 50 - 1))), 6) AS sigmoid, round((1 - 0.25E0) * value + 0.25E0 * event_id, 4) AS interpolated,
           round(value / (1 + value * value / 4), 6) AS inverse_power, round(CASE WHEN value <> 0 THEN (value - 1) / value END, 6) AS inverse_interpolated
    FROM {events}
    """,
)
