"""Gates, summaries and reports over the driver tables, one operator each, with SQL that both engines read."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone import rules as R
from siltstone.operators import gates, stages
from siltstone.plans.metrics import _DKEY, _KEY, both
from siltstone.plans.registry import query, sql_query
from siltstone.rules.dialect import PI_NAMES
from siltstone.session import table
from siltstone.sources.messages import EXCEPTIONS, message_sql
from siltstone.sources.samples import quoted

# A document as a match record: confidence from its length, files from its lines, status from its label.
_MATCH = """(SELECT d.doc_id, d.source, d.lang, d.n_chars, CAST(least(d.n_chars, 2000) AS DOUBLE) / 2000 AS confidence,
    length(d.text) - length(replace(d.text, chr(10), '')) AS n_files, coalesce(d.text, '') = '' AS no_transcript,
    CASE WHEN l.doc_id IS NULL THEN 'error' WHEN l.toxic = 1 THEN 'skipped' WHEN l.quality = 1 THEN 'completed' ELSE 'low_confidence' END AS process_status,
    CASE WHEN l.quality = 1 THEN 'completed' ELSE 'not_cleaned' END AS cleaning_status
    FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id)"""
_GATE = [
    ("No transcript available", "no_transcript"),
    ("Low confidence score", "confidence < 0.8D"),
    ("No primary files identified", "n_files = 0"),
    ("Already cleaned", "cleaning_status = 'completed' AND NOT force"),
]


def _matches(spark, sf):
    return spark.sql("SELECT * FROM " + _MATCH, documents=table(spark, sf, "documents"), labels=table(spark, sf, "labels"))


@query(
    "clean_gate",
    "SELECT doc_id, force, reason, reason = 'Ready for cleaning' AS eligible FROM (SELECT doc_id, force, CASE "
    + " ".join(f"WHEN {c.replace('0.8D', '0.8')} THEN '{n}'" for n, c in _GATE)
    + " ELSE 'Ready for cleaning' END AS reason FROM "
    + _MATCH.replace("{documents}", "documents").replace("{labels}", "labels")
    + ", (VALUES (true), (false)) f(force))",
)
def clean_gate(spark, sf):
    """Whether to clean a match, and why not, as it stands and when forced."""
    m = _matches(spark, sf).withColumn("force", F.explode(F.array(F.lit(True), F.lit(False))))
    return gates.first_failing(m, _GATE, "Ready for cleaning").select("doc_id", "force", "reason", "eligible")


sql_query(
    "cleaner_admission",
    f"""
    SELECT doc_id, process_status IN ('completed', 'matched', 'low_confidence') AS status_ok, n_files > 0 AS has_files,
           CASE WHEN process_status NOT IN ('completed', 'matched', 'low_confidence') OR n_files = 0 THEN 'skipped'
                WHEN cleaning_status = 'completed' AND n_chars > 1000 THEN 'skipped' WHEN cleaning_status = 'completed' THEN 'again' ELSE 'clean' END AS action
    FROM {_MATCH}
    """,
)
sql_query("allow_list", "SELECT doc_id, source FROM {documents} WHERE doc_id IN (SELECT item_id FROM {benchmark} WHERE item_id IS NOT NULL)")
sql_query(
    "match_checks",
    """
    SELECT conv_id, has_primary, count_ok, has_evidence, confident, has_primary AND count_ok AND has_evidence AND confident AS is_valid
    FROM (SELECT conv_id, count_user > 0 AS has_primary, count_user BETWEEN 1 AND 10 AS count_ok, count_assistant > 0 AS has_evidence,
                 CAST(count_assistant AS DOUBLE) / n >= 0.5 AS confident
          FROM (SELECT conv_id, count(*) AS n, count(CASE WHEN role = 'user' THEN 1 END) AS count_user,
                       count(CASE WHEN role = 'assistant' THEN 1 END) AS count_assistant FROM {conversations} GROUP BY conv_id))
    """,
)
sql_query(
    "file_set_caps",
    """
    SELECT d.doc_id, s.total_bytes, CAST(length(d.text) - length(replace(d.text, chr(10), '')) + 1 AS BIGINT) AS lines,
           CASE WHEN s.total_bytes > 800000 THEN 'fail' WHEN s.total_bytes > 500000 THEN 'fallback' ELSE 'programmatic' END AS route,
           length(d.text) - length(replace(d.text, chr(10), '')) + 1 > 1000 AS skip_scene
    FROM {documents} d JOIN (SELECT source, lang, CAST(sum(octet_length(encode(text, 'UTF-8'))) AS BIGINT) AS total_bytes FROM {documents} GROUP BY source, lang) s
    ON d.source <=> s.source AND d.lang <=> s.lang
    """,
    """
    SELECT d.doc_id, s.total_bytes, (length(d.text) - length(replace(d.text, chr(10), '')) + 1) AS lines,
           CASE WHEN s.total_bytes > 800000 THEN 'fail' WHEN s.total_bytes > 500000 THEN 'fallback' ELSE 'programmatic' END AS route,
           length(d.text) - length(replace(d.text, chr(10), '')) + 1 > 1000 AS skip_scene
    FROM documents d JOIN (SELECT source, lang, sum(octet_length(encode(text)))::BIGINT AS total_bytes FROM documents GROUP BY source, lang) s
    ON d.source IS NOT DISTINCT FROM s.source AND d.lang IS NOT DISTINCT FROM s.lang
    """,
)
sql_query(
    "skip_thresholds",
    f"""
    SELECT stack.minimum, scenes, stack.skipped FROM (
        SELECT count(*) AS scenes, count(CASE WHEN confidence < 0.4E0 THEN 1 END) AS a, count(CASE WHEN confidence < 0.6E0 THEN 1 END) AS b, count(CASE WHEN confidence < 0.65E0 THEN 1 END) AS c,
               count(CASE WHEN confidence < 0.8E0 THEN 1 END) AS d FROM {_MATCH}) LATERAL VIEW stack(4, 0.4E0, a, 0.6E0, b, 0.65E0, c, 0.8E0, d) stack AS minimum, skipped
    """,
    f"""
    SELECT minimum, count(*) AS scenes, count(*) FILTER (confidence < minimum) AS skipped FROM {_MATCH} CROSS JOIN (SELECT unnest([0.4::DOUBLE, 0.6, 0.65, 0.8]) AS minimum) t GROUP BY minimum
    """,
)

# Literal marks of mathematics, as they are looked for (with doubled backslashes), and what makes an equation.
MATH_MARKS = [
    r"\\frac", r"\\cdot", r"\\sqrt", r"\\sum", r"\\int", r"\\lim",
    r"\\infty", r"\\alpha", r"\\beta", r"\\gamma", r"\\theta", r"\\phi",
    r"\\pi", r"\\sigma", r"\\omega", r"\\times", r"\\div", r"\\pm",
    r"\\leq", r"\\geq", r"\\neq", r"\\approx", r"\\equiv", r"\\propto",
    r"\\partial", r"\\nabla", r"\\forall", r"\\exists", r"\\in",
    r"\\subset", r"\\cup", r"\\cap", r"\\wedge", r"\\vee", r"\\oplus",
    r"\\otimes", r"\\perp", r"\\ldots", r"\\cdots", r"\\vdots", r"\\ddots",
    r"\^", r"_", r"\\\\", r"\\zeta", r"\\Delta", r"\\Sigma", r"\\Lambda",
    r"\\left", r"\\right", r"\\big", r"\\Big", r"\\begin\{", r"\\end\{",
    r"\\mathbb", r"\\mathcal", r"\\mathfrak", r"\\text\{", r"\\mathrm\{",
]
_OPERATORS = ["=", "+", "-", "*", "/", "<", ">", "≤", "≥", "≠"]
_VETO = ["http", "https", "email", "@"]


def _from_code(sql: str) -> str:
    from siltstone.plans.rules import _CODE

    return sql.replace("{code}", _CODE)


@query(
    "pi_creature_related",
    _from_code(
        "SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(code, '[A-Za-z_][A-Za-z_0-9]*'), lambda x: x IN ("
        + ", ".join(map(quoted, PI_NAMES))
        + ")))), ',') AS names FROM {code}"
    ),
)
def pi_creature_related(spark, sf):
    """Names in a source that have to do with pi creatures."""
    from siltstone.plans.rules import code_of

    names = F.filter(F.regexp_extract_all("code", F.lit("[A-Za-z_][A-Za-z_0-9]*"), F.lit(0)), lambda x: x.isin(PI_NAMES))
    return code_of(spark, sf).select("doc_id", F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("names"))


def _any(c: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({c}, {quoted(w)})" for w in words) + ")"


@query(
    "contains_math",
    _from_code(
        f"SELECT doc_id, {_any('code', MATH_MARKS)} OR contains(code, '$') OR ({_any('code', _OPERATORS)} AND NOT {_any('lower(code)', _VETO)} "
        r"AND regexp_matches(code, '\b\w+\s*[=+\-*/]\s*\w+')) AS math FROM {code}"
    ),
)
def contains_math(spark, sf):
    """Literal marks of mathematics, a dollar sign, or what looks like an equation in a text without addresses."""
    from siltstone.plans.rules import code_of

    some = lambda c, words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(c, w))
    code = F.col("code")
    equation = some(code, _OPERATORS) & ~some(F.lower(code), _VETO) & code.rlike(r"\b\w+\s*[=+\-*/]\s*\w+")
    return code_of(spark, sf).select("doc_id", (some(code, MATH_MARKS) | F.contains(code, F.lit("$")) | equation).alias("math"))


# Words of render output and of cleaning errors, in the order they are tried.
RENDER_LADDER = [
    ("syntax_error", ["syntaxerror", "invalid syntax"]), ("import_error", ["importerror", "modulenotfounderror"]), ("runtime_error", ["attributeerror"]),
    ("timeout_error", ["timeout", "timed out"]), ("resource_error", ["memory", "memoryerror"]), ("validation_error", ["validation", "validation failed"]),
]
# Exception classes, their category, whether fixable and recovered without help, and the advice.
EXCEPTION_ATTRIBUTES = [
    (["SyntaxError"], "syntax_error", "true", "false", "Check syntax and fix parsing errors"),
    (["ImportError", "ModuleNotFoundError"], "import_error", "true", "true", "Add missing import or dependency"),
    (["TimeoutError"], "timeout_error", "true", "true", "Increase timeout or optimize operation"),
    (["MemoryError", "OSError"], "resource_error", "false", "false", "Reduce resource usage or increase system limits"),
    (None, "runtime_error", "NULL", "NULL", "Review error details and fix underlying issue"),
]
_MESSAGES = "(SELECT event_id, event_type, user_id, [message] AS m FROM {events})"


def _messages(name: str, text: str) -> None:
    """A query over the events' messages: [messages] is their table."""
    text = text.replace("[messages]", _MESSAGES)
    duck = text.replace("[message]", message_sql(_DKEY)).replace("{events}", "events").replace("/*g*/", ", 'g'")
    sql_query(name, text.replace("[message]", message_sql(_KEY)), duck)


_messages(
    "render_error_category",
    "SELECT event_id, CASE "
    + " ".join("WHEN " + " OR ".join(f"contains(lower(m), '{w}')" for w in words) + f" THEN '{n}'" for n, words in RENDER_LADDER)
    + """ ELSE 'unknown_error' END AS category,
           CASE WHEN contains(lower(m), 'syntax') THEN 'syntax' WHEN contains(lower(m), 'import') THEN 'import'
                WHEN contains(lower(m), 'name') AND contains(lower(m), 'not defined') THEN 'undefined_name' ELSE 'other' END AS cleaning_type FROM [messages]""",
)
_messages(
    "error_truncations",
    """SELECT event_id, left(m, 500) AS snippet, CASE WHEN length(m) > 100 THEN concat(left(m, 100), '...') ELSE m END AS summary, right(m, 1000) AS stderr_tail,
              CAST(length(m) AS BIGINT) AS n FROM [messages]""",
)
# The key line is the last one; /*g*/ becomes the flag that makes DuckDB replace all.
_KEYLINE = "trim(split_part(g, chr(10), -1))"
_FILES = """regexp_replace(m, 'File "[^"]+", line [0-9]+', 'File "...", line N'/*g*/)"""
_OBJECTS = f"regexp_replace({_FILES}, concat(chr(39), '[^', chr(39), ']+', chr(39), ' object'), concat(chr(39), 'X', chr(39), ' object')/*g*/)"
_MASKED = f"""regexp_replace({_OBJECTS}, '"[^"]+"', '"X"'/*g*/)"""
_messages(
    "error_generalised",
    f"SELECT event_id, CASE WHEN contains({_KEYLINE}, ':') THEN split_part({_KEYLINE}, ':', 1) ELSE left(g, 100) END AS pattern FROM (SELECT event_id, {_MASKED} AS g FROM [messages])",
)
both(
    "exception_details",
    "SELECT event_id, name, CASE " + " ".join(f"WHEN name IN ({', '.join(map(quoted, n))}) THEN '{c}'" for n, c, *_ in EXCEPTION_ATTRIBUTES if n)
    + " ELSE 'runtime_error' END AS category, CASE " + " ".join(f"WHEN name IN ({', '.join(map(quoted, n))}) THEN {f}" for n, _, f, _, _ in EXCEPTION_ATTRIBUTES if n)
    + " END AS fixable, CASE " + " ".join(f"WHEN name IN ({', '.join(map(quoted, n))}) THEN {a}" for n, _, _, a, _ in EXCEPTION_ATTRIBUTES if n)
    + " END AS auto_recoverable, CASE " + " ".join(f"WHEN name IN ({', '.join(map(quoted, n))}) THEN '{s}'" for n, _, _, _, s in EXCEPTION_ATTRIBUTES if n)
    + f" ELSE '{EXCEPTION_ATTRIBUTES[-1][4]}' END AS suggested_fix FROM (SELECT event_id, CASE [k] % {len(EXCEPTIONS)} "
    + " ".join(f"WHEN {n} THEN '{e}'" for n, e in enumerate(EXCEPTIONS)) + " END AS name FROM {events})",
)

sql_query(
    "cleaning_summary",
    f"""
    SELECT total_videos, processed, cleaned, total_videos - processed AS skipped, processed - cleaned AS failed, programmatic, cleaned - programmatic AS fallback,
           round(CASE WHEN total_videos > 0 THEN CAST(programmatic AS DOUBLE) / total_videos ELSE 0.0E0 END, 6) AS programmatic_rate,
           round(CASE WHEN total_videos > 0 THEN CAST(cleaned - programmatic AS DOUBLE) / total_videos ELSE 0.0E0 END, 6) AS fallback_rate
    FROM (SELECT count(*) AS total_videos, count(CASE WHEN go THEN 1 END) AS processed, count(CASE WHEN go AND confidence >= 0.5 THEN 1 END) AS cleaned,
                 count(CASE WHEN go AND confidence >= 0.5 AND n_chars <= 5000 THEN 1 END) AS programmatic
          FROM (SELECT *, process_status IN ('completed', 'matched', 'low_confidence') AND n_files > 0 AS go FROM {_MATCH}))
    """,
)


@query(
    "cleaning_optimised",
    """
    WITH s AS (SELECT source, n_chars * 0.01::DOUBLE AS seconds, length(text) - length(replace(text, chr(10), '')) + 1 AS lines,
                      CASE WHEN text IS NULL OR trim(text) = '' THEN 'empty' WHEN n_chars < 200 THEN 'too_short' WHEN n_chars > 20000 THEN 'too_long' WHEN contains(text, '<') THEN 'markup' END AS error FROM documents),
    c AS (SELECT *, CASE WHEN lines < 50 THEN 'simple' WHEN lines < 150 THEN 'medium' ELSE 'complex' END AS complexity FROM s),
    h AS (SELECT source, complexity, count(*) AS n FROM c GROUP BY source, complexity),
    m AS (SELECT source, string_agg(complexity || '=' || n, ',' ORDER BY complexity) AS complexities FROM h GROUP BY source),
    e AS (SELECT source, string_agg(error || '=' || n, ',' ORDER BY error) AS errors FROM (SELECT source, error, count(*) AS n FROM s WHERE error IS NOT NULL GROUP BY source, error) GROUP BY source)
    SELECT source, count(*) AS scenes, round(sum(seconds), 2) AS total_time, round(avg(seconds), 2) AS avg_time, round(avg(lines))::BIGINT AS avg_size,
           any_value(complexities) AS complexities, coalesce(any_value(errors), '') AS errors FROM c JOIN m USING (source) LEFT JOIN e USING (source) GROUP BY source
    """,
)
def cleaning_optimised(spark, sf):
    """Per source: scenes, times, mean size and the histograms of complexity and of error types, by one aggregate over partial histograms."""
    lines = F.size(F.split("text", "\n"))
    blank = F.col("text").isNull() | (F.trim("text") == "")
    error = F.when(blank, "empty").when(F.col("n_chars") < 200, "too_short").when(F.col("n_chars") > 20000, "too_long").when(F.contains("text", F.lit("<")), "markup")
    d = table(spark, sf, "documents").select("source", (F.col("n_chars") * 0.01).alias("seconds"), lines.alias("lines"), error.alias("error"))
    kind = F.when(F.col("lines") < 50, "simple").when(F.col("lines") < 150, "medium").otherwise("complex")
    h = d.groupBy("source", kind.alias("complexity"), "error").agg(F.count("*").alias("n"), F.sum("seconds").alias("t"), F.sum("lines").alias("l"))
    h = h.groupBy("source").agg(F.sum("n").alias("scenes"), F.sum("t").alias("t"), F.sum("l").alias("l"), F.collect_list(F.struct("complexity", "error", "n")).alias("cells"))  # 15 cells at most

    def histogram(field: str) -> F.Column:
        kinds = F.array_sort(F.array_distinct(F.array_compact(F.transform("cells", lambda c: c[field]))))
        count = lambda k: F.aggregate(F.filter("cells", lambda c: c[field] == k), F.lit(0).cast("long"), lambda a, c: a + c["n"])
        return F.array_join(F.transform(kinds, lambda k: F.concat(k, F.lit("="), count(k).cast("string"))), ",")

    return h.select(
        "source",
        "scenes",
        F.round("t", 2).alias("total_time"),
        F.round(F.col("t") / F.col("scenes"), 2).alias("avg_time"),
        F.round(F.col("l") / F.col("scenes")).cast("long").alias("avg_size"),
        histogram("complexity").alias("complexities"),
        histogram("error").alias("errors"),
    )


both(
    "fix_statistics",
    """
    SELECT total_attempts, successful, round(CASE WHEN total_attempts > 0 THEN CAST(successful AS DOUBLE) / total_attempts ELSE 0.0E0 END, 6) AS success_rate, pattern, n, rank
    FROM (SELECT count(*) AS total_attempts, count(CASE WHEN [k] % 4 = 0 THEN 1 END) AS successful FROM {events}) t CROSS JOIN
         (SELECT pattern, n, CAST(row_number() OVER (ORDER BY n DESC, pattern) AS INTEGER) AS rank FROM
             (SELECT concat(event_type, ':', [k] % 10) AS pattern, count(*) AS n FROM {events} WHERE [k] % 4 = 0 GROUP BY 1)) p WHERE rank <= 5
    """,
)
both(
    "api_cost_savings",
    """
    SELECT round(sum(current_cost), 6) AS current_cost, round(sum(optimized_cost), 6) AS optimized_cost, round(sum(current_cost) - sum(optimized_cost), 6) AS savings,
           round(CASE WHEN sum(current_cost) > 0 THEN (sum(current_cost) - sum(optimized_cost)) / sum(current_cost) * 100 ELSE 0.0E0 END, 6) AS savings_percent,
           round(sum(call_cost), 6) AS call_cost
    FROM (SELECT n * tokens / 1000000E0 * 45 AS current_cost, n * tokens / 1000000E0 * CASE WHEN model = 'sonnet' THEN 9 ELSE 45 END AS optimized_cost, n * price * 2 AS call_cost
          FROM (SELECT event_type, count(*) AS n, CASE event_type WHEN 'view' THEN 25000 WHEN 'click' THEN 15000 WHEN 'error' THEN 8000 ELSE 10000 END AS tokens,
                       CASE event_type WHEN 'view' THEN 'opus' WHEN 'click' THEN 'sonnet' WHEN 'error' THEN 'sonnet' ELSE 'opus' END AS model,
                       CASE event_type WHEN 'view' THEN 0.015E0 WHEN 'click' THEN 0.003E0 WHEN 'error' THEN 0.003E0 ELSE 0.00025E0 END AS price FROM {events} GROUP BY event_type))
    """,
)
both(
    "model_for_task",
    """
    SELECT event_id, CASE WHEN task = 'fix_render_error' AND attempt = 1 THEN 'opus' WHEN task = 'fix_render_error' THEN 'sonnet' WHEN file_size > 100000 THEN 'opus'
                          WHEN task = 'clean_code' THEN 'sonnet' ELSE 'opus' END AS model
    FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'fix_render_error' WHEN 'click' THEN 'clean_code' WHEN 'view' THEN 'match_videos' ELSE 'other' END AS task,
                 [k] % 3 + 1 AS attempt, value * 1500 AS file_size FROM {events})
    """,
)
_MORE = """
    SELECT source, n, CASE WHEN n > 5 THEN concat(shown, ' ... and ', CAST(n - 5 AS [text]), ' more') ELSE shown END AS line
    FROM (SELECT source, count(*) AS n FROM {documents} GROUP BY source) t
    JOIN (SELECT source AS s, [list] AS shown FROM
             (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM {documents}) WHERE rn <= 5 GROUP BY source) f ON source = s
    """
sql_query(
    "first_and_more",
    _MORE.replace("[text]", "STRING").replace("[list]", "listagg(CAST(doc_id AS STRING), ', ') WITHIN GROUP (ORDER BY doc_id)"),
    _MORE.replace("[text]", "VARCHAR").replace("[list]", "string_agg(doc_id::VARCHAR, ', ' ORDER BY doc_id)"),
)
# Star imports of one set of files: the highest of three kinds evicts the lower ones, all other imports stay.
_IMPORT = """CASE p_size % 5 WHEN 0 THEN 'from manim_imports_ext import *' WHEN 1 THEN 'from manimlib.imports import *' WHEN 2 THEN 'from manimlib import *'
    WHEN 3 THEN concat('import ', split_part(p_name, ' ', 1)) ELSE concat('from ', lower(p_brand), ' import x') END"""
sql_query(
    "import_priority",
    f"""
    SELECT p_type, line FROM (SELECT DISTINCT p_type, line, kind, min(kind) OVER (PARTITION BY p_type) AS best FROM
        (SELECT p_type, line, CASE WHEN contains(line, 'manim_imports_ext') THEN 1 WHEN contains(line, 'manimlib.imports') THEN 2 WHEN contains(line, 'manimlib') THEN 3 ELSE 9 END AS kind
         FROM (SELECT p_type, {_IMPORT} AS line FROM {{part}}))) WHERE kind = 9 OR kind = best
    """,
)


sql_query(
    "log_migration",
    """
    SELECT action, count(*) AS n, CAST(sum(kept) AS BIGINT) AS priority_sum FROM (
        SELECT CASE WHEN n.o_orderkey IS NULL THEN 'moved' WHEN o.o_orderkey IS NULL THEN 'already_there' ELSE 'merged' END AS action,
               coalesce(o.p, n.p) AS kept
        FROM (SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS BIGINT) AS p FROM {orders} WHERE o_orderstatus <> 'F') n
        FULL OUTER JOIN (SELECT o_orderkey, 10 + CAST(left(o_orderpriority, 1) AS BIGINT) AS p FROM {orders} WHERE o_orderstatus <> 'O') o ON n.o_orderkey = o.o_orderkey) GROUP BY action
    """,
)


_SAMPLES = """
    SELECT event_type, n, distinct_errors, samples FROM (SELECT event_type, count(*) AS n, count(DISTINCT props) AS distinct_errors FROM {events} GROUP BY event_type) t
    JOIN (SELECT event_type AS et, [list] AS samples FROM
             (SELECT event_type, event_id, props, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM {events}) WHERE rn <= 5 GROUP BY event_type) s ON event_type = et
    """
sql_query("error_first_samples", _SAMPLES.replace("[list]", "listagg(props, ';') WITHIN GROUP (ORDER BY event_id)"), _SAMPLES.replace("[list]", "string_agg(props, ';' ORDER BY event_id)"))
both(
    "stage_summary",
    """
    SELECT user_id, count(DISTINCT event_type) AS total_stages, count(DISTINCT CASE WHEN [k] >= 20 THEN event_type END) AS successful_stages,
           count(CASE WHEN event_type = 'error' THEN 1 END) AS total_errors, round(sum(value), 4) AS processing_duration,
           round(count(CASE WHEN event_type = 'purchase' THEN 1 END) * 0.03E0, 6) AS estimated_cost,
           round(sum(CASE WHEN event_type = 'error' THEN value ELSE 0.0E0 END) / greatest(count(CASE WHEN event_type = 'error' THEN 1 END), 1), 6) AS avg_retry_duration
    FROM {events} GROUP BY user_id
    """,
)
sql_query(
    "timestamp_pretty",
    """
    SELECT event_id, coalesce(date_format(try_cast(raw AS TIMESTAMP), 'yyyy-MM-dd HH:mm'), left(raw, 16)) AS shown
    FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN concat('no time at ', CAST(event_id AS STRING), ' given') ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS raw FROM {events})
    """,
    """
    SELECT event_id, coalesce(strftime(try_cast(raw AS TIMESTAMP), '%Y-%m-%d %H:%M'), left(raw, 16)) AS shown
    FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'no time at ' || event_id || ' given' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS raw FROM events)
    """,
)
both(
    "similar_fixed_errors",
    """
    SELECT event_id, fix_id, confidence, rank FROM (
        SELECT e.event_id, f.fix_id, f.confidence, CAST(row_number() OVER (PARTITION BY e.event_id ORDER BY f.confidence DESC, f.occurrences DESC, f.fix_id) AS INTEGER) AS rank
        FROM (SELECT event_id, CASE WHEN [k] > 90 THEN NULL ELSE [k] % 30 END AS key_info FROM {events} WHERE event_type = 'error') e
        JOIN (SELECT key_info, fix_id, occurrences, 0.9E0 AS confidence FROM (
                 SELECT t.key_info, x.fix_id, t.occurrences, row_number() OVER (PARTITION BY t.key_info ORDER BY t.occurrences DESC, x.fix_id) AS r FROM
                     (SELECT CASE WHEN [k] > 90 THEN NULL ELSE [k] % 30 END AS key_info, user_id, count(*) AS occurrences, min(event_id) AS error_id FROM {events} WHERE [k] % 4 = 0 GROUP BY 1, 2) t
                     JOIN (SELECT user_id, min(event_id) AS fix_id FROM {events} WHERE event_type = 'signup' GROUP BY user_id) x ON t.user_id = x.user_id) WHERE r <= 5
              UNION ALL SELECT DISTINCT [k] % 30, [k] % 30, 0, 0.95E0 FROM {events} WHERE [k] <= 90 AND [k] % 30 < 3) f
        ON e.key_info IS NOT DISTINCT FROM f.key_info) WHERE rank <= 5
    """,
)
# A name is looked up in eight places; the first that has it wins.
sql_query(
    "name_resolution",
    """
    SELECT kind, count(*) AS n FROM (
        SELECT CASE WHEN f.k IS NOT NULL THEN 'function' WHEN c.k IS NOT NULL THEN 'class' WHEN t.k IS NOT NULL THEN 'constant' WHEN x.k IS NOT NULL THEN 'cross_file'
                    WHEN i.k IS NOT NULL THEN 'import' WHEN s.k IS NOT NULL THEN 'star' WHEN r.name IN ('ECONOMY', 'STANDARD') THEN 'builtin' ELSE 'unresolved' END AS kind
        FROM (SELECT split_part(p_type, ' ', 1) AS name, p_name FROM {part}) r
        LEFT JOIN (SELECT DISTINCT split_part(p_type, ' ', 1) AS k, p_name AS own FROM {part} WHERE p_size < 5) f ON f.k = r.name AND f.own = r.p_name
        LEFT JOIN (SELECT DISTINCT split_part(p_type, ' ', 1) AS k, p_name AS own FROM {part} WHERE p_size BETWEEN 5 AND 9) c ON c.k = r.name AND c.own = r.p_name
        LEFT JOIN (SELECT DISTINCT split_part(p_type, ' ', 1) AS k, p_name AS own FROM {part} WHERE p_size BETWEEN 10 AND 14) t ON t.k = r.name AND t.own = r.p_name
        LEFT JOIN (SELECT DISTINCT split_part(p_type, ' ', 1) AS k FROM {part} WHERE p_retailprice < 902) x ON x.k = r.name
        LEFT JOIN (SELECT DISTINCT upper(o_orderstatus) AS k FROM {orders}) i ON i.k = left(r.name, 1) AND r.p_name < 'm'
        LEFT JOIN (SELECT DISTINCT upper(left(n_name, 2)) AS k FROM {nation}) s ON s.k = left(r.name, 2)) GROUP BY kind
    """,
)
sql_query(
    "file_list_union",
    """
    SELECT o_custkey, concat_ws(',', primary_files, supporting_files) AS files FROM (
        SELECT o_custkey, listagg(CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS STRING) END, ',') WITHIN GROUP (ORDER BY o_orderkey) AS primary_files,
               listagg(CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderkey AS STRING) END, ',') WITHIN GROUP (ORDER BY o_orderkey) AS supporting_files FROM {orders} GROUP BY o_custkey)
    """,
    """
    SELECT o_custkey, concat_ws(',', primary_files, supporting_files) AS files FROM (
        SELECT o_custkey, string_agg(CASE WHEN o_orderstatus = 'F' THEN o_orderkey::VARCHAR END, ',' ORDER BY o_orderkey) AS primary_files,
               string_agg(CASE WHEN o_orderstatus <> 'F' THEN o_orderkey::VARCHAR END, ',' ORDER BY o_orderkey) AS supporting_files FROM orders GROUP BY o_custkey)
    """,
)
_STAGE = "CASE event_type WHEN 'view' THEN 'matching' WHEN 'click' THEN 'cleaning' WHEN 'signup' THEN 'conversion' WHEN 'purchase' THEN 'rendering' ELSE 'skipped' END"
both(
    "pipeline_report",
    f"""
    SELECT count(*) AS runs, count(CASE WHEN stage = 'matching' THEN 1 END) AS matched, count(CASE WHEN stage = 'rendering' THEN 1 END) AS rendered, count(CASE WHEN stage = 'skipped' THEN 1 END) AS skipped,
           round(CAST(count(CASE WHEN stage = 'skipped' THEN 1 END) AS DOUBLE) / greatest(count(CASE WHEN stage IN ('skipped', 'conversion') THEN 1 END), 1), 6) AS skip_rate,
           round(count(CASE WHEN stage = 'skipped' THEN 1 END) * 0.03E0, 2) AS savings, round(sum(value), 1) AS duration
    FROM (SELECT {_STAGE} AS stage, value FROM {{events}})
    """,
)
_ROWS = """SELECT o_orderkey, o_orderpriority, o_totalprice, total, ok, CASE WHEN total IS NULL THEN 'not_processed' WHEN ok = total THEN 'success' WHEN ok > 0 THEN 'partial' ELSE 'failed' END AS status,
    round(CASE WHEN total > 0 THEN CAST(ok AS DOUBLE) / total ELSE 0.0E0 END, 6) AS coverage
    FROM {orders} LEFT JOIN (SELECT l_orderkey, count(*) AS total, count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS ok FROM {lineitem} GROUP BY l_orderkey) r ON o_orderkey = l_orderkey"""
_LINE = """CASE status WHEN 'success' THEN concat('+ ', CAST(o_orderkey AS STRING), ' (', CAST(total AS STRING), ' scenes)')
    WHEN 'partial' THEN concat('~ ', CAST(o_orderkey AS STRING), ' (', CAST(ok AS STRING), '/', CAST(total AS STRING), ' scenes, ', CAST(CAST(round(coverage * 100) AS BIGINT) AS STRING), '% coverage)')
    WHEN 'failed' THEN concat('x ', CAST(o_orderkey AS STRING), ' (0/', CAST(total AS STRING), ' scenes rendered)') ELSE concat('- ', CAST(o_orderkey AS STRING)) END"""
sql_query("recreation_lines", f"SELECT o_orderkey, status, {_LINE} AS line FROM ({_ROWS})", f"SELECT o_orderkey, status, {_LINE} AS line FROM ({_ROWS})".replace("AS STRING", "AS VARCHAR"))
sql_query(
    "recreation_status",
    f"""
    SELECT o_orderpriority, count(*) AS total_videos, count(CASE WHEN status = 'success' THEN 1 END) AS fully_successful, count(CASE WHEN status = 'partial' THEN 1 END) AS partially_successful,
           count(CASE WHEN status = 'failed' THEN 1 END) AS failed, count(CASE WHEN status = 'not_processed' THEN 1 END) AS not_processed,
           round(100.0E0 * count(CASE WHEN status = 'success' THEN 1 END) / count(*), 6) AS success_percent FROM ({_ROWS}) GROUP BY o_orderpriority
    """,
)


@query(
    "dashboard_cells",
    "SELECT o_orderpriority, '<tr><td>' || replace(o_orderpriority, '&', '&amp;') || '</td><td>' || count(*) || '</td><td>' || count(*) FILTER (o_orderstatus = 'F') || '</td></tr>' AS html FROM orders GROUP BY o_orderpriority",
)
def dashboard_cells(spark, sf):
    """Rows of the HTML dashboard, escaped."""
    return stages.html_rows(table(spark, sf, "orders"), "o_orderpriority", {"n": "count(*)", "done": "count_if(o_orderstatus = 'F')"})


both(
    "prompt_report",
    """
    SELECT event_type, round(rate, 6) AS success_rate, n, CAST(row_number() OVER (ORDER BY rate DESC, event_type) AS INTEGER) AS rank
    FROM (SELECT event_type, count(*) AS n, avg(CASE WHEN [k] >= 20 THEN 1.0E0 ELSE 0.0E0 END) AS rate FROM {events} GROUP BY event_type)
    """,
)
both(
    "conversion_rates",
    """
    SELECT event_type, count(*) AS attempts, round(CAST(sum([k]) AS DOUBLE) / greatest(sum([k] + user_id), 1) * 100, 6) AS conversion_rate,
           round(CAST(count(CASE WHEN [k] >= 5 THEN 1 END) AS DOUBLE) / greatest(count(*), 1), 6) AS parse_success_rate,
           round(CAST(sum(CASE WHEN [k] >= 20 THEN [k] % 7 ELSE 0 END) AS DOUBLE) / greatest(count(CASE WHEN [k] >= 20 THEN 1 END), 1), 6) AS avg_dependencies FROM {events} GROUP BY event_type
    """,
)
sql_query(
    "size_scan",
    "SELECT source, count(*) AS files, CAST(sum(n_chars) AS BIGINT) AS total_size, CAST(max(n_chars) AS BIGINT) AS largest FROM {documents} GROUP BY source",
)
both(
    "yearly_summary",
    """
    SELECT CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month, count(*) AS total, count(CASE WHEN event_type = 'error' THEN 1 END) AS failed, count(DISTINCT user_id) AS videos FROM {events} GROUP BY 1, 2
    """,
)
